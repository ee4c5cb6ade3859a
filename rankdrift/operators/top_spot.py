"""Who loses the top spot, and how often it changes hands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankdrift.schema import RANK_COLUMNS, RankColumns

# Days per BIGINT in the presence masks. Bit 62 repeats the first day of the
# next block, which leaves the sign bit unused.
BLOCK = 62


def crawl_days(df: DataFrame, cols: RankColumns = RANK_COLUMNS) -> DataFrame:
    """The days that were crawled, as far as ``df`` tells: those on which it has rows."""
    return df.select(cols.date).distinct()


def _numbered(df: DataFrame, calendar: DataFrame | None, cols: RankColumns) -> DataFrame:
    """``df`` with the number ``_day`` of its date, so that a day and the one after it differ by 1.

    Days count by the calendar of crawled days, or as they come. A row of a day that was not crawled is an error.
    """
    if calendar is None:
        return df.withColumn("_day", F.unix_date(cols.date))
    # A row for each day, so neither the sort in one task nor the broadcast grows with the facts.
    days = calendar.select(F.col(cols.date).alias("_date")).distinct()
    days = days.select("_date", F.row_number().over(Window.orderBy("_date")).alias("_number"))
    known = df.join(F.broadcast(days), F.col(cols.date) == F.col("_date"), "left")
    stop = F.raise_error(F.concat(F.lit("rows of a day that was not crawled: "), F.col(cols.date).cast("string")))
    return known.select(*df.columns, F.when(F.col("_number").isNull(), stop.cast("int")).otherwise(F.col("_number")).alias("_day"))


def _days_at(df: DataFrame, top_rank: int, calendar: DataFrame | None, cols: RankColumns) -> DataFrame:
    """One row per holder and day at ``top_rank``, with the number of raw rows."""
    top = df.where(F.col(cols.rank) == top_rank)
    days = top.groupBy(*cols.holder, cols.date).agg(F.count("*").alias("copies"))
    return _numbered(days, calendar, cols)


def departure_days(
    df: DataFrame,
    top_rank: int = 1,
    semantics: str = "set",
    cols: RankColumns = RANK_COLUMNS,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Last days at the top: the holder is at ``top_rank`` that day but not the next.

    The last day of the data counts. With ``semantics="compat"`` a day that
    occurs more than once for a holder is no departure. With a ``calendar``
    the next day is the next one that was crawled, so a day without any report
    is no departure.
    """
    days = _days_at(df, top_rank, calendar, cols)
    by_holder = Window.partitionBy(*cols.holder).orderBy("_day")
    following = F.lead("_day").over(by_holder)
    left = following.isNull() | (following != F.col("_day") + 1)
    if semantics == "compat":
        left = left & (F.col("copies") == 1)
    elif semantics != "set":
        raise ValueError(f"unknown semantics: {semantics}")
    return days.withColumn("_left", left).where("_left").select(*cols.holder, cols.date)


def departure_days_anti_join(
    df: DataFrame, top_rank: int = 1, cols: RankColumns = RANK_COLUMNS
) -> DataFrame:
    """``departure_days`` written as a day-over-day anti join."""
    days = _days_at(df, top_rank, None, cols).select(*cols.holder, cols.date)
    following = days.select(
        *[F.col(c).alias(f"_{c}") for c in cols.holder],
        F.date_sub(cols.date, 1).alias("_day_before"),
    )
    match = F.col(cols.date) == F.col("_day_before")
    for c in cols.holder:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return days.join(following, match, "left_anti")


def _presence_masks(df: DataFrame, cols: RankColumns) -> DataFrame:
    """One row per holder and block of days (``_day``); bit i of ``mask`` stands for day i of the block."""
    day = F.col("_day")
    bit = F.pmod(day, F.lit(BLOCK))
    block = F.call_function("div", day - bit, F.lit(BLOCK))
    one = F.lit(1).cast("bigint")

    def mark(block: Column, mask: Column) -> Column:
        return F.struct(block.alias("block"), mask.alias("mask"))

    own = mark(block, F.call_function("shiftleft", one, bit))
    # The first day of a block also counts as the day after the block before.
    before = mark(block - 1, F.lit(1 << BLOCK))
    marks = F.when(bit == 0, F.array(own, before)).otherwise(F.array(own))
    marked = df.select(*cols.holder, F.inline(marks))
    return marked.groupBy(*cols.holder, "block").agg(F.bit_or("mask").alias("mask"))


def departure_counts(
    df: DataFrame,
    top_rank: int = 1,
    semantics: str = "set",
    cols: RankColumns = RANK_COLUMNS,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Number of departures from ``top_rank`` per holder, as ``departure_days`` has them.

    Presence per day is kept as bits of a BIGINT, one row per holder and block
    of days. The masks combine before the shuffle, and no sort is needed.
    """
    if semantics != "set":
        days = departure_days(df, top_rank, semantics, cols, calendar)
        return days.groupBy(*cols.holder).agg(F.count("*").alias("n"))
    masks = _presence_masks(_numbered(df.where(F.col(cols.rank) == top_rank), calendar, cols), cols)
    here_tomorrow = F.shiftright("mask", 1)
    left = F.col("mask").bitwiseAND(F.bitwise_not(here_tomorrow))
    within_block = left.bitwiseAND(F.lit((1 << BLOCK) - 1))
    counts = masks.groupBy(*cols.holder).agg(F.sum(F.bit_count(within_block)).alias("n"))
    return counts.where("n > 0")


def top_spot_departures(
    df: DataFrame,
    top_rank: int = 1,
    k: int = 1,
    semantics: str = "set",
    cols: RankColumns = RANK_COLUMNS,
) -> DataFrame:
    """The ``k`` holders that left ``top_rank`` most often; equal counts go by key."""
    counts = departure_counts(df, top_rank, semantics, cols)
    return counts.orderBy(F.desc("n"), *[F.col(c) for c in cols.holder]).limit(k)


def top_spot_runs(
    df: DataFrame, top_rank: int = 1, cols: RankColumns = RANK_COLUMNS, calendar: DataFrame | None = None
) -> DataFrame:
    """Stays at ``top_rank`` per holder: ``first_day``, ``last_day`` and the number of days that were seen.

    A stay goes on over days that the ``calendar`` says were not crawled. Its last day is a departure.
    """
    days = _days_at(df, top_rank, calendar, cols)
    nth = F.row_number().over(Window.partitionBy(*cols.holder).orderBy("_day"))
    # On days in a row the day's number grows as fast as its place among the holder's days.
    runs = days.withColumn("_run", F.col("_day") - nth).groupBy(*cols.holder, "_run")
    return runs.agg(
        F.min(cols.date).alias("first_day"), F.max(cols.date).alias("last_day"), F.count("*").alias("days")
    ).drop("_run")


def prev_day_url(
    df: DataFrame, cols: RankColumns = RANK_COLUMNS, calendar: DataFrame | None = None
) -> DataFrame:
    """Each row of a clean table with the URL that held its place the day before, or the crawl before by the ``calendar``."""
    by_slot = Window.partitionBy(*cols.slot).orderBy("_day")
    seen, held = F.lag("_day").over(by_slot), F.lag(cols.entity).over(by_slot)
    before = F.when(seen == F.col("_day") - 1, held).alias(f"prev_{cols.entity}")
    return _numbered(df, calendar, cols).select(*df.columns, before)


def top_spot_changes(
    df: DataFrame, top_rank: int = 1, cols: RankColumns = RANK_COLUMNS, calendar: DataFrame | None = None
) -> DataFrame:
    """How often the URL at ``top_rank`` differs from the day before, per result list."""
    followed = prev_day_url(df.where(F.col(cols.rank) == top_rank), cols, calendar)
    changed = F.col(f"prev_{cols.entity}") != F.col(cols.entity)
    return followed.where(changed).groupBy(*cols.subject, cols.group).agg(F.count("*").alias("n"))
