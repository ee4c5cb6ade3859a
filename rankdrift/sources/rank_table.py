"""The rank table: Parquet, one partition per crawl date, one row per key.

By default files are sorted by rank, for the cutoffs of the analyses. A table that is written with ``lookup`` columns is
laid out for finding the rows of a keyword or a URL instead: within a date, a hash of the first such column deals keys out
to files, which are sorted by it, and Bloom filters say which row groups can't hold a value of the others.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rankdrift.operators.cleaning import clean_ranks, date_range, drop_duplicate_keys, fill_location
from rankdrift.schema import RANK_COLUMNS, RANK_SCHEMA
from rankdrift.session import scratch_dir
from rankdrift.sources.csv_report import BAD_ROW, read_rank_csv


#: Parts into which a hash deals the keys of a date, and bytes of a row group, the least that a lookup reads.
CLUSTERS, ROW_GROUP = 64, 8 << 20


def _laid_out(df: DataFrame, lookup: Sequence[str] = ()) -> DataFrame:
    """Whole date partitions, sorted by rank or by the first lookup column inside each file.

    REBALANCE lets adaptive execution split a large day over many tasks and
    put small days together, so neither hot dates nor small files arise.
    """
    cols = RANK_COLUMNS
    if lookup:
        # Spark splits a part that is too large by rows, so a key may be in a few files of its date.
        df = df.withColumn("_part", F.pmod(F.xxhash64(lookup[0]), F.lit(CLUSTERS)))
        laid_out = df.hint("rebalance", cols.date, "_part")
        return laid_out.sortWithinPartitions(cols.date, lookup[0], cols.rank, *cols.subject, cols.group).drop("_part")
    return df.hint("rebalance", cols.date).sortWithinPartitions(cols.date, cols.rank, *cols.subject, cols.group)


def _write(laid_out: DataFrame, path: str, partitions: str, lookup: Sequence[str] = (), row_group: int = ROW_GROUP) -> None:
    cols = RANK_COLUMNS
    writer = laid_out.select(*cols.all).write.mode("overwrite")
    if lookup:
        writer = writer.option("parquet.block.size", row_group).option("parquet.bloom.filter.adaptive.enabled", "true")
    for column in lookup:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.option("partitionOverwriteMode", partitions).partitionBy(cols.date).parquet(path)


def write_rank_table(df: DataFrame, path: str, lookup: Sequence[str] = (), row_group: int = ROW_GROUP) -> None:
    """Replace the table with ``df``, which ``clean_ranks`` has made unique.

    ``df`` must not come from the same table: that is deleted first. ``lookup`` names the columns by whose values
    rows are to be found, the most important one first; ``row_group`` is the size of what such a search reads.
    """
    _write(_laid_out(df, lookup), path, "static", lookup, row_group)


class LoadCounts(NamedTuple):
    """What went into a table: rows read that were good and bad, days, keys, and keys that occurred more than once."""

    rows: int
    bad_rows: int
    days: int
    first_day: date | None
    last_day: date | None
    keys: int
    repeated_keys: int

    @property
    def dropped_rows(self) -> int:
        """Good rows that are not in the table, being copies of a key."""
        return self.rows - self.keys


def load_rank_table(
    facts: DataFrame, path: str, order: Sequence[str] = (), latest: bool = False, lookup: Sequence[str] = ()
) -> LoadCounts:
    """Clean the facts as ``clean_ranks`` does, replace the table with them, and say what went in.

    ``facts`` may have bad rows, kept by ``on_bad="keep"``; they are counted and left out. The counts are taken while the
    table is written, by the tasks that write it, so they cost no second job and a task that runs again isn't counted
    twice. Bad rows meet as one group of their own, and copies of a key before the shuffle.
    """
    cols = RANK_COLUMNS
    used = fill_location(facts.select(*dict.fromkeys([*cols.all, *order]), *[c for c in (BAD_ROW,) if c in facts.columns]))
    bad = F.col(BAD_ROW).isNotNull() if BAD_ROW in used.columns else F.lit(False)
    rest = [c for c in used.columns if c not in (*cols.key, BAD_ROW, *order)]
    masked = [F.when(~F.col("_bad"), F.col(c)).alias(c) for c in cols.key]
    pick = F.max if latest else F.min
    keyed = used.withColumn("_bad", bad).select("_bad", *masked, F.struct(*order, *rest).alias("_row"))
    best = keyed.groupBy(F.xxhash64(*cols.key).alias("_hash"), "_bad", *cols.key).agg(
        pick("_row").alias("_row"), F.count("*").alias("_copies")
    )
    ranks = best.select(*cols.key, F.col(f"_row.{cols.entity}").alias(cols.entity), "_bad", "_copies")
    good, copies = ~F.col("_bad"), F.col("_copies")
    # A bit for each day; days 89 years apart share one.
    day_bits = F.bitmap_construct_agg(F.when(good, F.pmod(F.unix_date(cols.date), F.lit(8 * 4096))).cast("long"))
    observed = Observation("load")
    counted = _laid_out(ranks, lookup).observe(
        observed,
        F.coalesce(F.sum(F.when(good, copies)), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~good, copies)), F.lit(0)).alias("bad_rows"),
        F.bitmap_count(day_bits).alias("days"),
        F.min(F.when(good, F.col(cols.date))).alias("first_day"),
        F.max(F.when(good, F.col(cols.date))).alias("last_day"),
        F.count(F.when(good, 1)).alias("keys"),
        F.count(F.when(good & (copies > 1), 1)).alias("repeated_keys"),
    )
    _write(counted.where(good), path, "static", lookup)
    return LoadCounts(**observed.get)


def read_rank_table(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Rank facts from ``start`` to ``end``, both included and both optional."""
    table = spark.read.schema(RANK_SCHEMA).parquet(path).select(*RANK_COLUMNS.all)
    return date_range(table, start, end)


def find_ranks(
    spark: SparkSession,
    path: str,
    keywords: Sequence[str] | None = None,
    urls: Sequence[str] | None = None,
    start=None,
    end=None,
) -> DataFrame:
    """The rows of these keywords, URLs, or both, of a table that is laid out for it.

    What is read are the row groups whose bounds and Bloom filters admit a value. Up to ten values are looked up one
    by one, more as the range from the least to the greatest (``spark.sql.parquet.pushdown.inFilterThreshold``).
    """
    ranks = read_rank_table(spark, path, start, end)
    for column, values in (("keyword", keywords), (RANK_COLUMNS.entity, urls)):
        if values is not None:
            ranks = ranks.where(F.col(column).isin(list(values)))
    return ranks


def upsert_rank_table(
    incoming: DataFrame, path: str, order: Sequence[str] = (), staging: str | None = None
) -> None:
    """Insert new keys and replace the URL of known ones.

    Dates are overwritten in place; ``batch_table.upsert_batch`` never does that, and outlives a lost driver.

    Within ``incoming`` the last row by ``order`` wins. Its rows are first written to the folder ``staging`` (by default
    a new one below ``spark.checkpoint.dir``), so that a source which gives other rows when it is read again can't
    touch dates whose old rows were not read. Only the date partitions that occur in ``incoming`` are rewritten; those
    between its first and last date are read.
    """
    spark, cols = incoming.sparkSession, RANK_COLUMNS
    staging = staging or scratch_dir(spark, "incoming")
    fill_location(incoming.select(*dict.fromkeys([*cols.all, *order]))).write.parquet(staging)
    incoming = spark.read.schema(incoming.select(*dict.fromkeys([*cols.all, *order])).schema).parquet(staging)
    try:
        table = read_rank_table(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        write_rank_table(clean_ranks(incoming, order, latest=True), path)
        return
    merged = merged_ranks(table, incoming, order)
    if merged is not None:
        _write(_laid_out(merged), path, "dynamic")


def merged_ranks(table: DataFrame, incoming: DataFrame, order: Sequence[str] = ()) -> DataFrame | None:
    """The new rows of all dates that occur in ``incoming``; nothing if it has no rows."""
    cols = RANK_COLUMNS
    first, last = incoming.agg(F.min(cols.date), F.max(cols.date)).first()
    if first is None:
        return None
    dates = incoming.select(cols.date).distinct()
    touched = date_range(table, first, last).join(dates, cols.date, "left_semi")
    both = touched.withColumn("_batch", F.lit(0)).unionByName(
        incoming.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    return drop_duplicate_keys(both, ["_batch", *order], latest=True)


def load_ranks(spark: SparkSession, csv: str | None = None, table: str | None = None) -> DataFrame:
    """Rank facts from the one source that is named."""
    if (csv is None) == (table is None):
        raise ValueError("name either a CSV path or a table path")
    return read_rank_csv(spark, csv) if csv is not None else read_rank_table(spark, table)
