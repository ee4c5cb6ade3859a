"""Daily sketches beside the signature table: frequent URLs and numbers of distinct elements for any range of dates.

A row for each date and device holds a frequent-items sketch of the URLs past the rank cutoff, a HyperLogLog sketch of
the elements, and how many rows the first one has seen. Sketches are merged when read, so a question about a year reads
a few hundred rows in place of a year of facts. A date's rows are made from all its facts and replaced as a whole:
counts, unlike minima, must not be added twice.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdrift.functions.hashing import xxhash_id
from rankdrift.operators.cleaning import date_range
from rankdrift.operators.urls import url_counts
from rankdrift.schema import RANK_COLUMNS, RankColumns

#: URLs that a sketch keeps, and the logarithm of the number of registers of the others.
TRACKED, LOG_REGISTERS = 10_000, 14


def day_sketches(
    df: DataFrame,
    min_rank_exclusive: int = 10,
    tracked: int = TRACKED,
    log_registers: int = LOG_REGISTERS,
    cols: RankColumns = RANK_COLUMNS,
) -> DataFrame:
    """One row per date and group: ``urls`` and ``elements``, two sketches, and ``past``, the rows past the cutoff."""
    past = f"(WHERE `{cols.rank}` > {int(min_rank_exclusive)})"
    return df.groupBy(cols.date, cols.group).agg(
        F.expr(f"approx_top_k_accumulate(`{cols.entity}`, {int(tracked)}) FILTER {past}").alias("urls"),
        F.hll_sketch_agg(xxhash_id(cols.element), log_registers).alias("elements"),
        F.expr(f"count(*) FILTER {past}").alias("past"),
    )


def write_day_sketches(sketches: DataFrame, path: str, cols: RankColumns = RANK_COLUMNS) -> None:
    """Replace the rows of the dates that ``sketches`` has. A date has one file."""
    writer = sketches.repartition(cols.date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(cols.date).parquet(path)


def read_day_sketches(spark: SparkSession, path: str, start=None, end=None, cols: RankColumns = RANK_COLUMNS) -> DataFrame:
    return date_range(spark.read.parquet(path), start, end, cols)


def unseen_bound(past: int, tracked: int = TRACKED) -> int:
    """How many rows a URL may have at most that merged sketches don't name, of ``past`` rows in all.

    A sketch's map has a power of two of places, at least a third more than URLs kept, and is off by 3.5 rows in as many
    as it has places; it names a URL if its least possible count is above that error.
    """
    places = 1
    while places * 3 < tracked * 4:
        places *= 2
    return 2 * ceil(3.5 * past / places)


def frequent_urls(
    sketches: DataFrame,
    df: DataFrame,
    min_rank_exclusive: int = 10,
    k: int = 1,
    tracked: int = TRACKED,
    cols: RankColumns = RANK_COLUMNS,
) -> DataFrame:
    """The ``k`` most frequent URLs past the cutoff, counted exactly: ``top_urls`` of ``df`` without counting every URL.

    ``sketches`` are those of the dates of ``df``, made with the same cutoff. They name the candidates, of which ``tracked``
    at most are counted. ``bound`` says how many rows any other URL may have, and ``certain`` that a row's count is above
    it: certain rows are those of ``top_urls``, in the same order.
    """
    # One row, or none if there are no sketches.
    merged = sketches.groupBy(F.lit(0).alias("_all")).agg(
        F.expr(f"approx_top_k_combine(urls, {int(tracked)})").alias("_urls"), F.sum("past").alias("_past")
    )
    named = F.expr(f"approx_top_k_estimate(_urls, {int(tracked)})").alias("_named")
    row = merged.select(F.when(F.col("_past") > 0, named).alias("_named"), "_past").first()
    past, items = (row["_past"], row["_named"] or []) if row else (0, [])
    found = df.sparkSession.createDataFrame([(x["item"],) for x in items], df.select(cols.entity).schema)
    counts = url_counts(df.join(F.broadcast(found), cols.entity, "left_semi"), min_rank_exclusive, cols)
    top = counts.orderBy(F.desc("n"), F.col(cols.entity)).limit(k)
    bound = F.lit(unseen_bound(past, tracked)).cast("long")
    return top.select(cols.entity, "n", bound.alias("bound"), (F.col("n") > bound).alias("certain"))


def distinct_estimate(sketches: DataFrame, *by: str) -> DataFrame:
    """About how many different elements there are, in all or for each value of ``by``.

    The standard error is 0.83 / sqrt(registers): 0.65 % with the default of 2 ** 14.
    """
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("elements")).alias("n"))
