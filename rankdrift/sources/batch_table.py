"""The rank table as append-only batches: an upsert never overwrites or deletes rows that someone may need.

    rows/crawl_date=.../batch=.../   the rows of a date as a batch left them
    batches/                         a row for each batch that counts, with the dates it rewrote

An upsert writes whole dates, merged with their rows before it, under a batch name of its own. The batch counts once its
row stands in ``batches``, a single file that appears in one step; a date is read from its greatest counted batch. So a
reader sees a batch wholly or not at all, and a job that is lost at any point, with its driver too, leaves at most files
that nothing refers to.

One writer at a time: of two that run side by side the later one would not see the other's rows. Readers need no care.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankdrift.operators.cleaning import date_range, drop_duplicate_keys, fill_location
from rankdrift.schema import RANK_COLUMNS, RANK_SCHEMA
from rankdrift.session import exists, remove, scratch_dir

BATCH = "batch"
ROWS_SCHEMA = T.StructType([*RANK_SCHEMA, T.StructField(BATCH, T.StringType(), False)])
BATCHES_SCHEMA = "batch string, dates array<date>"


def counted_batches(spark: SparkSession, path: str) -> DataFrame:
    """The batches that count, with their dates."""
    if not exists(spark, f"{path}/batches"):
        return spark.createDataFrame([], BATCHES_SCHEMA)
    return spark.read.schema(BATCHES_SCHEMA).parquet(f"{path}/batches")


def current_batches(spark: SparkSession, path: str) -> DataFrame:
    """For each date the batch that it is read from: one row for each date."""
    dates = counted_batches(spark, path).select(BATCH, F.explode("dates").alias("crawl_date"))
    return dates.groupBy("crawl_date").agg(F.max(BATCH).alias(BATCH))


def read_batch_table(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Rank facts from ``start`` to ``end``, both included and both optional.

    Bounds prune dates when the query is planned, and the batches of a date are pruned when it runs.
    """
    if not exists(spark, f"{path}/rows"):
        return spark.createDataFrame([], RANK_SCHEMA).select(*RANK_COLUMNS.all)
    rows = date_range(spark.read.schema(ROWS_SCHEMA).parquet(f"{path}/rows"), start, end)
    current = date_range(current_batches(spark, path), start, end)
    # A row for each date: a thousand years of them take a few megabytes.
    return rows.join(F.broadcast(current), ["crawl_date", BATCH]).select(*RANK_COLUMNS.all)


def upsert_batch(incoming: DataFrame, path: str, order: Sequence[str] = ()) -> str | None:
    """Insert new keys and replace the URL of known ones; returns the name of the batch, None if there are no rows.

    Within ``incoming`` the last row by ``order`` wins. Its rows are staged first, so that a source which gives other
    rows when it is read again can't touch dates whose old rows were not read.
    """
    spark = incoming.sparkSession
    staging = scratch_dir(spark, "incoming")
    used = fill_location(incoming.select(*dict.fromkeys([*RANK_COLUMNS.all, *order])))
    used.write.parquet(staging)
    staged = spark.read.schema(used.schema).parquet(staging)
    batch = next_batch(spark, path)
    # A row for each date.
    dates = sorted(r[0] for r in staged.select("crawl_date").distinct().collect())
    if dates:
        write_rows(merged_dates(spark, path, staged, dates, order), path, batch)
        count_batch(spark, path, batch, dates)
    remove(spark, staging)
    return batch if dates else None


def next_batch(spark: SparkSession, path: str) -> str:
    """A name greater than those of all batches that count, and not that of a batch which was given up."""
    last = counted_batches(spark, path).agg(F.max(BATCH)).first()[0]
    return f"{int(last.split('-')[0]) + 1 if last else 1:012d}-{uuid.uuid4().hex[:12]}"


def merged_dates(spark: SparkSession, path: str, incoming: DataFrame, dates: Sequence, order: Sequence[str] = ()) -> DataFrame:
    """The rows that ``dates`` have after the upsert."""
    before = read_batch_table(spark, path, dates[0], dates[-1])
    touched = before.join(incoming.select("crawl_date").distinct(), "crawl_date", "left_semi")
    both = touched.withColumn("_batch", F.lit(0)).unionByName(
        incoming.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    return drop_duplicate_keys(both, ["_batch", *order], latest=True).select(*RANK_COLUMNS.all)


def write_rows(ranks: DataFrame, path: str, batch: str) -> None:
    """Write the rows of a batch that doesn't count yet."""
    cols = RANK_COLUMNS
    laid_out = ranks.hint("rebalance", cols.date).sortWithinPartitions(cols.date, cols.rank, *cols.subject, cols.group)
    named = laid_out.withColumn(BATCH, F.lit(batch))
    named.write.mode("append").partitionBy(cols.date, BATCH).parquet(f"{path}/rows")


def count_batch(spark: SparkSession, path: str, batch: str, dates: Sequence) -> None:
    """From now on the batch counts. One row in one file, which the commit moves into place in one step."""
    row = spark.createDataFrame([(batch, list(dates))], BATCHES_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{path}/batches")


def remove_superseded(spark: SparkSession, path: str) -> int:
    """Remove what batches wrote for dates that are read from a later one; returns the number of folders.

    Call it when no reader that started before the last upsert is left. Folders of batches that don't count are kept:
    one may be in the making.
    """
    written = counted_batches(spark, path).select(BATCH, F.explode("dates").alias("crawl_date"))
    old = written.join(current_batches(spark, path), ["crawl_date", BATCH], "left_anti")
    n = 0
    for row in old.toLocalIterator():
        folder = f"{path}/rows/crawl_date={row.crawl_date}/{BATCH}={row.batch}"
        if exists(spark, folder):
            remove(spark, folder)
            n += 1
    return n
