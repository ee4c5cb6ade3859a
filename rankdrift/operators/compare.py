"""The estimate held against the exact similarity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankdrift.functions.intervals import interval
from rankdrift.operators.exact import checked_groups
from rankdrift.operators.minhash import K
from rankdrift.schema import RANK_COLUMNS, RankColumns


def estimate_vs_exact(
    estimate: DataFrame, exact: DataFrame, cols: RankColumns = RANK_COLUMNS
) -> DataFrame:
    """Both similarities and their absolute difference, per date in date order."""
    both = estimate.select(cols.date, F.col("similarity").alias("estimate")).join(
        exact.select(cols.date, F.col("similarity").alias("exact")), cols.date
    )
    return both.withColumn("difference", F.abs(F.col("estimate") - F.col("exact"))).orderBy(cols.date)


def estimate_error(compared: DataFrame) -> DataFrame:
    """Mean and largest absolute difference over all dates, in one row."""
    return compared.agg(
        F.count("*").alias("dates"),
        F.avg("difference").alias("mean_error"),
        F.max("difference").alias("max_error"),
    )


def estimate_intervals(
    signatures: DataFrame,
    devices: Sequence[str],
    confidence: float = 0.95,
    k: int = K,
    cols: RankColumns = RANK_COLUMNS,
) -> DataFrame:
    """The estimate for two devices per date, and between what bounds the exact similarity lies, in percent.

    ``signatures`` are merged ones of ``k`` hash functions. The bounds ``low`` and ``high`` hold for a date with
    ``confidence`` at least, if one date is looked at. Where a device is missing all three are 0.
    """
    checked_groups(devices)
    if len(devices) != 2:
        raise ValueError("name two devices")
    if not 0 < confidence < 1:
        raise ValueError("the confidence is a share between 0 and 1")
    # A device that has several signatures would be compared by parts only.
    one = [
        F.when(F.count(F.when(F.col(cols.group) == d, 1)) > 1, F.raise_error("partial signatures: merge them first").cast("array<bigint>"))
        .otherwise(F.max(F.when(F.col(cols.group) == d, F.col("sig"))))
        .alias(f"_{n}")
        for n, d in enumerate(devices)
    ]
    sides = signatures.groupBy(cols.date).agg(*one)
    wrong = F.raise_error(f"signature of another length than {k}").cast("int")
    both = (F.size("_0") > 0) & (F.size("_1") > 0)
    same = F.size(F.filter(F.zip_with("_0", "_1", lambda x, y: x == y), lambda same: same))
    agree = F.when(both & ((F.size("_0") != k) | (F.size("_1") != k)), wrong).when(both, same)
    bounds = sides.select(cols.date, agree.alias("_agree")).withColumn("_bounds", interval(F.col("_agree"), k, confidence))
    zero = F.lit(0)
    return bounds.select(
        cols.date,
        F.coalesce(F.expr(f"cast(_agree * 100 div {k} AS int)"), zero).alias("estimate"),
        F.coalesce("_bounds.low", zero).alias("low"),
        F.coalesce("_bounds.high", zero).alias("high"),
    ).orderBy(cols.date)
