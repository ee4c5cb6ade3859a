"""Turning raw rank facts into a table with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankdrift.schema import RANK_COLUMNS, RankColumns


def fill_location(df: DataFrame, column: str = "loc") -> DataFrame:
    """The location is part of the key, so a missing one becomes an empty string."""
    return df.na.fill("", [column]) if column in df.columns else df


def drop_duplicate_keys(
    df: DataFrame,
    order: Sequence[str] = (),
    latest: bool = False,
    cols: RankColumns = RANK_COLUMNS,
) -> DataFrame:
    """Keep one row per key: the first by ``order``, or the last with ``latest``.

    The remaining columns break ties, so the survivor does not depend on how
    the rows were laid out. Being an aggregation, copies of a key meet before
    the shuffle. The leading hash of the key lets the sort under it compare
    numbers in place of strings.
    """
    rest = [c for c in df.columns if c not in cols.key and c not in order]
    pick = F.max if latest else F.min
    best = df.groupBy(F.xxhash64(*cols.key).alias("_hash"), *cols.key).agg(
        pick(F.struct(*order, *rest)).alias("_best")
    )
    return best.select(
        *[F.col(c) if c in cols.key else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )


def clean_ranks(
    df: DataFrame,
    order: Sequence[str] = (),
    latest: bool = False,
    cols: RankColumns = RANK_COLUMNS,
) -> DataFrame:
    """Fill missing locations, drop duplicate keys and keep the rank columns only."""
    used = df.select(*dict.fromkeys([*cols.all, *order]))
    return drop_duplicate_keys(fill_location(used), order, latest, cols).select(*cols.all)


def duplicate_keys(df: DataFrame, cols: RankColumns = RANK_COLUMNS) -> DataFrame:
    """Keys that occur more than once; empty for a clean table."""
    return df.groupBy(*cols.key).agg(F.count("*").alias("n")).where("n > 1")


def date_range(df: DataFrame, start=None, end=None, cols: RankColumns = RANK_COLUMNS) -> DataFrame:
    """Rows from ``start`` to ``end``, both included; a bound left out is open.

    On a table partitioned by date only the matching partitions are read.
    """
    if start is not None:
        df = df.where(F.col(cols.date) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(cols.date) <= F.lit(end).cast("date"))
    return df
