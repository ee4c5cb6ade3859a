"""Which URLs appear most often past a rank cutoff."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankdrift.schema import RANK_COLUMNS, RankColumns


def url_counts(
    df: DataFrame, min_rank_exclusive: int = 10, cols: RankColumns = RANK_COLUMNS
) -> DataFrame:
    """Rows per URL with a rank strictly greater than the cutoff."""
    past = df.where(F.col(cols.rank) > min_rank_exclusive)
    return past.groupBy(cols.entity).agg(F.count("*").alias("n"))


def top_urls(
    df: DataFrame, min_rank_exclusive: int = 10, k: int = 1, cols: RankColumns = RANK_COLUMNS
) -> DataFrame:
    """The ``k`` most frequent URLs past the cutoff; equal counts go by URL."""
    counts = url_counts(df, min_rank_exclusive, cols)
    return counts.orderBy(F.desc("n"), F.col(cols.entity)).limit(k)
