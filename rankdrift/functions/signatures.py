"""Column functions on signatures held as ``ARRAY<BIGINT>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Larger than any hash value: an empty position of a binned signature.
EMPTY = 2**63 - 1


def merge_signatures(a: Column, b: Column) -> Column:
    """Element-wise minimum of two signatures; an empty or NULL one changes nothing."""
    empty_a = F.coalesce(F.size(a) <= 0, F.lit(True))
    empty_b = F.coalesce(F.size(b) <= 0, F.lit(True))
    return F.when(empty_a, b).when(empty_b, a).otherwise(F.zip_with(a, b, lambda x, y: F.least(x, y)))


def positional_similarity(a: Column, b: Column) -> Column:
    """Percent of positions on which two signatures agree, not counting empty ones."""
    both = F.zip_with(a, b, lambda x, y: F.struct(F.least(x, y).alias("low"), (x == y).alias("same")))
    filled = F.filter(both, lambda p: p["low"] < EMPTY)
    return percent(F.size(F.filter(filled, lambda p: p["same"])), F.size(filled))


def value_set_similarity(a: Column, b: Column) -> Column:
    """Percent of shared values, whatever their position, not counting empty ones."""
    a, b = (F.filter(s, lambda x: x < EMPTY) for s in (a, b))
    return percent(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))


ESTIMATORS = {"positional": positional_similarity, "value_set": value_set_similarity}


def signature_similarity(a: Column, b: Column, estimator: str = "positional") -> Column:
    return ESTIMATORS[estimator](a, b)


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, cut off to an integer; 0 of nothing is 0."""
    shared = F.call_function("div", part.cast("bigint") * 100, whole.cast("bigint"))
    return F.when(whole > 0, shared).otherwise(0).cast("int")
