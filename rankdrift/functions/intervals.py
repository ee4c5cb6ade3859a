"""How far an estimate from a signature can be off."""

from __future__ import annotations

from functools import lru_cache
from math import ceil, exp, floor, lgamma, log

from pyspark.sql import Column
from pyspark.sql import functions as F


def _at_least(agree: int, k: int, share: float) -> float:
    """The probability that ``agree`` or more of ``k`` positions agree, if each does with ``share``."""
    if agree <= 0 or share >= 1:
        return 1.0
    if share <= 0:
        return 0.0
    terms = (lgamma(k + 1) - lgamma(j + 1) - lgamma(k - j + 1) + j * log(share) + (k - j) * log(1 - share) for j in range(agree, k + 1))
    return min(1.0, sum(map(exp, terms)))


def _share_at(agree: int, k: int, chance: float) -> float:
    """The share with which ``agree`` or more agree with probability ``chance``; this grows with the share."""
    low, high = 0.0, 1.0
    for _ in range(40):
        middle = (low + high) / 2
        low, high = (middle, high) if _at_least(agree, k, middle) < chance else (low, middle)
    return low


@lru_cache
def agreement_bounds(k: int, confidence: float) -> tuple[tuple[int, int], ...]:
    """For 0 to ``k`` agreeing positions the least and greatest similarity in percent.

    These are exact binomial bounds: whatever the similarity is, it lies within them with ``confidence`` at least.
    """
    miss = (1 - confidence) / 2
    low = [0.0, *(_share_at(a, k, miss) for a in range(1, k + 1))]
    high = [*(_share_at(a + 1, k, 1 - miss) for a in range(k)), 1.0]
    return tuple((floor(100 * a), ceil(100 * b)) for a, b in zip(low, high, strict=True))


def interval(agree: Column, k: int, confidence: float) -> Column:
    """A struct of ``low`` and ``high``, in percent, for a number of agreeing positions."""
    bounds = [F.struct(F.lit(low).alias("low"), F.lit(high).alias("high")) for low, high in agreement_bounds(k, confidence)]
    return F.get(F.array(*bounds), agree)
