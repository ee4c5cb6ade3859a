"""Which sets of a day are similar, among any number of sets.

Comparing every two sets of a date takes the square of their number. Here sets meet only if they agree on a band of
their MinHash signature, so the join is on (date, hash of the band). Where sets are drawn from few elements, many unlike ones
meet; a bitmap of each set tells most of them apart within the join, so they are never written. Pairs that are left are
confirmed on the sets themselves: what is returned is exact, and a pair at the least similarity is missed with a
probability of ``MISS`` (less the more similar it is).

Equal sets are one class with a representative, so a thousand copies of a list don't make half a million pairs.
"""

from __future__ import annotations

from math import ceil, log
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankdrift.functions.hashing import coefficients
from rankdrift.operators.minhash import signatures_of_ids
from rankdrift.schema import RANK_COLUMNS, RankColumns

MISS = 1e-5
# With the keys, the size and the bitmap this stays below 100 columns, beyond which Spark gives up generated code.
MOST_HASHES = 92
# A set's bitmap has 64 bits in each word. Each element sets one.
WORDS = 4


class SimilarSets(NamedTuple):
    """``members``: date, set, ``representative`` and number of elements of every set. ``pairs``: date, both
    representatives in order and their ``similarity``."""

    members: DataFrame
    pairs: DataFrame


def banding(least: int, miss: float = MISS, most_hashes: int = MOST_HASHES) -> tuple[int, int]:
    """Rows and bands that miss a pair of similarity ``least`` (percent) with a probability of ``miss`` at most.

    As many rows as ``most_hashes`` allows, since longer bands bring fewer unlike sets together.
    """
    if not 1 <= least <= 100:
        raise ValueError("the least similarity is a percentage from 1 to 100")
    best = None
    for rows in range(1, most_hashes + 1):
        agree = (least / 100) ** rows
        bands = 1 if agree == 1 else ceil(log(miss) / log(1 - agree)) if agree > 1e-12 else most_hashes + 1
        if rows * bands <= most_hashes:
            best = rows, bands
    if best is None:
        raise ValueError(f"a least similarity of {least}% takes more than {most_hashes} hash functions")
    return best


def bitmap(bits: str = "_h2") -> dict[str, str]:
    """The words of a set's bitmap as aggregates (SQL text) of its elements' 64-bit hashes."""
    bit = f"shiftleft(1L, cast({bits} & 63 AS int))"
    return {f"_w{n}": f"bit_or(if((shiftright({bits}, 6) & {WORDS - 1}) = {n}, {bit}, 0L))" for n in range(WORDS)}


def meeting_pairs(signatures: DataFrame, least: int, rows: int, bands: int, cols: RankColumns = RANK_COLUMNS) -> DataFrame:
    """Pairs of sets (``{group}_a`` < ``{group}_b``) of a date that agree on a band of their signatures, with their sizes.

    ``signatures`` has the size ``n`` and the ``bitmap`` of each set, too. A bit that only one of two sets has is an
    element that only that one has, so differing bits, and the difference of the sizes, are at most the elements in
    which the sets differ. Pairs for which that is too many for a similarity of ``least`` are left out.
    """
    a, b = f"{cols.group}_a", f"{cols.group}_b"
    band = [F.xxhash64(F.lit(n), F.slice("sig", n * rows + 1, rows)) for n in range(bands)]
    facts = ["n", *bitmap()]
    filed = signatures.select(cols.date, cols.group, *facts, F.explode(F.array(*band)).alias("_band"))
    keys = [cols.date, "_band"]
    one, other = (
        filed.select(*keys, F.col(cols.group).alias(side), *(F.col(c).alias(f"{c}_{side}") for c in facts)) for side in (a, b)
    )
    n_a, n_b = F.col(f"n_{a}"), F.col(f"n_{b}")
    bits = sum((F.bit_count(F.col(f"{w}_{a}").bitwiseXOR(F.col(f"{w}_{b}"))) for w in bitmap()), F.lit(0))
    # Of sets with s elements in all that differ in d, 100 (s - d) / (s + d) percent are shared.
    may_be = F.greatest(F.abs(n_a - n_b), bits) * (100 + least) <= (n_a + n_b) * (100 - least)
    met = one.join(other, keys).where((F.col(a) < F.col(b)) & may_be)
    return met.select(cols.date, a, b, n_a, n_b).distinct()


def similar_sets(
    df: DataFrame, least: int, miss: float = MISS, cols: RankColumns = RANK_COLUMNS
) -> SimilarSets:
    """Classes of equal sets, and the pairs of different ones whose similarity is ``least`` percent or more, per date.

    Elements are known by 128-bit hashes; NULL and "" are different, as in ``pairwise_exact_similarity``.
    """
    rows, bands = banding(least, miss)
    a, b, key = f"{cols.group}_a", f"{cols.group}_b", [cols.date, cols.group]
    parts = [p for c in cols.element for p in (F.col(c), F.isnull(c))]

    def distinct_elements(df: DataFrame) -> DataFrame:
        return df.select(*key, F.xxhash64(*parts).alias("_h1"), F.xxhash64(F.lit(1), *parts).alias("_h2")).distinct()

    def fingerprints(elements: DataFrame) -> DataFrame:
        xors = (F.bit_xor("_h1").alias("_x1"), F.bit_xor("_h2").alias("_x2"))
        return elements.groupBy(*key).agg(F.count("*").alias("n"), *xors)

    prints = fingerprints(distinct_elements(df))
    same = [cols.date, "n", "_x1", "_x2"]
    classes = prints.groupBy(*same).agg(F.min(cols.group).alias("representative"))
    members = prints.join(classes, same).select(*key, "representative", "n")

    # Pairs are of sets that have a date and a name. All that follows takes the same columns of the same elements, so
    # that Spark shuffles them once by element and once by set.
    named = distinct_elements(df.where(F.col(cols.date).isNotNull() & F.col(cols.group).isNotNull()))
    named_prints = fingerprints(named).groupBy(*same).agg(F.min(cols.group).alias(cols.group))
    own = named.join(named_prints.select(*key), key, "left_semi")
    ids = own.select(*key, F.shiftrightunsigned("_h1", 4).alias("_id"), "_h2")
    signatures = signatures_of_ids(ids, coefficients(rows * bands), cols, {"n": "count(*)"} | bitmap())
    met = meeting_pairs(signatures, least, rows, bands, cols)
    n_a, n_b = F.col(f"n_{a}"), F.col(f"n_{b}")
    # The elements of the smaller set are looked up in the larger one.
    small, large = F.when(n_a <= n_b, F.col(a)).otherwise(F.col(b)), F.when(n_a <= n_b, F.col(b)).otherwise(F.col(a))
    met = met.select(cols.date, a, b, (n_a + n_b).alias("_both"), small.alias("_small"), large.alias("_large"))
    looked_up = met.join(own.withColumnRenamed(cols.group, "_small"), [cols.date, "_small"])
    found = looked_up.join(own.withColumnRenamed(cols.group, "_large"), [cols.date, "_large", "_h1", "_h2"])
    shared = found.groupBy(cols.date, a, b, "_both").agg(F.count("*").alias("_shared"))
    similarity = F.expr("cast(_shared * 100 div (_both - _shared) AS int)")
    pairs = shared.select(cols.date, a, b, similarity.alias("similarity")).where(F.col("similarity") >= least)
    return SimilarSets(members, pairs)


def every_pair(similar: SimilarSets, cols: RankColumns = RANK_COLUMNS) -> DataFrame:
    """The pairs of all sets rather than of representatives, equal sets among them: as many rows as there are such pairs."""
    a, b = f"{cols.group}_a", f"{cols.group}_b"
    sides = [
        similar.members.select(cols.date, F.col(cols.group).alias(f"_{s}"), F.col("representative").alias(s)) for s in (a, b)
    ]
    between = similar.pairs.join(sides[0], [cols.date, a]).join(sides[1], [cols.date, b])
    # The smaller name first, whichever class it is of.
    between = between.select(cols.date, F.least(f"_{a}", f"_{b}").alias(a), F.greatest(f"_{a}", f"_{b}").alias(b), "similarity")
    one, other = (
        similar.members.select(cols.date, "representative", F.col(cols.group).alias(s)) for s in (a, b)
    )
    within = one.join(other, [cols.date, "representative"]).where(F.col(a) < F.col(b))
    return between.unionByName(within.select(cols.date, a, b, F.lit(100).alias("similarity")))
