"""Signatures of daily result sets and the similarity estimated from them."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankdrift.functions.hashing import (
    COMPAT_COEFFICIENTS,
    ELEMENT_IDS,
    affine_hash,
    coefficients,
    compat_hash,
    element_text,
    first_prime_from,
    split_id,
    string_hash32,
)
from rankdrift.functions.signatures import EMPTY, signature_similarity
from rankdrift.operators.exact import all_pairs, check_two_sets, checked_groups, distinct_elements
from rankdrift.schema import RANK_COLUMNS, RankColumns

# With the date and the group this stays below 100 columns, beyond which Spark gives up generated code by default.
K = 96


def _minima(rows: DataFrame, hashes: Sequence[str], cols: RankColumns, more: dict[str, str] | None = None) -> DataFrame:
    """Element-wise minimum per date and group as plain columns, then one array; ``more`` are other aggregates by name.

    ``hashes`` and ``more`` are SQL texts. Separate columns keep the aggregation in
    fixed-width buffers that combine before the shuffle; what is shuffled does
    not grow with the sets.
    """
    more = more or {}
    minima = rows.groupBy(cols.date, cols.group).agg(
        *[F.expr(f"min({h}) AS _h{i}") for i, h in enumerate(hashes)],
        *[F.expr(f"{aggregate} AS {name}") for name, aggregate in more.items()],
    )
    signature = ", ".join(f"_h{i}" for i in range(len(hashes)))
    return minima.select(cols.date, cols.group, F.expr(f"array({signature}) AS sig"), *more)


def _bin_minima(ids: DataFrame, k: int, cols: RankColumns) -> DataFrame:
    """The smallest element id per date, group and residue modulo ``k``, as one array."""
    bins = ids.groupBy(cols.date, cols.group, F.pmod("_id", F.lit(k)).alias("_bin")).agg(
        F.min("_id").alias("_low")
    )
    # At most k entries come together per date and group.
    found = bins.groupBy(cols.date, cols.group).agg(
        F.map_from_entries(F.collect_list(F.struct("_bin", "_low"))).alias("_found")
    )
    signature = f"transform(sequence(0L, {k - 1}L), i -> coalesce(_found[i], {EMPTY}L)) AS sig"
    return found.select(cols.date, cols.group, F.expr(signature))


def minhash_signatures(
    df: DataFrame,
    k: int | None = None,
    pairs: Sequence[tuple[int, int]] | None = None,
    element_id: str = "xxhash64",
    method: str = "functions",
    cols: RankColumns = RANK_COLUMNS,
) -> DataFrame:
    """One signature of ``k`` hash minima (``K`` by default) per date and device.

    ``method="functions"`` hashes every element with ``k`` functions; ``pairs``
    are their coefficients (a, b), by default ``coefficients(k)``.
    ``method="bins"`` hashes it once and keeps the minimum of each of ``k``
    bins. That costs a fraction of the time and is as good for sets much larger
    than ``k``; bins of smaller sets may stay empty.

    ``element_id`` is ``"xxhash64"`` or ``"md5"``. Only signatures made with the
    same settings can be compared or merged.
    """
    if method not in ("functions", "bins"):
        raise ValueError(f"unknown method: {method}")
    if element_id not in ELEMENT_IDS:
        raise ValueError(f"unknown element id: {element_id}")
    if pairs is not None and (method == "bins" or k not in (None, len(pairs))):
        raise ValueError("pairs of coefficients are for hash functions, and are k")
    k = len(pairs) if pairs is not None else K if k is None else k
    ids = df.select(cols.date, cols.group, ELEMENT_IDS[element_id](cols.element).alias("_id"))
    if method == "bins":
        return _bin_minima(ids, k, cols)
    return signatures_of_ids(ids, coefficients(k) if pairs is None else pairs, cols)


def signatures_of_ids(
    ids: DataFrame,
    pairs: Sequence[tuple[int, int]],
    cols: RankColumns = RANK_COLUMNS,
    more: dict[str, str] | None = None,
) -> DataFrame:
    """Signatures of sets whose elements are known by 60-bit numbers ``_id``, per date and set.

    ``more`` names other aggregates (SQL text) of the columns of ``ids``, which then stand beside the signature.
    """
    high, low = split_id(F.col("_id"))
    others = [c for c in ids.columns if more and c not in (cols.date, cols.group, "_id")]
    parts = ids.select(cols.date, cols.group, *others, high.alias("_high"), low.alias("_low"))
    return _minima(parts, [affine_hash("_high", "_low", a, b) for a, b in pairs], cols, more)


def compat_modulus(df: DataFrame, cols: RankColumns = RANK_COLUMNS) -> int:
    """The usual modulus of compat signatures of ``df``: the first prime from its number of distinct elements on.

    Runs one job; a single number comes to the driver. Signatures can be merged only if they share a modulus, so keep it with them.
    """
    return first_prime_from(distinct_elements(df, cols).first().n)


def compat_signatures(
    df: DataFrame,
    modulus: int,
    pairs: Sequence[tuple[int, int]] = COMPAT_COEFFICIENTS,
    cols: RankColumns = RANK_COLUMNS,
) -> DataFrame:
    """Signatures from 32-bit string hashes and a caller-chosen modulus.

    The usual modulus is ``compat_modulus`` of the whole table.
    """
    # The string hash is slow, so each element is hashed once.
    text = element_text(cols.element, separator="").alias("_text")
    elements = df.select(cols.date, cols.group, text).distinct()
    seeds = elements.select(cols.date, cols.group, string_hash32(F.col("_text")).alias("_seed"))
    return _minima(seeds, [compat_hash("_seed", a, b, modulus) for a, b in pairs], cols)


def pairwise_signature_similarity(
    signatures: DataFrame,
    groups: Sequence[str] | None = None,
    estimator: str = "positional",
    cols: RankColumns = RANK_COLUMNS,
) -> DataFrame:
    """Similarity per date for pairs of sets.

    Which pairs have a row is as in ``pairwise_exact_similarity``; a set that has only an empty signature is no set.
    Partial signatures of a set are an error: merge them first.
    """
    checked_groups(groups)
    a, b = f"{cols.group}_a", f"{cols.group}_b"
    unmerged = F.raise_error("partial signatures: merge them first").cast("array<bigint>")
    one = F.when(F.count("*") > 1, unmerged).otherwise(F.min("sig")).alias("sig")
    known = signatures.where(F.size("sig") > 0).groupBy(cols.date, cols.group).agg(one)
    sides = [known.select(cols.date, F.col(cols.group).alias(s), F.col("sig").alias(f"_{s}")) for s in (a, b)]
    if groups is None:
        both = all_pairs(known, signatures.select(cols.date).distinct(), cols, {"sig": "_"})
    else:
        pairs = [F.struct(F.lit(x).alias(a), F.lit(y).alias(b)) for x, y in combinations(groups, 2)]
        both = signatures.select(cols.date).distinct().select(cols.date, F.inline(F.array(*pairs)))
        both = both.join(sides[0], [cols.date, a], "left").join(sides[1], [cols.date, b], "left")
    x, y = F.col(f"_{a}"), F.col(f"_{b}")
    similarity = F.when(x.isNull() | y.isNull(), 0).otherwise(signature_similarity(x, y, estimator))
    return both.select(cols.date, a, b, similarity.alias("similarity"))


def signature_pairs(
    signatures: DataFrame,
    devices: Sequence[str] | None = None,
    estimator: str = "positional",
    cols: RankColumns = RANK_COLUMNS,
) -> DataFrame:
    """Similarity of two devices per date of ``signatures`` in date order, 0 where one of them is missing.

    Without ``devices`` the two sets that a date has are compared, and a date with more is an error.
    """
    if devices is not None:
        if len(set(devices)) != 2:
            raise ValueError("name two devices")
        pairs = pairwise_signature_similarity(signatures, devices, estimator, cols)
        return pairs.select(cols.date, "similarity").orderBy(cols.date)
    filled = F.when(F.size("sig") > 0, F.struct(cols.group, "sig"))
    sides = signatures.groupBy(cols.date).agg(
        F.count_distinct(F.when(F.size("sig") > 0, F.col(cols.group))).alias("_sets"),
        F.count(filled).alias("_rows"),
        F.min(filled).alias("_a"),
        F.max(filled).alias("_b"),
    )
    unmerged = F.raise_error("partial signatures: merge them first").cast("int")
    similarity = F.when(F.col("_sets") < 2, 0).otherwise(signature_similarity(F.col("_a.sig"), F.col("_b.sig"), estimator))
    checked = F.when((F.col("_rows") > F.col("_sets")) & (F.col("_sets") <= 2), unmerged).otherwise(
        check_two_sets(F.col("_sets"), similarity)
    )
    return sides.select(cols.date, checked.alias("similarity")).orderBy(cols.date)


def minhash_similarity(
    df: DataFrame,
    devices: Sequence[str] | None = None,
    k: int | None = None,
    pairs: Sequence[tuple[int, int]] | None = None,
    element_id: str | None = None,
    method: str | None = None,
    modulus: int | None = None,
    estimator: str | None = None,
    semantics: str = "set",
    cols: RankColumns = RANK_COLUMNS,
) -> DataFrame:
    """Estimated percent of elements that two devices share, per date of ``df`` in date order.

    Devices are chosen as in ``exact_similarity``. ``semantics="compat"`` needs a ``modulus``, has its own element ids,
    and compares signatures as sets of values unless another ``estimator`` is named. Arguments that don't go together
    are an error.
    """
    if semantics not in ("set", "compat"):
        raise ValueError(f"unknown semantics: {semantics}")
    if devices is not None:
        # Dates that have neither device keep a row, by a set without elements.
        empty = [F.lit(devices[0]).alias(cols.group), F.array().cast("array<bigint>").alias("sig")]
        dates = df.select(cols.date).distinct().select(cols.date, *empty)
        df = df.where(F.col(cols.group).isin(*devices))
    if semantics == "compat":
        if modulus is None:
            raise ValueError("compat signatures need a modulus")
        if not (k is None and element_id is None and method is None):
            raise ValueError("compat signatures take pairs and a modulus only")
        signatures = compat_signatures(df, modulus, COMPAT_COEFFICIENTS if pairs is None else pairs, cols)
    else:
        if modulus is not None:
            raise ValueError("only compat signatures have a modulus")
        signatures = minhash_signatures(df, k, pairs, element_id or "xxhash64", method or "functions", cols)
    if devices is not None:
        signatures = signatures.unionByName(dates)
    return signature_pairs(signatures, devices, estimator or ("value_set" if semantics == "compat" else "positional"), cols)


def merge_signature_rows(
    signatures: DataFrame, k: int = K, cols: RankColumns = RANK_COLUMNS
) -> DataFrame:
    """Combine all partial signatures of a date and device by element-wise minimum.

    Empty signatures are skipped; a key that has only empty ones keeps an empty
    one. A signature of another length than ``k`` is an error.
    """
    fits = F.coalesce(F.size("sig"), F.lit(0)).isin(-1, 0, k)
    stop = F.raise_error(f"signature of another length than {k}").cast("boolean")
    fitting = signatures.where(F.when(fits, True).otherwise(stop))
    minima = fitting.groupBy(cols.date, cols.group).agg(
        *[F.expr(f"min(get(sig, {i})) AS _h{i}") for i in range(k)]
    )
    merged = ", ".join(f"_h{i}" for i in range(k))
    return minima.select(cols.date, cols.group, F.expr(f"array_compact(array({merged})) AS sig"))
