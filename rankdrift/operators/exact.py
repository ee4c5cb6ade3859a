"""Exact similarity of the result sets of two devices, per day."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankdrift.functions.hashing import element_text, xxhash_id
from rankdrift.functions.signatures import percent
from rankdrift.schema import RANK_COLUMNS, RankColumns

def _element_key(element_key: str, cols: RankColumns) -> list[Column]:
    """Grouping columns that stand for an element.

    ``"columns"`` groups by the columns themselves. ``"hash"`` shuffles a
    128-bit hash of them in place of the strings.
    """
    if element_key == "columns":
        return [F.col(c) for c in cols.element]
    if element_key == "hash":
        parts = [p for c in cols.element for p in (F.col(c), F.isnull(c))]
        return [F.xxhash64(*parts).alias("_h1"), F.xxhash64(F.lit(1), *parts).alias("_h2")]
    raise ValueError(f"unknown element key: {element_key}")


def checked_groups(groups: Sequence[str] | None, least: int = 2) -> None:
    if groups is not None and (len(groups) < least or len(set(groups)) != len(groups)):
        raise ValueError("give two or more different groups")


def check_two_sets(n_sets: Column, value: Column) -> Column:
    """``value``, or an error if there are more than two sets to compare."""
    stop = F.raise_error("more than two sets on a date: name two, or compare pairwise").cast("int")
    return F.when(n_sets > 2, stop).otherwise(value)


def all_pairs(sets: DataFrame, dates: DataFrame, cols: RankColumns, payload: dict[str, str]) -> DataFrame:
    """Every two ``sets`` of a date as ``{group}_a`` < ``{group}_b``, and a row of its own for a date that has no two.

    ``sets`` has a row for each date and set. Its ``payload`` columns are named after the side, with a prefix. In a
    date's own row the second set is NULL, and the first one too if the date has none.
    """
    a, b = f"{cols.group}_a", f"{cols.group}_b"
    sides = [
        sets.select(cols.date, F.col(cols.group).alias(s), *(F.col(c).alias(f"{prefix}{s}") for c, prefix in payload.items()))
        for s in (a, b)
    ]
    both = sides[0].join(sides[1], cols.date).where(F.col(a) < F.col(b))
    single = sets.groupBy(cols.date).agg(F.count("*").alias("_sets"), F.min(cols.group).alias(a))
    alone = dates.join(single, cols.date, "left").where(F.coalesce("_sets", F.lit(0)) < 2)
    return both.unionByName(alone.select(cols.date, a), allowMissingColumns=True)


def group_pairs(
    counts: DataFrame, groups: Sequence[str] | None, cols: RankColumns
) -> DataFrame:
    """One row per date and unordered pair of sets, out of ``counts`` (date, ``_groups``, ``_n``).

    A count says how many elements of the date are in just those groups. Pairs are rows, so the plan is the same for
    any number of groups.
    """
    a, b = f"{cols.group}_a", f"{cols.group}_b"
    sizes = counts.select(cols.date, F.explode("_groups").alias("_group"), "_n")
    sizes = sizes.groupBy(cols.date, "_group").agg(F.sum("_n").alias("_size"))
    pairs = F.flatten(
        F.transform(
            "_groups",
            lambda x, i: F.transform(
                F.slice("_groups", i + 2, F.size("_groups")), lambda y: F.struct(x.alias(a), y.alias(b))
            ),
        )
    )
    shared = counts.select(cols.date, F.explode(pairs).alias("_pair"), "_n")
    shared = shared.groupBy(cols.date, f"_pair.{a}", f"_pair.{b}").agg(F.sum("_n").alias("_shared"))
    if groups is not None:
        # Counts keep their pairs in sorted order; the names give the order of the result.
        named = [F.struct(F.lit(x).alias(a), F.lit(y).alias(b), F.lit(min(x, y)).alias("_a"), F.lit(max(x, y)).alias("_b"))
                 for x, y in combinations(groups, 2)]
        wanted = counts.select(cols.date).distinct().select(cols.date, F.inline(F.array(*named)))
        shared = shared.withColumnsRenamed({a: "_a", b: "_b"})
        shared = wanted.join(shared, [cols.date, "_a", "_b"], "left").drop("_a", "_b")
    else:
        wanted = all_pairs(sizes.withColumnRenamed("_group", cols.group), counts.select(cols.date).distinct(), cols, {})
        shared = wanted.join(shared, [cols.date, a, b], "left")
    for side in (a, b):
        size = sizes.select(cols.date, F.col("_group").alias(side), F.col("_size").alias(f"_size_{side}"))
        shared = shared.join(size, [cols.date, side], "left")
    both, sides = F.coalesce("_shared", F.lit(0)), [F.coalesce(f"_size_{s}", F.lit(0)) for s in (a, b)]
    return shared.select(cols.date, a, b, percent(both, sides[0] + sides[1] - both).alias("similarity"))


def pairwise_exact_similarity(
    df: DataFrame,
    groups: Sequence[str] | None = None,
    element_key: str = "columns",
    cols: RankColumns = RANK_COLUMNS,
) -> DataFrame:
    """Percent of shared elements per date, for pairs of sets.

    Without ``groups`` every two sets of a date have a row, 0 if they share nothing, and a date with one set has a row in
    which the other set is NULL. That is meant for a few sets, such as devices: for many of them use ``similar_sets``.
    With ``groups`` there is a row for every date of ``df`` and every pair of the names, 0 where one side has no rows.
    """
    checked_groups(groups)
    own = F.col(cols.group) if groups is None else F.when(F.col(cols.group).isin(*groups), F.col(cols.group))
    elements = df.groupBy(cols.date, *_element_key(element_key, cols)).agg(
        F.sort_array(F.collect_set(own)).alias("_groups")
    )
    counts = elements.groupBy(cols.date, "_groups").agg(F.count("*").alias("_n"))
    return group_pairs(counts, groups, cols)


def exact_similarity(
    df: DataFrame,
    devices: Sequence[str] | None = None,
    semantics: str = "set",
    element_key: str = "columns",
    cols: RankColumns = RANK_COLUMNS,
) -> DataFrame:
    """Percent of elements that two devices share, per date in date order.

    Without ``devices`` the two sets that a date has are compared, and a date with more is an error; with ``devices`` rows
    of others don't count. A date with fewer than two of the sets has 0, so every date of ``df`` has a row.

    ``"set"`` is the Jaccard similarity of the two sets. ``"compat"`` counts rows in place of devices, so copies within
    one device count as shared and results can pass 100.
    """
    if devices is not None and len(set(devices)) != 2:
        raise ValueError("name two devices")
    if semantics not in ("set", "compat"):
        raise ValueError(f"unknown semantics: {semantics}")
    group = F.col(cols.group)
    ours = F.lit(True) if devices is None else group.isin(*devices)
    # A set is known by a hash, so that the buffer is fixed in width. ``_low`` and ``_high`` differ for a shared element.
    known = F.when(ours, F.xxhash64(cols.group))
    elements = df.groupBy(cols.date, *_element_key(element_key, cols)).agg(
        F.min(known).alias("_low"), F.max(known).alias("_high"), F.count_if(ours).alias("_copies")
    )
    either = F.count("_low")
    both = F.count_if(F.col("_low") != F.col("_high")) if semantics == "set" else F.sum("_copies") - either
    similar = elements.groupBy(cols.date).agg(percent(both, either).alias("similarity"))
    if devices is None and semantics == "set":
        sets = df.groupBy(cols.date).agg(F.count_distinct(cols.group).alias("_sets"))
        similar = similar.join(sets, cols.date).withColumn(
            "similarity", check_two_sets(F.col("_sets"), F.col("similarity"))
        )
    return similar.select(cols.date, "similarity").orderBy(cols.date)


def sketch_similarity(
    df: DataFrame,
    devices: Sequence[str] | None = None,
    log_entries: int = 12,
    cols: RankColumns = RANK_COLUMNS,
) -> DataFrame:
    """``exact_similarity`` from theta sketches: no shuffle of elements.

    An estimate: a sketch keeps about ``2 ** log_entries`` hashes, and the error of a similarity is about
    50 / sqrt(2 ** log_entries) percent points for sets much larger than that.
    """
    if devices is not None and len(set(devices)) != 2:
        raise ValueError("name two devices")
    ours = F.lit(True) if devices is None else F.col(cols.group).isin(*devices)
    members = df.select(cols.date, cols.group, ours.alias("_ours"), xxhash_id(cols.element).alias("_element"))
    sketches = members.groupBy(cols.date, F.when(F.col("_ours"), F.col(cols.group)).alias("_set")).agg(
        F.theta_sketch_agg("_element", log_entries).alias("_sketch")
    )
    # A date has a few sets; the first two are compared.
    found = F.filter(F.collect_list(F.when(F.col("_set").isNotNull(), F.col("_sketch"))), lambda s: s.isNotNull())
    sides = sketches.groupBy(cols.date).agg(found.alias("_sketches"))
    a, b = F.get("_sketches", F.lit(0)), F.get("_sketches", F.lit(1))
    both = F.theta_sketch_estimate(F.theta_intersection(a, b))
    either = F.theta_sketch_estimate(F.theta_union(a, b, log_entries))
    similarity = F.when(F.size("_sketches") < 2, 0).otherwise(percent(both, either))
    return sides.select(
        cols.date, check_two_sets(F.size("_sketches"), similarity).alias("similarity")
    ).orderBy(cols.date)


def distinct_elements(df: DataFrame, cols: RankColumns = RANK_COLUMNS) -> DataFrame:
    """Number of different elements over all dates and devices, in one row."""
    elements = df.select(element_text(cols.element, separator="").alias("_element")).distinct()
    return elements.agg(F.count("*").alias("n"))
