"""Near duplicates of embeddings: iterative quantisation, multi-index Hamming tables, reranking with the vectors.

Fit: a bounded sample (``MOST_FITTED``, the vectors with the least hash of their id) gives a projection and rotations that
take the unit vectors close to the corners of a cube (Gong and Lazebnik 2011). The signs are a code, ``BITS`` bits for each
rotation. Vectors are compared with those of their own length only. A length with ``LEAST_FITTED`` vectors in the sample
has a fit of its own; the signs of rarer lengths are taken along directions drawn from the length.

Tables: the code is cut into substrings, if need be in several orders of its bits, and vectors that share one are candidates. How wide substrings are and how many
there are follows from the number of vectors and from the sample (``plan``): the cheapest width with which ``LEAST_FOUND`` of
the pairs at the lowest cosine that links meet, if bits differ independently. Codes are signs of the vectors less their mean,
so that bits are balanced, or of the vectors themselves, whichever is cheaper. The former takes a pair further apart, as its
distance is the same and its norms are smaller, and both are reckoned with. Beyond a mean of about 0.9 of the squared norm
nearly all pairs are links, and as many candidates are looked at.

Clusters: each vector is compared with the first one that shares a substring with it. Vectors within half of the link angle
of a common leader are a cluster; any two of them are linked by the triangle inequality, so a group of copies is
counted without looking at its pairs.

Retrieval: a cluster is filed under the substrings of all its vectors, and clusters that meet are candidates. Reranking
takes the cosine of their leaders in double precision. With the clusters' radii it says that all, none or some of the
members are linked; only in the last case are members compared, vector by vector. No pair below the least cosine is linked.
``tests/llm/test_embeddings.py`` measures recall against brute force, with and without a common mean.

Defined cases: vectors that are null, zero, or with null or non-finite components link with nothing, nor do those with a
null id, which get a null component and are kept. Repeated rows count as one vector and are returned as often as they come.
Different vectors of one id are vectors of their own that belong to one component; the id's number of links is the sum of
theirs. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import acos, ceil, comb, cos, log, pi
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankdrift.llm.common import components, small_batches, table, written

LEAST, BITS, MOST_FITTED, LEAST_FITTED, ROUNDS = 0.9, 64, 10_000, 500, 50
#: Share of the pairs at the least cosine that the tables shall find; rotations and tables at most.
LEAST_FOUND, MOST_ROTATIONS, MOST_TABLES = 0.98, 16, 8192
#: Widths of substrings to choose from; what filing a vector in a table costs, in candidates looked at.
WIDTHS, FILING = range(2, 41), 8
#: Share of the pairs at the least cosine that the distance of a code may rule out.
RULED_OUT = 1e-4
#: Slack for rounding of angles.
TINY = 1e-7
#: Filed keys that a task makes from its vectors.
KEYS_A_TASK = 2_000_000


class Plan(NamedTuple):
    """``tables`` substrings of ``width`` bits, and the distance of first codes beyond which a pair isn't looked at."""

    centred: bool
    width: int
    tables: int
    radius: int

    @property
    def rotations(self) -> int:
        return min(MOST_ROTATIONS, ceil(self.tables * self.width / BITS))

    def positions(self) -> np.ndarray:
        """The bits of each table's substring. When the code is used up, it is shuffled and cut anew."""
        bits = self.rotations * BITS
        order = (np.random.default_rng(k).permutation(bits) if k else np.arange(bits) for k in range(ceil(self.tables / (bits // self.width))))
        cut = [bit[: bits // self.width * self.width].reshape(-1, self.width) for bit in order]
        return np.concatenate(cut)[: self.tables]


def fit_codes(x: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """The projection of iterative quantisation on the rows of ``x``: codes are the signs of x @ projection."""
    draw = np.random.default_rng(seed)
    dim = x.shape[1]
    _, axes = np.linalg.eigh(x.T @ x)
    columns, left = [], bits
    while left:  # with fewer dimensions than bits, several rotations
        n = min(left, dim)
        project = axes[:, ::-1][:, :n]
        rotation, _ = np.linalg.qr(draw.standard_normal((n, n)))
        reduced = x @ project
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.where(reduced @ rotation > 0, 1.0, -1.0).T @ reduced)
            rotation = (u @ vt).T
        columns.append(project @ rotation)
        left -= n
    return np.concatenate(columns, axis=1)


def _at_most(differ: np.ndarray, n: int, most: int) -> np.ndarray:
    """The probability that ``most`` of ``n`` bits differ at most, if each does with ``differ``."""
    return sum(comb(n, k) * differ**k * (1 - differ) ** (n - k) for k in range(most + 1))


def plan(samples: list[np.ndarray], rows: int, least: float) -> Plan:
    """The cheapest tables for ``rows`` vectors that find ``LEAST_FOUND`` of the pairs at the cosine ``least`` in each sample."""
    plain = [np.array([acos(least) / pi])] * (len(samples) + 1)  # the last for lengths without a sample
    spread = [np.maximum(((x - x.mean(axis=0)) ** 2).sum(axis=1), 1e-300) for x in samples]
    apart = [np.arccos(np.clip(1 - (1 - least) / around, -1, 1)) / pi for around in spread]
    # Two vectors at random: a bit of theirs is the same with one minus their angle, in parts of pi.
    alike = max((1 - acos(min(1.0, float((x.mean(axis=0) ** 2).sum()))) / pi for x in samples), default=0.5)
    plans = []
    for centred, differ, same in ((True, [*apart, plain[-1]], 0.5), (False, plain, max(alike, 0.5))):
        # Vectors near the mean are the hardest; the radius is theirs.
        hardest = max(float(np.quantile(d, 0.99, method="higher")) for d in differ)
        radius = next(k for k in range(BITS + 1) if k == BITS or 1 - _at_most(hardest, BITS, k) <= RULED_OUT)
        for width in WIDTHS:
            tables = max(_tables(d, width) for d in differ)
            if tables <= MOST_TABLES:
                plans.append((tables * (FILING + rows * same**width / 2), Plan(centred, width, tables, radius)))
    return min(plans)[1]


def _tables(differ: np.ndarray, width: int) -> int:
    """How many substrings find ``LEAST_FOUND`` of pairs whose bits differ with these chances; more than ``MOST_TABLES`` if too many."""
    # Substrings cut from the same bits: the share of bits that differ varies around the chance.
    off = np.sqrt(differ * (1 - differ) / (MOST_ROTATIONS * BITS))
    shared = np.concatenate([(1 - np.clip(differ + z * off, 0, 1)) ** width for z in (-1.5, -0.75, 0, 0.75, 1.5)])
    low, high = 1, MOST_TABLES + 1
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if 1 - ((1 - shared) ** middle).mean() >= LEAST_FOUND else (middle + 1, high)
    return low


def unit_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, size and unit (array<double>) of the different vectors that can link."""
    values = F.col(vector_col).cast("array<double>")
    rows = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), values.alias("v"))
    # The largest component first, so that squares neither overflow nor vanish.
    finite = F.forall("v", lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    rows = rows.withColumn("top", F.array_max(F.transform("v", lambda x: F.abs(x)))).where("top > 0")
    rows = rows.select("id", F.transform("v", lambda x: x / F.col("top")).alias("v")).distinct()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    unit = F.transform("v", lambda x: x / F.col("norm"))
    return rows.withColumn("norm", norm).select("id", F.size("v").alias("size"), unit.alias("unit"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 1))


def _by_size(units: pd.Series) -> Iterator[tuple[int, np.ndarray]]:
    """The lengths of vectors and where vectors of each length are."""
    sizes = units.map(len).to_numpy()
    return ((int(size), np.flatnonzero(sizes == size)) for size in np.unique(sizes))


@lru_cache(maxsize=64)
def _drawn(size: int, rotation: int) -> np.ndarray:
    return np.random.default_rng([size, rotation]).standard_normal((size, BITS))


def _coder(fits: dict[int, tuple[np.ndarray, list[np.ndarray]]], tables: Plan):
    """The first code of a vector and its substrings, each with the number of its table above it."""
    positions = tables.positions()
    powers = 1 << np.arange(tables.width, dtype="i8")
    above = np.arange(tables.tables, dtype="i8") << tables.width

    def code(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for units in columns:
            codes = np.zeros(len(units), "i8")
            keys = np.zeros((len(units), tables.tables), "i8")
            for size, every in _by_size(units):
                mean, projections = fits.get(size, (0.0, None))
                for at in np.array_split(every, ceil(len(every) / 1000)):
                    x = _matrix(units.iloc[at]) - mean
                    bits = np.concatenate(
                        [x @ (projections[k] if projections else _drawn(size, k)) > 0 for k in range(tables.rotations)], axis=1
                    )
                    codes[at] = np.packbits(bits[:, :BITS], axis=1).view(">i8")[:, 0]
                    for k, substring in enumerate(positions):
                        keys[at, k] = bits[:, substring] @ powers
            yield pd.DataFrame({"code": codes, "keys": list(keys + above)})

    return F.pandas_udf(code, "code long, keys array<long>")


def _cosine(a: Column | str, b: Column | str) -> Column:
    def dot(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in pairs:
            out = np.zeros(len(x))
            for _, at in _by_size(x):
                out[at] = np.einsum("ij,ij->i", _matrix(x.iloc[at]), _matrix(y.iloc[at]))
            yield pd.Series(out)

    return F.pandas_udf(dot, T.DoubleType())(a, b)


def _with_vectors(pairs: DataFrame, vectors: DataFrame, *sides: str) -> DataFrame:
    for side in sides:
        pairs = pairs.join(vectors.select(F.col("vec_id").alias(side), F.col("unit").alias(f"unit_{side}")), side)
    return pairs


def clusters(vectors: DataFrame, tables: Plan, tight: float, rounds: int = 2) -> DataFrame:
    """For each vector its cluster (the leader's number, least of its members') and its cosine with the leader, ``tight`` at least.

    ``vectors`` has vec_id, size, unit and keys. Vectors without a leader are clusters of their own.
    """
    # As many tables as find nine in ten of the vectors at that cosine.
    enough = min(tables.tables, ceil(log(0.1) / log(1 - min(1 - acos(tight) / pi, 0.99) ** tables.width)))
    found, left = [], vectors
    for _ in range(rounds):
        filed = _spread(left.select("vec_id", "size", F.slice("keys", 1, enough).alias("keys")), enough).select("vec_id", "size", F.explode("keys").alias("key"))
        # Written, so that adaptive execution can split the vectors of a frequent key in the join.
        first = written(filed.groupBy("size", "key").agg(F.min("vec_id").alias("a")), "first")
        pairs = filed.join(first, ["size", "key"]).where("vec_id <> a").select("a", F.col("vec_id").alias("b")).distinct()
        near = _with_vectors(pairs, left, "a", "b").where(_cosine("unit_a", "unit_b") >= tight)
        group = written(components(written(near.select("a", "b"), "near")), "tight")
        led = _with_vectors(group.select(F.col("node").alias("b"), F.col("component").alias("a")), left, "a", "b")
        led = led.withColumn("cosine", _cosine("unit_a", "unit_b")).where(F.col("cosine") >= tight)
        found.append(led := written(led.select(F.col("b").alias("vec_id"), F.col("a").alias("cluster"), "cosine"), "led"))
        left = left.join(led, "vec_id", "left_anti")
    alone = left.select("vec_id", F.col("vec_id").alias("cluster"), F.lit(1.0).alias("cosine"))
    for led in found:
        alone = alone.unionByName(led)
    return alone


def _spread(vectors: DataFrame, keys: int) -> DataFrame:
    """The vectors over as many tasks as the keys that are made of them need."""
    return vectors.repartition(max(8, ceil(vectors.count() * keys / KEYS_A_TASK)), "vec_id")


def candidates(vectors: DataFrame, tables: Plan) -> DataFrame:
    """Pairs of clusters (a < b) that meet in a Hamming table; ``vectors`` has vec_id, size, code, keys and cluster."""
    filed = _spread(vectors, tables.tables).select("size", "cluster", "code", F.explode("keys").alias("key"))
    # A cluster once for each key. Where several of its codes meet, they can't rule out a pair.
    filed = filed.groupBy("size", "key", "cluster").agg(F.min("code").alias("code"), F.max("code").alias("other"))
    filed = filed.select("size", "key", "cluster", F.when(F.col("code") == F.col("other"), F.col("code")).alias("code"))
    a, b = (filed.select("size", "key", F.col("cluster").alias(s), F.col("code").alias(f"code_{s}")) for s in "ab")
    near = F.coalesce(F.bit_count(F.col("code_a").bitwiseXOR(F.col("code_b"))) <= tables.radius, F.lit(True))
    return a.join(b, ["size", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def _fits(samples: dict[int, np.ndarray], tables: Plan) -> dict[int, tuple[np.ndarray, list[np.ndarray]]]:
    """The mean to take away and the projections, for each length that has a sample."""
    fits = {}
    for size, x in samples.items():
        mean = x.mean(axis=0) if tables.centred else np.zeros(size)
        fits[size] = mean, [fit_codes(x - mean, seed=5 + k) for k in range(tables.rotations)]
    return fits


def embedding_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = LEAST) -> DataFrame:
    """A row for each row of ``vectors``: vec_id, n_links, component_id and kept."""
    small_batches(vectors.sparkSession)
    # Below, vec_id is a number of the vector; that of its row is id.
    units = written(unit_vectors(vectors, id_col, vector_col).withColumn("vec_id", F.monotonically_increasing_id()), "units")
    sample = units.orderBy(F.xxhash64("id"), "vec_id").limit(MOST_FITTED).select("unit").toPandas()["unit"]
    samples = {size: _matrix(sample.iloc[at]) for size, at in _by_size(sample) if len(at) >= LEAST_FITTED}
    tables = plan(list(samples.values()), units.count(), least)
    coded = units.withColumn("coded", _coder(_fits(samples, tables), tables)("unit"))
    coded = written(coded.select("vec_id", "id", "size", "unit", "coded.*"), "coded")

    angle = acos(least)
    member = written(clusters(coded, tables, cos((angle - TINY) / 2)).join(coded.select("vec_id", "id"), "vec_id"), "clusters")
    size = written(member.groupBy("cluster").agg(F.count("*").alias("n"), F.min("cosine").alias("cosine")), "sizes")
    pairs = candidates(coded.drop("unit", "id").join(member.select("vec_id", "cluster"), "vec_id"), tables)

    # Leaders compared; with the radii, what that says of all members.
    for side in "ab":
        pairs = pairs.join(size.select(F.col("cluster").alias(side), F.col("n").alias(f"n_{side}"), F.acos(F.least("cosine", F.lit(1.0))).alias(f"r_{side}")), side)
    pairs = _with_vectors(pairs, coded, "a", "b").withColumn("cosine", _cosine("unit_a", "unit_b")).drop("unit_a", "unit_b")
    between, around = F.acos(F.greatest(F.least("cosine", F.lit(1.0)), F.lit(-1.0))), F.col("r_a") + F.col("r_b")
    single = (F.col("n_a") == 1) & (F.col("n_b") == 1)
    linked = F.when(single, F.col("cosine") >= least).otherwise(between + around <= angle - TINY)
    judged = pairs.withColumn("linked", linked).withColumn("open", ~single & ~linked & (between - around <= angle + TINY))
    judged = written(judged.where("linked OR open").select("a", "b", "n_a", "n_b", "linked"), "judged")
    whole = judged.where("linked")

    # Members of clusters that are linked in part, compared one by one.
    part = judged.where("NOT linked").select(F.col("a").alias("cluster_a"), F.col("b").alias("cluster_b"))
    for side in "ab":
        part = part.join(member.select(F.col("vec_id").alias(side), F.col("cluster").alias(f"cluster_{side}")), f"cluster_{side}")
    part = _with_vectors(part, coded, "a", "b").where(_cosine("unit_a", "unit_b") >= least)
    part = written(part.select("a", "b", "cluster_a", "cluster_b"), "part")

    def both(links: DataFrame, n_b: str | Column, n_a: str | Column, name: str) -> DataFrame:
        """For each side of the links, the sum of the other's numbers."""
        one = links.select(F.col("a").alias(name), F.col(n_b).alias("n") if isinstance(n_b, str) else n_b.alias("n"))
        two = links.select(F.col("b").alias(name), F.col(n_a).alias("n") if isinstance(n_a, str) else n_a.alias("n"))
        return one.unionByName(two).groupBy(name).agg(F.sum("n").alias("n"))

    of_cluster = both(whole, "n_b", "n_a", "cluster").withColumnRenamed("n", "to_clusters")
    of_vector = both(part, F.lit(1), F.lit(1), "vec_id").withColumnRenamed("n", "to_vectors")
    edges = whole.select("a", "b").unionByName(part.select(F.col("cluster_a").alias("a"), F.col("cluster_b").alias("b")))
    # Different vectors of one id are one component.
    several = member.groupBy("id").agg(F.min("cluster").alias("a"), F.max("cluster").alias("last")).where("a <> last")
    edges = edges.unionByName(member.join(several, "id").select("a", F.col("cluster").alias("b")).distinct())
    component = components(edges).withColumnRenamed("node", "cluster")

    links = F.col("n") - 1 + F.coalesce("to_clusters", F.lit(0)) + F.coalesce("to_vectors", F.lit(0))
    grouped = size.select("cluster", "n").join(of_cluster, "cluster", "left").join(component, "cluster", "left")
    found = (
        member.join(grouped, "cluster")
        .join(of_vector, "vec_id", "left")
        .groupBy("id")
        .agg(F.sum(links).alias("n_links"), F.min(F.coalesce("component", "cluster")).alias("component"))
    )
    found = written(found, "found")
    least_id = found.groupBy("component").agg(F.min("id").alias("component_id"))
    found = found.join(least_id, "component").select(F.col("id").alias("vec_id"), "n_links", "component_id")
    ids = vectors.select(F.col(id_col).cast("long").alias("vec_id"))
    out = ids.join(found, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op10_itq_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(table(spark, sf_dir, "embeddings"))


#: For small tables: all pairs of vectors.
OP10_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reached AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e LEFT JOIN (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a) USING (vec_id)
JOIN (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a) c USING (vec_id)"""
