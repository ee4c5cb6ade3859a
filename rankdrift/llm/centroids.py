"""Centroid clustering that rules centroids out by Ptolemy's inequality.

Vectors become integers, so distances, means and ties are exact and don't depend on how rows are laid out. A few of the
first centroids are pivots for good; each vector's squared distances to them are computed once and written beside it.
For a vector x, a centroid c and pivots p, s, Ptolemy's inequality gives

    d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s),

the greatest of which, over all pairs of pivots, costs no look at the vector. A centroid is left out if that bound,
rounded down by more than the roots' rounding errors, is above the least exact distance found so far; all others are
checked exactly, nearest bound first.

A round is one pass over the written vectors: each task adds its vectors up by cluster and returns a row for each of the
``k`` clusters, which Spark adds up. The driver holds the centroids, ``k`` vectors. No vector is shuffled, so copies and
hot clusters cost what other rows cost.

Defined cases: vectors that are null, of another length, or with null or non-finite components are not kept and have no
row. Rows with the same id, or a null one (whose hash is that of the seed alone), are vectors of their own; among equal
hashes the order is by id, then by components. With fewer vectors than ``k`` there are as many centroids as vectors, with
none there are no rows. Equal centroids are allowed: the smaller number wins, the others stay empty. Components are
cut off at ``MOST`` either way, and sums of squares beyond a long show as the largest long. Columns other than the two
named ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdrift.llm.common import batches_of, small_batches, table, written

DIMENSION, SCALE, CLUSTERS, ROUNDS, PIVOTS, SEED = 64, 64, 16, 3, 5, 1
#: Largest component. Up to ``SMALL`` squared distances of up to 64 components are exact in 64 bits; beyond, Python's integers are used.
MOST, SMALL = 1 << 62, 1 << 27
LARGEST = (1 << 63) - 1
#: Relative slack for the rounding of bounds; roots and products are off by a few parts in 2 ** 53.
SLACK = 1e-12


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, dimension: int, scale: int, seed: int) -> DataFrame:
    """vec_id, hash and v (array<bigint>) of the vectors that can be clustered."""
    values = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), values.alias("x"))
    finite = F.forall("x", lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    rows = rows.where(F.coalesce((F.size("x") == dimension) & finite, F.lit(False)))
    # A floor of double is a long in Spark; the bounds of MOST are powers of two and so doubles as well.
    whole = F.transform("x", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(MOST))), F.lit(float(-MOST)))))
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    return rows.select("vec_id", F.sha2(text.cast("binary"), 256).alias("hash"), whole.alias("v"))


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows, as integers: 64-bit ones where they suffice, else Python's."""
    small = max((int(np.abs(a).max()) for a in (x, c) if a.size), default=0) <= SMALL and x.shape[-1] <= 64
    difference = x - c if small else x.astype(object) - c.astype(object)
    return (difference * difference).sum(axis=-1)


def pivots_of(centroids: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Different centroids, each the farthest from those before it."""
    chosen = [0] if len(centroids) else []
    while chosen and len(chosen) < min(most, len(centroids)):
        least = np.min([squares(centroids, centroids[p]) for p in chosen], axis=0)
        farthest = int(np.argmax(least))
        if least[farthest] == 0:
            break
        chosen.append(farthest)
    return centroids[chosen]


def _roots(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64))


def lower_bounds(to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Bounds below the distances (vectors by centroids); ``to_pivots`` are the vectors' squared distances to the pivots."""
    bounds = np.zeros((len(to_pivots), len(centroids)))
    if len(pivots) < 2:
        return bounds
    x, c = _roots(to_pivots), _roots(np.stack([squares(centroids, p) for p in pivots], axis=1))
    for p, s in combinations(range(len(pivots)), 2):
        apart = _roots(squares(pivots[[p]], pivots[s]))[0]
        one, other = np.outer(x[:, p], c[:, s]), np.outer(x[:, s], c[:, p])
        # The products' own rounding counts, not that of their difference, which may be far smaller.
        np.maximum(bounds, (np.abs(one - other) - SLACK * (one + other)) / (apart * (1 + SLACK)), out=bounds)
    return bounds


def assign(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Cluster and squared distance of each vector, and how many exact distances that took."""
    bounds = lower_bounds(to_pivots, centroids, pivots)
    # Squared and rounded down once more, so that integers can be held against them.
    bounds = np.maximum(bounds, 0) ** 2 * (1 - SLACK)
    order = np.argsort(bounds, axis=1, kind="stable")
    n, checked = len(x), 0
    cluster, best = np.full(n, -1), None
    for k in range(len(centroids)):
        candidate = order[:, k]
        if best is None:
            rows = np.arange(n)
        else:
            rows = np.flatnonzero(bounds[np.arange(n), candidate] <= best.astype(np.float64) * (1 + SLACK))
        if not len(rows):
            break
        found = squares(x[rows], centroids[candidate[rows]])
        checked += len(rows)
        if best is None:
            cluster, best = candidate.copy(), found
            continue
        if found.dtype != best.dtype:
            found, best = found.astype(object), best.astype(object)
        nearer = (found < best[rows]) | ((found == best[rows]) & (candidate[rows] < cluster[rows]))
        best[rows[nearer]], cluster[rows[nearer]] = found[nearer], candidate[rows[nearer]]
    return cluster, best if best is not None else np.zeros(n, np.int64), checked


def _lists(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), width)


def _blocks(batches: Iterator[pa.RecordBatch], dimension: int, n_pivots: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            near = [np.frombuffer(x, np.float64) for x in part.column("to_pivots").to_pylist()]
            yield part.column("vec_id"), _lists(part.column("v"), dimension), np.array(near).reshape(-1, n_pivots)


def _with_pivots(rows: DataFrame, pivots: np.ndarray, dimension: int) -> DataFrame:
    """``rows`` with the squared distances to the pivots, as packed doubles."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _lists(batch.column("v"), dimension)
            near = np.stack([squares(x, p).astype(np.float64) for p in pivots], axis=1)
            packed = pa.array([row.tobytes() for row in near], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), packed], ["vec_id", "v", "to_pivots"])

    return rows.select("vec_id", "v").mapInArrow(add, "vec_id long, v array<bigint>, to_pivots binary")


def _sums(rows: DataFrame, centroids: np.ndarray, pivots: np.ndarray, n_pivots: int) -> DataFrame:
    """Per cluster that has vectors: their number and the sums of their components."""
    k, dimension = centroids.shape
    schema = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0)))])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        number, sums = np.zeros(k, np.int64), np.zeros((k, dimension), object)
        for _, x, near in _blocks(batches, dimension, n_pivots):
            cluster, _, _ = assign(x, near, centroids, pivots)
            for c in np.unique(cluster):
                own = x[cluster == c]
                # 2048 rows of small components can't overflow; others are added as Python's integers.
                small = int(np.abs(own).max()) <= SMALL
                number[c] += len(own)
                sums[c] += own.sum(axis=0).astype(object) if small else own.astype(object).sum(axis=0)
        for c in np.flatnonzero(number):
            yield int(c), int(number[c]), [Decimal(int(v)) for v in sums[c]]

    parts = rows.mapInArrow(lambda b: batches_of(add_up(b), schema), "cluster int, n long, sums array<decimal(38,0)>")
    whole = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dimension)]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *whole)


def cluster_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dimension: int = DIMENSION,
    scale: int = SCALE,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    n_pivots: int = PIVOTS,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """A row for each kept vector (vec_id, cluster, distance), and the final centroids."""
    spark = vectors.sparkSession
    small_batches(spark)
    kept = kept_vectors(vectors, id_col, vector_col, dimension, scale, seed)
    first = kept.orderBy("hash", "vec_id", "v").limit(k).collect()  # ``k`` vectors
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, dimension), np.int64)
    centroids = np.array([row.v for row in first], np.int64)
    pivots = pivots_of(centroids, n_pivots)
    held = len(pivots)
    rows = written(_with_pivots(kept, pivots, dimension), "vectors")
    for _ in range(rounds):
        for row in _sums(rows, centroids, pivots, held).collect():  # ``k`` rows
            centroids[row.cluster] = [int(row[f"s{i}"]) // row.n for i in range(dimension)]
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x, near in _blocks(batches, dimension, held):
            cluster, distance, _ = assign(x, near, centroids, pivots)
            distance = np.minimum(distance, LARGEST).astype(np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance)], schema=schema)

    return rows.mapInArrow(assigned, "vec_id long, cluster int, distance long"), centroids


def cluster_report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia and the centroid's digest."""
    spark = assigned.sparkSession
    rows = written(assigned, "assigned")
    by_cluster = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    total = min(sum(int(r.inertia) for r in by_cluster), LARGEST)
    digest = {c: hashlib.sha256(",".join(map(str, v.tolist())).encode()).hexdigest() for c, v in enumerate(centroids)}
    facts = [(r.cluster, min(int(r.inertia), LARGEST), total, digest[r.cluster]) for r in by_cluster]
    # A row for each cluster.
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op11_ptolemaic_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_report(*cluster_vectors(table(spark, sf_dir, "embeddings")))


def _round_sql(k: int, last: bool) -> str:
    """Assignment to the centroids c{k}, and unless it is the last the centroids of the next round."""
    assigned = f"""
a{k} AS MATERIALIZED (
  SELECT row, vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT k.row, k.vec_id, k.v, c.c, list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(k.v, c.v)])::BIGINT AS d
        FROM kept k, c{k} c)
  GROUP BY ALL)"""
    if last:
        return assigned
    return f"""{assigned},
m{k} AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v
  FROM (SELECT c, i, sum(v[i])::HUGEINT AS s, count(*) AS n FROM a{k}, range(1, 65) r(i) GROUP BY ALL) GROUP BY c),
c{k + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{k} c LEFT JOIN m{k} m USING (c))"""


OP11_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v,
         sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h
  FROM embeddings
  WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, vec_id, v) - 1 AS c, v FROM (SELECT * FROM kept ORDER BY h, vec_id, v LIMIT 16)),
{','.join(_round_sql(k, k == ROUNDS) for k in range(ROUNDS + 1))},
by_cluster AS (SELECT c, sum(d)::BIGINT AS cluster_inertia FROM a{ROUNDS} GROUP BY c)
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, cluster_inertia,
       (SELECT sum(d)::BIGINT FROM a{ROUNDS}) AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN by_cluster USING (c) JOIN c{ROUNDS} m USING (c)"""
