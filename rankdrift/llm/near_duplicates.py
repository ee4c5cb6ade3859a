"""Near duplicates by MinHash with tensored banding.

A text's set holds the hashes of its distinct five-word shingles. Two collections of partial keys are formed for it:
``sides[0]`` keys of ``rows[0]`` minhashes each and ``sides[1]`` keys of ``rows[1]``. A table key joins one partial key of either
collection, so 10 x 16 tables of 5 minhashes each need 10 x 2 + 16 x 3 = 68 minhashes, not 800. Two texts meet in a table
if they agree on any key of the first collection and any of the second. At a similarity of 0.75 they miss each other
with a probability of (1 - 0.75 ** 2) ** 10 + (1 - 0.75 ** 3) ** 16 = 0.0004, at 0.85 of 0.000003. How many keys and
minhashes there are follows from the number of documents (``banding_of``): longer keys keep unrelated texts apart, and more
tables keep the probability of a miss where it is.

Texts with the same set are one class and are compared once. In each table bucket all members are paired with its most
central one, which shares the most buckets with others. Pairs that a one-permutation sketch of ``BINS`` bins leaves
possible are confirmed on the full sets, and links are joined to components. Members of a bucket that still lie in
different components are then paired among each other: in small buckets by a join, in larger ones inside a task, block
by block, so that only pairs that the sketch leaves possible are emitted. These are confirmed as well. So every two
texts that meet in a table are linked by confirmed links, or were compared and are not similar, without emitting all
pairs of a group of copies.

Defined cases: a text without words (null, empty, white space) has an empty set and links with nothing. A text of fewer
than five words has one shingle, the whole sequence. A null id gets a null component and is kept. Rows with the same id
count as one document where both stand for a class. Repeated rows are returned as often as they come. Columns other
than the two named ones are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdrift.llm.common import batches_of, components, rows_of, small_batches, table, words_of, written

SHINGLE = 5
PERCENT = 75
#: Bound of the probability that two texts of the least similarity share no table.
MISSED = 0.00042
#: Similarity that unrelated texts are taken to have, what a pair of them costs in table keys (by bytes shuffled, about
#: 1,200 to 24), and the most minhashes in a partial key.
UNRELATED, PAIR_COST, MOST_ROWS = 0.03, 50, 6
#: Bins of the sketch, and how many standard deviations below the least similarity its estimate may lie.
BINS, DEVIATIONS = 512, 4
#: Members of a bucket that are paired by a join, and members in a block of a larger one.
SMALL, BLOCK = 8, 1000
REMEMBERED = 100_000
_U64 = np.uint64


@dataclass(frozen=True)
class Banding:
    """Partial keys in each of the two collections, and minhashes in each of their keys."""

    sides: tuple[int, int]
    rows: tuple[int, int]

    @property
    def n_tables(self) -> int:
        return self.sides[0] * self.sides[1]

    def missed(self, similarity: float) -> float:
        """A bound of the probability that two texts of that similarity share no table."""
        return sum((1 - similarity**rows) ** side for side, rows in zip(self.sides, self.rows, strict=True))

    def met(self, similarity: float) -> float:
        """The probability that they share one."""
        return math.prod(1 - (1 - similarity**rows) ** side for side, rows in zip(self.sides, self.rows, strict=True))


def banding_of(n: int, percent: int = PERCENT) -> Banding:
    """The banding with the least table keys and unrelated pairs to look at for a text among ``n``.

    Whatever ``n`` is, texts of the least similarity miss each other with a probability of ``MISSED`` at most. It is an error
    if that similarity is below 50 percent, which would take thousands of tables.
    """
    if not 50 <= percent <= 100:
        raise ValueError("near duplicates have a similarity of 50 to 100 percent")
    # A probability that isn't quite 1, as its logarithm is needed.
    agree = [min(percent / 100, 0.99) ** rows for rows in range(MOST_ROWS + 1)]
    fitting = []
    for one in range(2, MOST_ROWS + 1):
        first = math.floor(math.log(MISSED) / math.log(1 - agree[one])) + 1
        for other in range(max(3, one), MOST_ROWS + 1):
            for side in range(first, 3 * first):
                left = MISSED - (1 - agree[one]) ** side
                fitting.append(Banding((side, math.ceil(math.log(left) / math.log(1 - agree[other]))), (one, other)))
    return min(fitting, key=lambda b: (b.n_tables + PAIR_COST * n * b.met(UNRELATED), b.rows, b.sides))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        value = xxhash.xxh3_64_digest(word)
        if len(word) <= 64:
            self[word] = value
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


class Shingles:
    """Shingle sets of texts, as sorted distinct 64-bit hashes."""

    def __init__(self):
        self._hash = _WordHashes().__getitem__
        self._factors = [_U64(0x9E3779B97F4A7C15 ** (k + 1) % (1 << 64)) for k in range(SHINGLE)]

    def of(self, text: str | None) -> np.ndarray:
        words = np.frombuffer(b"".join(map(self._hash, words_of(text))), "<u8")
        if not len(words):
            return words
        size = min(len(words), SHINGLE)
        total = np.full(len(words) - size + 1, _U64(size))
        for k in range(size):
            total += words[k : len(words) - size + 1 + k] * self._factors[k]
        return np.unique(_mixed(total))


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    if not len(a) or not len(b) or min(len(a), len(b)) * 100 < max(len(a), len(b)) * percent:
        return False
    both = np.concatenate((a, b))
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


class Sketch:
    """The partial keys of a set, those of the first collection before those of the second."""

    def __init__(self, banding: Banding, seed: int = 7):
        draw = np.random.default_rng(seed)
        self._collections = list(zip(banding.sides, banding.rows, strict=True))
        n = sum(side * rows for side, rows in self._collections)
        self._a = draw.integers(0, 1 << 63, n, dtype=_U64) * _U64(2) + _U64(1)
        self._b = draw.integers(0, 1 << 63, n, dtype=_U64)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        least = np.full(len(self._a), _U64(0xFFFFFFFFFFFFFFFF))
        for at in range(0, len(hashes), 512):
            values = hashes[at : at + 512, None] * self._a
            values += self._b
            np.minimum(least, values.min(axis=0), out=least)
        parts, at = [], 0
        for side, rows in self._collections:
            keys = np.zeros(side, _U64)
            for row in least[at : at + side * rows].reshape(side, rows).T:
                keys = _mixed(keys * _U64(31) + row)
            parts.append(keys)
            at += side * rows
        return np.concatenate(parts)


def bins_of(hashes: np.ndarray) -> np.ndarray:
    """One byte for each bin: of the least hash in it, 1 to 255; 0 for an empty bin. ``hashes`` are sorted."""
    out = np.zeros(BINS, np.uint8)
    places = (hashes >> _U64(64 - BINS.bit_length() + 1)).astype(np.intp)
    first = np.flatnonzero(np.diff(places, prepend=-1))
    out[places[first]] = _mixed(hashes[first]) % _U64(255) + _U64(1)
    return out


def possible(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether sets with these rows of bins and of these sizes may be similar enough.

    The filled bins are a draw without replacement from the union, so the number that agree is hypergeometric.
    """
    filled = np.count_nonzero(a | b, axis=-1)
    same = np.count_nonzero((a == b) & (a > 0), axis=-1)
    share = percent / 100
    union = (n_a + n_b) / (1 + share)
    left = np.clip(1 - filled / np.maximum(union, 1), 0, 1)
    return same >= share * filled - DEVIATIONS * np.sqrt(share * (1 - share) * filled * left) - 1


_SKETCH = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("keys", pa.list_(pa.int64())), ("bins", pa.binary())]
)
_SKETCH_DDL = "doc_id long, n long, fp1 long, fp2 long, keys array<long>, bins binary"


def _sketches(batches: Iterator[pa.RecordBatch], banding: Banding) -> Iterator[tuple]:
    shingles, sketch = Shingles(), Sketch(banding)
    for doc_id, text in rows_of(batches):
        hashes = shingles.of(text)
        if not len(hashes):
            yield doc_id, 0, None, None, None, None
            continue
        digest = np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), "<i8").tolist()
        yield doc_id, len(hashes), *digest, sketch.of(hashes).view(np.int64), bins_of(hashes).tobytes()


def _confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[tuple]:
    shingles, last, hashes = Shingles(), object(), None
    for a, text_a, b, text_b in rows_of(batches):
        if a != last:
            last, hashes = a, shingles.of(text_a)
        if similar(hashes, shingles.of(text_b), percent):
            yield a, b


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def confirm(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of the ``pairs`` (a, b) whose documents' full sets are similar enough."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    texts = written(docs.join(written(ids, "ids"), "id", "left_semi"), "texts")
    both = (
        pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "text_a", "b", "text_b")
    )
    return both.mapInArrow(lambda rows: batches_of(_confirmed(rows, percent), _LINK, 20_000), "a long, b long")


def _plausible(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that their sizes and sketches leave possible."""

    @F.pandas_udf("boolean")
    def likely(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
        x, y = (np.frombuffer(b"".join(c), np.uint8).reshape(-1, BINS) for c in (a, b))
        return pd.Series(possible(x, y, n_a.to_numpy(), n_b.to_numpy(), percent))

    side = lambda x: reps.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("bins").alias(f"bins_{x}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    sized = sized.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return sized.where(likely("bins_a", "bins_b", "n_a", "n_b")).select("a", "b")


def _across(rows: pd.DataFrame, percent: int, sides: tuple[int, int]) -> pd.DataFrame:
    """Possible pairs between components, of the rows of one pair of blocks of a bucket.

    A pair is emitted by the first table that both its members are filed under.
    """
    table = int(rows["key_no"].iat[0])
    row, column = divmod(table, sides[1])
    one = rows[rows["block"] == rows["low"].iat[0]]
    two = rows[rows["block"] == rows["high"].iat[0]]
    own = rows["low"].iat[0] == rows["high"].iat[0]
    bins, keys = (np.frombuffer(b"".join(two[c]), t).reshape(len(two), -1) for c, t in (("bins", np.uint8), ("keys", "<i4")))
    group, ids, sizes = two["component"].to_numpy(), two["rep"].to_numpy(), two["n"].to_numpy()
    a, b = [], []
    for k, (rep, component, n, own_bins, own_keys) in enumerate(zip(one["rep"], one["component"], one["n"], one["bins"], one["keys"], strict=True)):
        other = group != component
        other &= (100 * sizes >= percent * n) & (100 * n >= percent * sizes)
        if own:
            other[: k + 1] = False
        at = np.flatnonzero(other)
        if not len(at):
            continue
        same = keys[at] == np.frombuffer(own_keys, "<i4")
        at = at[(same[:, : sides[0]].argmax(axis=1) == row) & (same[:, sides[0] :].argmax(axis=1) == column)]
        at = at[possible(bins[at], np.frombuffer(own_bins, np.uint8), sizes[at], n, percent)]
        a += [rep] * len(at)
        b += ids[at].tolist()
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _pairs_across(apart: DataFrame, reps: DataFrame, percent: int, sides: tuple[int, int]) -> DataFrame:
    """Possible pairs (a < b) of members of different components in a bucket; ``apart`` has key, key_no, rep, component, size."""
    small, large = apart.where(F.col("size") <= SMALL), apart.where(F.col("size") > SMALL)
    other = small.select("key", F.col("rep").alias("b"), F.col("component").alias("component_b"))
    near = small.withColumnRenamed("rep", "a").join(other, "key").where("a < b AND component <> component_b")
    near = _plausible(near.select("a", "b").distinct(), reps, percent)

    # Buckets in blocks: a row goes to every pair of blocks that its own is part of.
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = large.withColumn("block", F.pmod(F.xxhash64("rep", "key"), blocks).cast("int"))
    placed = placed.join(reps.select("rep", "n", "bins", _packed(F.col("keys")).alias("keys")), "rep")
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    placed = placed.select("*", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"))
    far = placed.groupBy("key", "low", "high").applyInPandas(lambda rows: _across(rows, percent, sides), "a long, b long")
    far = far.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return near.unionByName(far).distinct()


def _packed(keys: Column) -> Column:
    """The low 32 bits of each key, as one binary."""
    hexes = F.transform(keys, lambda k: F.lpad(F.hex(k.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    return F.unhex(F.array_join(hexes, ""))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, banding: Banding | None = None
) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_shingles, component_id and kept.

    Without a ``banding`` it is that of the number of documents, which are counted.
    """
    small_batches(docs.sparkSession)
    banding = banding or banding_of(docs.count(), percent)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketch = written(rows.mapInArrow(lambda b: batches_of(_sketches(b, banding), _SKETCH, 5000), _SKETCH_DDL), "sketch")
    classes = sketch.where("n > 0 AND doc_id IS NOT NULL").groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep"))
    classes = written(classes, "classes")
    chosen = classes.withColumn("doc_id", F.col("rep"))
    reps = written(sketch.join(chosen, ["fp1", "fp2", "doc_id"]).select("rep", "n", "keys", "bins"), "reps")

    one, other = banding.sides
    tables = [
        F.xxhash64(F.lit(i * other + j), F.col("keys")[i], F.col("keys")[one + j]) for i in range(one) for j in range(other)
    ]
    filed = reps.select("rep", F.posexplode(F.array(*tables)).alias("key_no", "key"))
    shared = filed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = written(filed.join(shared, "key"), "members")

    # The most central member of each bucket, known by the number of buckets it shares, at most that of all tables.
    degree = members.groupBy("rep").agg(F.count("*").alias("degree"))
    rank = F.shiftleft(F.least("degree", F.lit(banding.n_tables)), 48) + F.xxhash64("rep").bitwiseAND(F.lit((1 << 48) - 1))
    central = members.join(degree, "rep").groupBy("key").agg(F.max_by("rep", rank).alias("a"))
    pairs = members.join(central, "key").where("a <> rep").select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b"))
    pairs = written(_plausible(pairs.distinct(), reps, percent), "pairs")
    links = written(confirm(pairs, rows, percent), "links")
    component = written(components(links), "components")

    # Buckets whose members are still apart: pair them across components, but for pairs that have been compared.
    named = members.join(component.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.withColumn("component", F.coalesce("component", "rep"))
    split = named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    apart = written(named.join(split.select("key"), "key"), "apart")
    across = _pairs_across(apart, reps, percent, banding.sides)
    late = written(across.join(pairs, ["a", "b"], "left_anti"), "late")
    links = links.unionByName(confirm(late, rows, percent))
    component = written(components(links), "components")

    of_class = classes.join(component, F.col("rep") == F.col("node"), "left").select(
        "fp1", "fp2", F.coalesce("component", "rep").alias("component_id")
    )
    found = sketch.select("doc_id", F.col("n").alias("n_shingles"), "fp1", "fp2").join(of_class, ["fp1", "fp2"], "left")
    return found.select(
        "doc_id",
        "n_shingles",
        F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op9_minhash_tensored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


#: For small tables: all pairs of documents with a common shingle.
OP9_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reached AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) c USING (doc_id)"""
