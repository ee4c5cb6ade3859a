"""Quality by nearest neighbours in a latent-semantic space.

Fit: a bounded sample of labelled documents (``MOST_LABELLED``, those with the least hash of their id) is turned into
counts of hashed terms, weighted by TF-IDF and reduced to ``DIMENSIONS`` by a truncated singular value decomposition.
Terms are the shapes of words (the first 12 signs of a shape), of pairs of neighbouring words, and of repetitions, in a few hundred hash buckets each,
and the words themselves. What is broadcast, the term weights, the projection and the labelled vectors, has a size
fixed by these parameters.

Score: every whole document is projected, its cosines with all labelled vectors are computed in blocks, and the
labels of the ``NEIGHBOURS`` nearest ones vote, each weighted by its similarity.

Defined cases: a text without words (null, empty, white space) gets the share of label 1 among the labelled sample, or
0.5 if there is none. Documents of which none can be learnt from are an error. Labels that are null, or whose document is
missing or has no words, are not used and take no place in the sample; of several labels of one document each counts. Rows with a null id are scored, are not held out, and never
used to learn. Repeated rows get the same score. Columns other than the named ones are not read.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdrift.llm.common import batches_of, rows_of, small_batches, table

MOST_LABELLED, DIMENSIONS, NEIGHBOURS = 4096, 64, 15
#: Buckets for words, word shapes, pairs of shapes, and repetitions and lengths.
WORDS, SHAPES, PAIRS, HABITS = 256, 256, 512, 32
TERMS = WORDS + SHAPES + PAIRS + HABITS
REMEMBERED = 150_000
#: The kind of each byte: letters (those beyond ASCII count as small ones), capitals, digits, and marks as they are.
_SHAPE = bytes(
    ord("a") if 97 <= b <= 122 or b >= 128 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else b
    for b in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


class _Words(dict):
    """Per word: the bucket of the word, a hash of its shape, and a hash of the word, as packed 32-bit integers."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        shape = _RUN.sub(rb"\1", word.translate(_SHAPE))[:12]
        digest = xxhash.xxh32_intdigest
        packed = struct.pack("<3I", digest(word.lower()) % WORDS, digest(shape), digest(word))
        if len(word) <= 64:
            self[word] = packed
        return packed


class Terms:
    """Counts of a text's terms."""

    def __init__(self):
        self._words = _Words().__getitem__

    def of(self, text: str | None) -> np.ndarray | None:
        """A vector of ``TERMS`` log counts relative to the length; None for a text without words."""
        packed = np.frombuffer(b"".join(map(self._words, (text or "").encode().split())), "<u4").reshape(-1, 3)
        n = len(packed)
        if not n:
            return None
        word, shape, whole = packed[:, 0], packed[:, 1].astype(np.int64), packed[:, 2]
        pairs = (shape[:-1] * 31 + shape[1:] * 17) % PAIRS
        counts = np.zeros(TERMS)
        counts[:WORDS] = np.bincount(word, minlength=WORDS)
        counts[WORDS : WORDS + SHAPES] = np.bincount(shape % SHAPES, minlength=SHAPES)
        counts[WORDS + SHAPES : WORDS + SHAPES + PAIRS] = np.bincount(pairs, minlength=PAIRS)
        habits = counts[-HABITS:]
        for k in (1, 2, 3):
            habits[k] = np.count_nonzero(whole[k:] == whole[:-k])
        habits[4] = n - len(np.unique(whole))
        habits[5] = n
        # Shares of the text, so that length matters little: 0.1 % counts 0.7, all of it 6.9.
        return np.log1p(counts * (1000 / n))


@dataclass
class Model:
    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def latent(self, terms: np.ndarray) -> np.ndarray:
        """Unit vectors of rows of terms."""
        x = (terms * self.weights) @ self.projection
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def scores(self, terms: np.ndarray) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(terms), self.prior)
        cosines = self.latent(terms) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.vectors))
        nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        near = np.clip(np.take_along_axis(cosines, nearest, axis=1), 1e-6, 1.0) ** 8
        return (near * self.labels[nearest]).sum(axis=1) / near.sum(axis=1)


def fit(terms: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS) -> Model:
    """The model of a labelled sample that fits in memory."""
    if not len(terms):
        return Model(np.ones(TERMS), np.zeros((TERMS, 1)), np.zeros((0, 1)), np.zeros(0), 0.5)
    weights = np.log((1 + len(terms)) / (1 + np.count_nonzero(terms, axis=0))) + 1
    x = terms * weights
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    _, vectors = np.linalg.eigh(x.T @ x)
    model = Model(weights, vectors[:, ::-1][:, :dimensions], np.zeros((0, 1)), labels, float(labels.mean()))
    model.vectors = model.latent(terms)
    return model


def held_out(id_col: str) -> Column:
    """True for rows that labels are never learnt from: the CRC-32 of the id as text leaves 1 divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELLED) -> Model:
    """The model of at most ``most`` labelled documents that aren't held out.

    They are chosen among those that can be learnt from: documents that are there, have a word and a usable label. It is an
    error if there are documents with words, but none of them can be learnt from.
    """
    small_batches(docs.sparkSession)
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out("doc_id"))
    usable = usable.select(F.col("doc_id"), F.col(label).cast("double").alias("label"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.col("text").rlike(r"[^\x09-\x0D\x1C-\x20]"))
    first = [F.xxhash64("doc_id"), "doc_id", "label"]
    chosen = usable.join(texts.select("doc_id"), "doc_id", "left_semi").orderBy(*first).limit(most)
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.float64()), ("terms", pa.binary())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        terms = Terms()
        for doc_id, label, text in rows_of(batches):
            if (counts := terms.of(text)) is not None:
                yield doc_id, label, counts.astype("<f4").tobytes()

    # ``chosen`` has ``most`` rows of two numbers.
    sample = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    rows = (
        sample.mapInArrow(lambda b: batches_of(counted(b), schema), "doc_id long, label double, terms binary")
        .orderBy(*first, "terms")
        .limit(most)
        .collect()  # ``most`` rows of ``TERMS`` numbers
    )
    if not rows and not texts.isEmpty():
        raise ValueError(f"no document can be learnt from: none has a label of {label} outside the held-out third")
    terms = np.array([np.frombuffer(r.terms, "<f4") for r in rows], np.float64).reshape(-1, TERMS)
    return fit(terms, np.array([r.label for r in rows]))


def scorer(spark: SparkSession, model: Model):
    """A function from a text column to a column of scores."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, terms = shared.value, Terms()
        for column in texts:
            out = np.full(len(column), model.prior)
            for at in range(0, len(column), 512):
                found = [(k, t) for k, text in enumerate(column[at : at + 512], at) if (t := terms.of(text)) is not None]
                if found:
                    rows, block = zip(*found, strict=True)
                    out[list(rows)] = model.scores(np.array(block))
            yield pd.Series(out)

    return score


def op8_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    score = scorer(spark, train(docs, table(spark, sf_dir, "labels")))
    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
