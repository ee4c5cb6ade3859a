"""Language by Bayesian fusion of a text's likelihood with what its markup, address and host say.

Text: a naive Bayes model over hashed byte trigrams, learnt from documents whose language is given, with one grouped
sum over languages and buckets. A language is known by the first part of its tag, in small letters, so en-US and en-GB are
one. Every language that occurs is learnt; each takes 64 KB of the driver and of each worker. Its log likelihoods are tempered (``TEMPER``), as neighbouring trigrams share bytes.

Further evidence is learnt from the table at hand by grouped sums of the text's posteriors, so no list of hosts or country
codes is needed: how often each language's texts declare a language in their markup, how often they have an address
suffix (the first path segment if it is of two letters, else the top-level domain), and which languages a host has.
Host priors are smoothed hierarchically, a host's towards its domain's and a domain's towards the whole table's, each by
``KAPPA`` texts, and a text doesn't count for its own prior. Missing evidence says nothing.

Defined cases: a null or empty text has no likelihood and is judged by the rest. Unknown declarations, and hosts and
addresses that are null, are missing evidence. Rows with a null id are judged like all others, and repeated rows each
count. Documents without a given language are not learnt from; if none has one, the language and probability are null.
Equal posteriors go to the first language in alphabetical order. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankdrift.llm.common import batches_of, rows_of, small_batches, table, written
from rankdrift.llm.main_text import extract

#: Buckets of trigrams.
BUCKETS = 8192
#: Exponent of the text's likelihood, weight of the smoothing of trigrams, hosts, and declarations and suffixes.
TEMPER, ALPHA, KAPPA, BETA = 1 / 3, 0.5, 5.0, 1.0
_BLOCK = 1 << 20


@dataclass
class TextModel:
    languages: list[str]
    log_probabilities: np.ndarray  # a row for each language
    log_prior: np.ndarray


def trigrams(text: str | None) -> np.ndarray:
    """Counts of a text's hashed trigrams of bytes, lower-cased and with a space at either end."""
    data = np.frombuffer(f" {text or ''} ".lower().encode(), np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    if not (text or "").strip():
        return counts
    for at in range(0, len(data) - 2, _BLOCK):
        b = data[at : at + _BLOCK + 2].astype(np.uint32)
        h = (b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(19)
        counts += np.bincount(h, minlength=BUCKETS)
    return counts


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> TextModel:
    """The text model of all documents with a language."""
    small_batches(docs.sparkSession)
    primary = F.lower(F.regexp_extract(F.trim(F.col(lang_col).cast("string")), r"^([^-_\s]+)", 1))
    rows = docs.select(primary.alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang <> ''")
    found = sorted((r.lang, r.n) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect())
    languages = [lang for lang, _ in found]
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        total: dict[str, np.ndarray] = {}
        for lang, text in rows_of(batches):
            total[lang] = total.get(lang, 0) + trigrams(text)
        for lang, counts in total.items():
            for bucket in np.flatnonzero(counts):
                yield lang, int(bucket), int(counts[bucket])

    sums = rows.mapInArrow(lambda b: batches_of(counted(b), schema, 20_000), "lang string, bucket int, n long")
    sums = sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts, row_of = np.zeros((len(languages), BUCKETS)), {lang: k for k, lang in enumerate(languages)}
    for r in sums.toLocalIterator():  # a part at a time: languages x BUCKETS at most in all
        counts[row_of[r.lang], r.bucket] = r.n
    totals = counts.sum(axis=1, keepdims=True) + ALPHA * BUCKETS
    prior = np.array([n for _, n in found], float)
    return TextModel(languages, np.log((counts + ALPHA) / totals), np.log(prior / max(prior.sum(), 1)))


def _likelihoods(model: TextModel):
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in texts:
            yield pd.Series([(TEMPER * (model.log_probabilities @ trigrams(text))).tolist() for text in column], dtype=object)

    return F.pandas_udf(score, T.ArrayType(T.DoubleType()))


def _softmax(logs: Column) -> Column:
    shifted = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, y: a + y))


def _add(*logs: Column) -> Column:
    total = logs[0]
    for other in logs[1:]:
        total = F.zip_with(total, other, lambda x, y: x + y)
    return total


def _sums(rows: DataFrame, key: str, name: str) -> DataFrame:
    """For each key the number of its rows by language, as an array of sums."""
    each = rows.where(F.col(key).isNotNull()).select(key, F.posexplode("q").alias("k", "x"))
    sums = each.groupBy(key, "k").agg(F.sum("x").alias("x")).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("k", "x"))).alias(name))
    return sums.withColumn(name, F.transform(name, lambda s: s["x"]))


def _total(rows: DataFrame, column: str, n: int) -> np.ndarray:
    """The sums by language of an array column."""
    total = np.zeros(n)
    for r in rows.select(F.posexplode(column).alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).collect():
        total[r.k] = r.x
    return total


def _array(values: np.ndarray) -> Column:
    return F.lit(np.asarray(values, float))


def markup_language(html: Column) -> Column:
    """The primary subtag that the html element declares, if it has the form of one."""
    tag = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})\b", 1))
    return F.when(tag != "", tag)


def address_host(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def address_suffix(url: Column) -> Column:
    segment = F.lower(F.regexp_extract(url, r"//[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1))
    top = F.regexp_extract(address_host(url), r"\.([a-z]{2,24})$", 1)
    return F.when(segment != "", segment).when(top != "", top)


def identify(rows: DataFrame, model: TextModel) -> DataFrame:
    """``rows`` (text, declared, suffix, host, and columns of their own) with language, probability and text_language in place of the text."""
    n, names = len(model.languages), F.array(*map(F.lit, model.languages))
    own = [c for c in rows.columns if c not in ("text", "declared", "suffix", "host")]
    # In one column meanwhile, so that they can have any names.
    kept = F.struct(*own) if own else F.lit(None).cast("int")
    back = [F.col("own")[c].alias(c) for c in own]
    if not n:
        nothing = F.lit(None)
        return rows.select(*own, nothing.cast("string").alias("language"), nothing.cast("double").alias("probability"), nothing.cast("string").alias("text_language"))
    prior = _array(model.log_prior)
    domain = F.coalesce(F.nullif(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), F.lit("")), F.col("host"))
    told = rows.select(kept.alias("own"), "declared", "suffix", "host", domain.alias("domain"), _likelihoods(model)(F.col("text")).alias("l"))
    told = written(told.withColumn("q", _softmax(_add(F.col("l"), prior))), "likelihoods")

    everywhere = _array((_total(told, "q", n) + 1) / (told.count() + n))
    for key in ("declared", "suffix"):
        # P(key | language): the language's rows with that key among its rows with any.
        sums = _sums(told, key, "sums")
        among = _array(_total(sums, "sums", n) + BETA * sums.count())
        logs = F.zip_with("sums", among, lambda s, w: F.log((s + BETA) / w)).alias(f"p_{key}")
        told = told.join(sums.select(key, logs), key, "left")
    told = told.join(_sums(told, "host", "of_host"), "host", "left").join(_sums(told, "domain", "of_domain"), "domain", "left")

    def smoothed(sums: str, towards: Column) -> Column:
        """(sums without the row's own posterior + KAPPA x towards) / (their number + KAPPA)."""
        others = F.zip_with(F.coalesce(F.col(sums), F.col("q")), F.col("q"), lambda s, q: F.greatest(s - q, F.lit(0.0)))
        count = F.aggregate(others, F.lit(KAPPA), lambda a, x: a + x)
        return F.zip_with(others, towards, lambda s, p: (s + KAPPA * p) / count)

    nothing = F.array_repeat(F.lit(0.0), n)
    told = told.withColumn("by_domain", smoothed("of_domain", everywhere))
    told = told.withColumn("by_host", F.transform(smoothed("of_host", F.col("by_domain")), lambda p: F.log(p)))
    logs = _add(F.col("l"), F.coalesce("p_declared", nothing), F.coalesce("p_suffix", nothing), F.col("by_host"))
    told = told.withColumn("logs", logs).withColumn("p", _softmax(F.col("logs")))
    best = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    return told.select(*back, best("p").alias("language"), F.array_max("p").alias("probability"), best("q").alias("text_language"))


def op2_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents (whose source is the host) and all pages; each row has a doc_id or a page_id.

    All documents with a given language are learnt from; ``tests/llm/test_language.py`` measures accuracy on a held-out fold.
    """
    docs, pages = table(spark, sf_dir, "documents"), extract(table(spark, sf_dir, "pages"))
    nothing = F.lit(None).cast("string")
    model = train(docs)
    rows = docs.select(
        "doc_id", F.lit(None).cast("long").alias("page_id"), "text", nothing.alias("declared"), nothing.alias("suffix"), F.col("source").alias("host")
    ).unionByName(
        pages.select(
            F.lit(None).cast("long").alias("doc_id"),
            "page_id",
            "text",
            markup_language(F.col("html")).alias("declared"),
            address_suffix(F.col("url")).alias("suffix"),
            address_host(F.col("url")).alias("host"),
        )
    )
    return identify(rows, model)
