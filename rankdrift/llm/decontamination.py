"""Benchmark passages in documents, also with typing errors: pigeonhole search and bit-parallel verification.

Texts are compared lower-cased, with every run of ASCII marks and white space as one space. An item of n characters
may differ by n // ``PER_ERROR`` edits (k). It is split into k + 1 pieces of about equal length, so a passage with at most
k edits holds at least one piece unchanged. One automaton finds all pieces of all items in one pass over a document;
around each piece found, Myers' bit-parallel algorithm gives the least edit distance of the whole item to any stretch
of the text, and a distance of at most k is a hit.

Items of fewer than ``LEAST`` characters after normalisation are searched without edits and as whole words; a script that is
written without spaces needs none around it.

Items are searched in blocks of about ``BLOCK`` characters, and only one block at a time is sent to the workers, so the
size of what is sent is bounded however many items there are.

Defined cases: a null or empty text holds no passage. Null items and those of marks and white space alone are never found.
Null ids, of documents and of items, are kept. Repeated rows give the same hits each.
An item that occurs several times in a text is one hit, with its least distance and the first place of that.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdrift.llm.common import small_batches, table

#: Characters of an item for each edit that is allowed; the least length of an item with edits; characters in a block of items.
PER_ERROR, LEAST, BLOCK = 12, 24, 2_000_000
#: Marks and white space of ASCII become spaces.
_SPACED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Letters of scripts that are written without spaces: Thai, Lao, Burmese, Khmer, kana and Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_HITS = "array<struct<item_id: bigint, distance: int, place: int>>"


def normalised(text: str | None) -> str:
    return b" ".join((text or "").lower().encode().translate(_SPACED).split()).decode()


def budget(item: str) -> int:
    return len(item) // PER_ERROR if len(item) >= LEAST else 0


def _inside_word(text: str, at: int) -> bool:
    """Whether a word goes on across this place."""
    around = text[at - 1 : at + 1] if at else ""
    return len(around) == 2 and all((c.isalnum() or unicodedata.category(c)[0] == "M") and not _UNSPACED.match(c) for c in around)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """Offset and text of ``errors`` + 1 pieces that together are the item."""
    cuts = [len(item) * k // (errors + 1) for k in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Matcher:
    """Least edit distance of one item to any stretch of a text (Myers 1999, one wide integer for a column)."""

    def __init__(self, item: str):
        self._ones, self._last = (1 << len(item)) - 1, 1 << (len(item) - 1)
        self._length, self._where = len(item), {}
        for k, letter in enumerate(item):
            self._where[letter] = self._where.get(letter, 0) | 1 << k

    def best(self, text: str) -> tuple[int, int]:
        """The least distance, and the first end (exclusive) of a stretch at that distance."""
        plus, minus, distance = self._ones, 0, self._length
        ones, last, where = self._ones, self._last, self._where
        least, end = distance, 0
        for at, letter in enumerate(text, 1):
            equal = where.get(letter, 0)
            vertical = equal | minus
            horizontal = (((equal & plus) + plus) ^ plus) | equal
            up = minus | (ones & ~(horizontal | plus))
            down = plus & horizontal
            if up & last:
                distance += 1
            elif down & last:
                distance -= 1
            up, down = up << 1 & ones, down << 1 & ones
            plus = down | (ones & ~(vertical | up))
            minus = up & vertical
            if distance < least:
                least, end = distance, at
        return least, end


class PassageFinder:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        self._items, self._matchers = [], {}
        found: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            item = normalised(text)
            if not item:
                continue
            self._items.append((item_id, item, budget(item)))
            for offset, piece in pieces(item, budget(item)):
                found.setdefault(piece, []).append((len(self._items) - 1, offset + len(piece)))
        self._automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self._automaton.add_word(piece, places)
        self._automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item_id, least distance, where it ends in the normalised text) of the items in the text, by item_id."""
        text = normalised(text)
        if not self._items or not text:
            return []
        tried, hits = set(), {}
        for end, places in self._automaton.iter(text):
            for number, done in places:
                start = end + 1 - done
                if (number, start) in tried:
                    continue
                tried.add((number, start))
                item_id, item, errors = self._items[number]
                if hits.get(number, (1,))[0] == 0:
                    continue  # it can't get better, and starts are tried from left to right
                low = max(0, start - errors)
                window = text[low : start + len(item) + errors]
                if len(item) < LEAST:
                    if _inside_word(text, start) or _inside_word(text, start + len(item)):
                        continue
                    hit = 0, start + len(item)
                elif window[start - low :].startswith(item):
                    hit = 0, start + len(item)
                else:
                    if (matcher := self._matchers.get(number)) is None:
                        matcher = self._matchers[number] = Matcher(item)
                    distance, stop = matcher.best(window)
                    hit = distance, low + stop
                if hit[0] <= errors:
                    hits[number] = min(hits.get(number, hit), hit)
        return sorted(((self._items[n][0], *hit) for n, hit in hits.items()), key=lambda h: (h[0] is None, h[0] or 0, *h[1:]))


def passage_hits(docs_text: Column, items: list[tuple[int, str]], spark: SparkSession) -> Column:
    """The hits of one block of items in a text column: array of (item_id, distance, place)."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(items)

    @F.pandas_udf(_HITS)
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = PassageFinder(shared.value)
        for column in texts:
            yield pd.Series(
                [[{"item_id": i, "distance": d, "place": p} for i, d, p in finder.find(text)] for text in column]
            )

    return find(docs_text)


def item_blocks(benchmark: DataFrame, block: int = BLOCK) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in blocks of about ``block`` characters, one block at a time."""
    items = benchmark.where("text IS NOT NULL").select("item_id", "text")
    size = items.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    n_blocks = -(-size // block)
    for k in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k).collect()
        yield [tuple(r) for r in rows]


def contaminated(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each document and item found in it: doc_id, item_id, distance, place."""
    spark, found = docs.sparkSession, []
    for items in item_blocks(benchmark, block):
        hits = docs.select("doc_id", F.explode(passage_hits(F.col("text").cast("string"), items, spark)).alias("hit"))
        found.append(hits.select("doc_id", "hit.*"))
    if not found:
        return spark.createDataFrame([], "doc_id long, item_id long, distance int, place int")
    while len(found) > 1:
        found = [a.unionByName(b) for a, b in zip(found[::2], found[1::2])] + found[len(found) & ~1 :]
    return found[0]


def without_benchmark(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that hold no item, with the same columns."""
    for items in item_blocks(benchmark, block):
        docs = docs.where(F.size(passage_hits(F.col("text").cast("string"), items, docs.sparkSession)) == 0)
    return docs


def op4_pigeonhole_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
