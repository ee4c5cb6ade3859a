"""Fill-in-the-middle texts, cut at unit boundaries that a wavelet matrix over character classes locates.

Every character has one of eight classes (``CLASSES``); a letter that goes on a run of letters has one of its own. A
wavelet matrix keeps the classes of a text as three rows of bits with running counts, so the number of characters of
a class before any position is a few look-ups (``rank``). The units of a text begin at characters of certain classes, so
the number of units that begin before a position is a sum of ranks, and bisection on it finds the position after any
number of units. Nothing is matched and no list of units is made, whatever the length of the text.

A document's cuts and form are drawn from the SHA-256 of a seed and its id. The output is the text itself (plain), or
prefix, suffix and middle behind their marks (psm), or suffix, prefix and middle (spm). ``restored`` takes it apart
again: a text that holds a mark stays plain, and no mark can arise where a piece meets a mark, since marks begin with
the one character that they don't hold elsewhere.

Defined cases: a null text is an empty one; an empty text is plain, with no units. A null id is drawn from the seed alone.
Repeated rows give the same output each. An empty table gives no rows. Columns other than the two named ones are not
read, so they can't clash. Long texts are classed in slices of ``SLICE`` characters; the matrix takes under a byte for
each character.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdrift.llm.common import batches_of, rows_of, small_batches, table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents, how many are to be cut, and of 100 that are cut, how many have the suffix first.
CUT, SUFFIX_FIRST = 90, 20
SEED = 1

#: A letter after a letter, a letter that begins a run, and characters of other kinds. Letters are A to Z and a to z.
CLASSES = ("within", "word", "digit", "blank", "line", "mark", "wide")
WITHIN, WORD, DIGIT, BLANK, LINE, MARK, WIDE = range(len(CLASSES))
LEVELS = 3
#: Classes of the characters that do not begin a unit.
UNITS = {
    "tokens": (WITHIN,),  # runs of letters, and every other character
    "characters": (),
    "words": (WITHIN, BLANK, LINE, MARK),  # with the blanks and marks behind them
}
SLICE = 1 << 20


def _kind(code: int) -> int:
    if code >= 128:
        return WIDE
    c = chr(code)
    return WORD if c.isalpha() else DIGIT if c.isdigit() else LINE if c == "\n" else BLANK if c.isspace() else MARK


_KINDS = np.array([_kind(code) for code in range(129)], np.uint8)


def classes_of(text: str) -> np.ndarray:
    """The class of each code point."""
    kinds = np.empty(len(text), np.uint8)
    for at in range(0, len(text), SLICE):
        codes = np.frombuffer(text[at : at + SLICE].encode("utf-32-le", "surrogatepass"), "<u4")
        kinds[at : at + len(codes)] = _KINDS[np.minimum(codes, 128)]
    letters = kinds == WORD
    kinds[1:][letters[1:] & letters[:-1]] = WITHIN
    return kinds


class _Bits:
    """A row of bits that knows how many ones stand before each position."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self._words = np.concatenate([packed, np.zeros(8 - len(packed) % 8, np.uint8)]).view("<u8")
        before = np.cumsum(np.bitwise_count(self._words), dtype=np.int64)
        self._before = np.concatenate([[0], before])
        self.zeros = len(bits) - int(before[-1])

    def ones(self, i: int) -> int:
        return int(self._before[i >> 6]) + (int(self._words[i >> 6]) & ((1 << (i & 63)) - 1)).bit_count()


class WaveletMatrix:
    """Symbols below ``2 ** levels``, a row of bits for each level: at each, ones go behind zeros, in their order."""

    def __init__(self, symbols: np.ndarray, levels: int = LEVELS):
        self.length, self._rows = len(symbols), []
        for level in reversed(range(levels)):
            ones = (symbols >> level & 1).astype(bool)
            self._rows.append((level, _Bits(ones)))
            if level:
                symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: int, i: int) -> int:
        """How often ``symbol`` stands before position ``i``."""
        first = 0
        for level, row in self._rows:
            if symbol >> level & 1:
                first, i = row.zeros + row.ones(first), row.zeros + row.ones(i)
            else:
                first, i = first - row.ones(first), i - row.ones(i)
        return i - first


class Units:
    """The units of a text, by number."""

    def __init__(self, text: str, unit: str = "tokens"):
        self._inner, self._matrix = UNITS[unit], WaveletMatrix(classes_of(text))
        self.count = self._begun(len(text))

    def _begun(self, i: int) -> int:
        """How many units begin before position ``i``."""
        return i - sum(self._matrix.rank(symbol, i) for symbol in self._inner)

    def end(self, k: int) -> int:
        """The position after the first ``k`` units; what stands before the first unit belongs to none."""
        return bisect_right(range(self._matrix.length + 1), k, key=self._begun) - 1


def transformed(text: str, draws: tuple[int, int, int, int], unit: str = "tokens", cut: int = CUT, suffix_first: int = SUFFIX_FIRST):
    """(units, form, characters of the prefix and of the middle, output) of a text."""
    units = Units(text, unit)
    if not text or draws[2] % 100 >= cut or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return units.count, "plain", None, None, text
    first, last = (units.end(k) for k in sorted(draw % (units.count + 1) for draw in draws[:2]))
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    if draws[3] % 100 < suffix_first:
        return units.count, "spm", first, last - first, "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return units.count, "psm", first, last - first, "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def draws_of(id_col: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2 ** 32 from the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64())]
    + [("middle_chars", pa.int64()), ("output", pa.string())]
)
_DDL = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "tokens",
    cut: int = CUT,
    suffix_first: int = SUFFIX_FIRST,
    seed: int = SEED,
) -> DataFrame:
    """A row for each document: doc_id, its units ``n``, form, prefix_chars, middle_chars (null if plain) and output."""
    small_batches(docs.sparkSession)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, text, *draws in rows_of(batches):
            yield doc_id, *transformed(text, draws, unit, cut, suffix_first)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), text, *draws_of(F.col(id_col), seed))
    return wanted.mapInArrow(lambda batches: batches_of(rows(batches), _SCHEMA), _DDL)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from."""
    part = lambda c, mark, k: F.split_part(c, F.lit(mark), F.lit(k))
    behind = lambda c, mark: F.substr(c, F.lit(len(mark) + 1))
    middle = part(output, MIDDLE, 2)
    outer = part(output, MIDDLE, 1)
    psm = F.concat(behind(part(outer, SUFFIX, 1), PREFIX), middle, part(outer, SUFFIX, 2))
    spm = F.concat(part(outer, PREFIX, 2), middle, behind(part(outer, PREFIX, 1), SUFFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_wavelet_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


OP12_SQL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         list_transform([0, 1, 2, 3], lambda k: CAST('0x' || substr(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')),
                                                                    8 * k + 1, 8) AS BIGINT)) AS h
  FROM documents),
cut AS (
  SELECT doc_id, t, units, len(units) AS n, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS lo,
         greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS hi,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
pieces AS (
  SELECT *, coalesce(array_to_string(units[1:lo], ''), '') AS p, coalesce(array_to_string(units[lo + 1:hi], ''), '') AS m,
         coalesce(array_to_string(units[hi + 1:n], ''), '') AS s
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM pieces"""
