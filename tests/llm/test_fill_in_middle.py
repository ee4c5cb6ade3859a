import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankdrift.llm import fill_in_middle as fim
from tests.llm.conftest import ODD_TEXTS

TOKENS = re.compile(r"[A-Za-z]+|[^A-Za-z]")
ALPHABET = "abzAZ 09\n\t.<>PSM_éß日\U0001f600İK"


def expected(doc_id, text):
    """The row of the contract, by a list of the tokens."""
    text = text or ""
    units = TOKENS.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def some_texts(n, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choices(ALPHABET, k=draw.randrange(90))) for _ in range(n)]


def test_ranks_against_counting():
    draw = np.random.default_rng(2)
    for length in (0, 1, 7, 8, 63, 64, 65, 128, 1000):
        symbols = draw.integers(0, 8, length).astype(np.uint8)
        matrix = fim.WaveletMatrix(symbols)
        for symbol in range(8):
            for i in {0, length, *draw.integers(0, length + 1, 20).tolist()}:
                assert matrix.rank(symbol, i) == int((symbols[:i] == symbol).sum())


def test_cuts_are_token_ends():
    for text in some_texts(300):
        tokens, units = TOKENS.findall(text), fim.Units(text)
        assert units.count == len(tokens)
        assert [units.end(k) for k in range(len(tokens) + 1)] == [len("".join(tokens[:k])) for k in range(len(tokens) + 1)]


@pytest.mark.parametrize(("unit", "form"), [("characters", r"(?s)."), ("words", r"(?:[A-Za-z]+|[0-9]|[^\x00-\x7f])[^A-Za-z0-9\x80-\U0010ffff]*")])
def test_other_units(unit, form):
    for text in some_texts(200, 2):
        found, units = [m.end() for m in re.finditer(form, text)], fim.Units(text, unit)
        assert units.count == len(found)
        assert [units.end(k + 1) for k in range(units.count)] == found


def test_slices(monkeypatch):
    text = "".join(some_texts(50, 3))
    whole = fim.classes_of(text)
    monkeypatch.setattr(fim, "SLICE", 7)
    assert (fim.classes_of(text) == whole).all()


def test_rows_against_lists(spark):
    texts = [*ODD_TEXTS, "a <P> b", "<S>", "<", "<P", *some_texts(400, 4)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id, twice"), (None, "no id, twice"), (7, texts[7])]
    docs = spark.createDataFrame([(*row, "x", "y", 3) for row in rows], "doc_id long, text string, form string, output string, n int")
    made = fim.fill_in_middle(docs)
    got = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: (r[0] is not None, str(r))
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted((expected(*row) for row in rows), key=key)
    texts_of = {i: t or "" for i, t in rows}
    assert all(r.back == texts_of[r.doc_id] for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_marks_at_the_seams():
    """Pieces that end or begin like a mark don't make one with the marks beside them."""
    for prefix in ("<", "<P", "P>", "<S", "S>", ">", "M>"):
        for suffix in ("<", "<M", "M>", ">", "S>"):
            out = f"<P>{prefix}<S>{suffix}<M>{prefix}"
            assert all(out.count(m) == 1 for m in ("<P>", "<S>", "<M>"))


def test_parameters(spark):
    docs = spark.createDataFrame([(i, "one two three") for i in range(50)], "doc_id long, text string")
    assert {r.form for r in fim.fill_in_middle(docs, cut=100, suffix_first=100).collect()} == {"spm"}
    assert {r.form for r in fim.fill_in_middle(docs, cut=0).collect()} == {"plain"}
    assert fim.fill_in_middle(docs, seed=1).collect() != fim.fill_in_middle(docs, seed=2).collect()


def test_empty_table(spark, no_documents):
    assert fim.fill_in_middle(no_documents).count() == 0
