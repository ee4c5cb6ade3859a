import os
from urllib.parse import urlparse

import duckdb
import pytest

import corpus_pipeline as cp
from rankdrift.llm import decontamination, pseudonyms
from rankdrift.llm.common import tables_removed, written
from tests.llm.test_near_duplicates import brute

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage gets and gives, as rows by id."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        given = docs
        docs = written(stage(spark, docs, SF), f"test-{name}")
        out.append((name, given, docs))
    return {name: (given, got) for name, given, got in out}


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_order_and_columns(spark, stages):
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "pii", "packing"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == columns


def test_quality_keeps_good_documents(spark, stages):
    given, got = (texts(df) for df in stages["quality"])
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    right = [(i in got) == (q == 1) for i, q in labels.items()]
    assert sum(right) >= 0.97 * len(right) and got.items() <= given.items()


def test_one_document_of_each_group_stays(stages):
    given, got = (texts(df) for df in stages["near_duplicates"])
    assert set(got) == {i for i, (_, least) in brute(list(given.items())).items() if i == least}
    assert got.items() <= given.items()


def test_documents_with_passages_go(stages):
    given, got = (texts(df) for df in stages["decontamination"])
    finder = decontamination.PassageFinder(duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall())
    assert set(got) == {i for i, t in given.items() if not finder.find(t)}
    passages = [t for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    assert not any(p in t for t in got.values() for p in passages)
    assert len(got) < len(given)


def test_private_values_go(spark, stages):
    given, got = (texts(df) for df in stages["pii"])
    p = pseudonyms.Pseudonymiser(pseudonyms.key_of(spark))
    assert got == {i: p.replace(t)[0] for i, t in given.items()} and got != given
    assert all(r.n_chars == len(r.text) for r in stages["pii"][1].collect())


def test_all_is_packed(stages):
    given, sequences = stages["packing"]
    packed = {d for r in sequences.collect() for d in r.doc_ids}
    assert packed == set(texts(given))


def test_run_gives_the_last_stage(spark, stages):
    got = cp.run(spark, SF)
    last = stages["packing"][1]
    total = "aggregate(lengths, 0L, (a, x) -> a + x)"
    assert got.columns == last.columns
    assert got.selectExpr(f"sum({total})").first() == last.selectExpr(f"sum({total})").first()


def test_odd_and_empty_tables(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        rows = docs.count()
        for _, stage in cp.STAGES:
            docs = written(stage(spark, docs, SF), "test-odd")
        kept = {d for r in docs.collect() for d in r.doc_ids}
        assert kept <= {None, *range(10)} - {7} and bool(kept) == bool(rows)


def test_near_duplicates_are_judged_by_row(spark):
    """Unique texts under a repeated id stay, and one of several equal rows."""
    a, b, c = ("one two three four five six seven eight", "nine ten eleven twelve thirteen fourteen", "red green blue white black grey pink")
    rows = [(3, a), (5, a), (5, b), (8, c), (8, c), (None, b), (None, "cold warm hot mild dry wet"), (None, "x y"), (9, ""), (9, ""), (10, None)]
    docs = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, _row int, component_id string")
    got = cp.near_duplicate_stage(spark, docs, SF)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    groups = {}
    for i, text in rows:
        if text:
            groups.setdefault({a: "a", b: "b", c: "c"}.get(text, text), []).append((i is None, i or 0, text))
    want = [(None if none else i, text) for none, i, text in map(min, groups.values())]
    assert kept == sorted([*want, (9, ""), (9, ""), (10, None)], key=str)
    assert (5, b) in kept and kept.count((8, c)) == 1


def test_tables_of_a_stage_are_removed(spark):
    rows = spark.range(3)
    with tables_removed(spark):
        gone = written(rows, "gone")
        kept = written(gone.where("id > 0"), "kept", keep=True)
    assert kept.count() == 2
    assert [os.path.exists(urlparse(df.inputFiles()[0]).path) for df in (gone, kept)] == [False, True]
    later = written(rows, "later")
    assert later.count() == 3
