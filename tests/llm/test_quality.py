import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rankdrift.llm import quality
from tests.llm.conftest import ODD_TEXTS


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in quality.op8_neighbour_quality(spark, sf).collect()}
    assert len(rows) == duckdb.sql(f"SELECT count(*) FROM '{sf}/documents.parquet'").fetchall()[0][0]
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    tested = [(rows[i], q) for i, q in labels.items() if rows[i].held_out]
    assert sum(r.predicted == q for r, q in tested) >= 0.97 * len(tested)


def test_votes_against_plain_loops():
    draw = np.random.default_rng(1)
    terms, labels = draw.random((60, quality.TERMS)), draw.integers(0, 2, 60).astype(float)
    model = quality.fit(terms, labels, 8)
    others = draw.random((20, quality.TERMS))
    got = model.scores(others)
    for x, score in zip(others, got):
        z = (x * model.weights) @ model.projection
        cosines = [float(z @ v / np.linalg.norm(z)) for v in model.vectors]
        near = sorted(range(60), key=lambda k: -cosines[k])[: quality.NEIGHBOURS]
        votes = [cosines[k] ** 8 for k in near]
        assert abs(score - sum(v * labels[k] for v, k in zip(votes, near)) / sum(votes)) < 1e-9


def test_odd_rows(spark, odd_documents, no_documents):
    good, bad = "Plain words in a row, as people write them. ", "A%%% b### c%%% d*** "
    learn = spark.createDataFrame([(k, (good if k % 2 else bad) * 9, "x") for k in range(100, 140)], "doc_id long, text string, score string")
    labels = spark.createDataFrame(
        [(k, k % 2, 0) for k in range(100, 140)] + [(None, 0, 0), (101, None, 0), (101, 1, 0), (999, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    model = quality.train(learn, labels)
    score = quality.scorer(spark, model)
    rows = odd_documents.select("doc_id", quality.held_out("doc_id").alias("h"), "text", score("text").alias("s")).collect()
    assert len(rows) == len(ODD_TEXTS) + 2
    assert all(r.s == model.prior for r in rows if not (r.text or "").split())
    assert all(not r.h for r in rows if r.doc_id is None)
    assert len({r.s for r in rows if r.doc_id == 6}) == 1
    with pytest.raises(ValueError, match="learnt"):
        quality.train(learn, labels.where("false"))
    blank = learn.withColumn("text", F.lit(" \t"))
    assert quality.train(blank, labels).scores(np.zeros((2, quality.TERMS))).tolist() == [0.5, 0.5]
    assert no_documents.select(score("text")).count() == 0
    assert len(quality.train(no_documents, labels).vectors) == 0
    few = quality.train(learn, labels, most=5)
    assert len(few.vectors) == 5


def test_labels_without_a_usable_document_take_no_place(spark):
    """Of 20,000 labels 400 have a document with words; all of these are learnt from."""
    docs = spark.range(0, 400_000, 1000).selectExpr("id AS doc_id", "concat('word', id % 7, ' and more') AS text")
    blank = spark.range(1, 400_000, 1000).selectExpr("id AS doc_id", "if(id % 2 = 0, NULL, ' ') AS text")
    labels = spark.range(0, 400_000, 20).selectExpr("id AS doc_id", "cast(id % 2000 = 0 AS int) AS quality")
    labels = labels.unionByName(blank.selectExpr("doc_id", "1 AS quality"))
    model = quality.train(docs.unionByName(blank), labels, most=300)
    usable = sum(zlib.crc32(str(k).encode()) % 3 != 1 for k in range(0, 400_000, 1000))
    assert usable < 300 and len(model.vectors) == usable


def test_texts_to_scores_against_plain_loops(spark):
    sf = "/root/testdata/sf0.001"
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet' WHERE quality IS NOT NULL").fetchall()
    terms = quality.Terms()
    learnt = [(terms.of(texts[i]), q) for i, q in labels if zlib.crc32(str(i).encode()) % 3 != 1 and (texts.get(i) or "").split()]
    x = np.array([t for t, _ in learnt])
    weights = [np.log((1 + len(x)) / (1 + sum(row[c] > 0 for row in x))) + 1 for c in range(quality.TERMS)]
    weighted = [row * weights / max(np.linalg.norm(row * weights), 1e-9) for row in x]
    _, _, axes = np.linalg.svd(np.array(weighted), full_matrices=False)
    latent = lambda t: axes[: quality.DIMENSIONS] @ (t * weights)
    known = [(latent(t), q) for t, q in learnt]
    got = {r.doc_id: r for r in quality.op8_neighbour_quality(spark, sf).collect()}
    assert got.keys() == texts.keys()
    wrong = 0
    for i, text in texts.items():
        if not (text or "").split():
            continue
        z = latent(terms.of(text))
        cosines = sorted(((z @ v / np.linalg.norm(z) / np.linalg.norm(v), q) for v, q in known), key=lambda p: -p[0])
        votes = [(min(max(c, 1e-6), 1) ** 8, q) for c, q in cosines[: quality.NEIGHBOURS]]
        # A tie at the last place may go either way.
        wrong += abs(got[i].score - sum(v * q for v, q in votes) / sum(v for v, _ in votes)) > 1e-3
    assert wrong <= 0.02 * len(texts)
