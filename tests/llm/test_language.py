from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankdrift.llm import language as la
from tests.llm.conftest import ODD_TEXTS

EN, FR = "the cat and the dog are in the house with the bird", "le chat et le chien sont dans la maison avec un oiseau"


@pytest.fixture(scope="module")
def model(spark):
    rows = [(k, FR if k % 3 else EN, "fr" if k % 3 else "en", "x") for k in range(30)] + [(99, "odd", None, "x"), (98, None, "en", "x")]
    return la.train(spark.createDataFrame(rows, "doc_id long, text string, lang string, language string"))


def brute(model, rows):
    """Posteriors of (text, declared, suffix, host) rows, with plain loops."""
    log_l = [la.TEMPER * (model.log_probabilities @ la.trigrams(t)) for t, *_ in rows]
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    q = [soft(x + model.log_prior) for x in log_l]
    n = len(model.languages)
    everywhere = (sum(q) + 1) / (len(rows) + n)
    tables = []
    for column in (1, 2):
        sums = defaultdict(lambda: np.zeros(n))
        for row, x in zip(rows, q):
            if row[column] is not None:
                sums[row[column]] += x
        whole = sum(sums.values()) + la.BETA * len(sums)
        tables.append({k: np.log((s + la.BETA) / whole) for k, s in sums.items()})
    domain = lambda h: None if h is None else ".".join(h.split(".")[-2:])
    out = []
    for k, (row, l) in enumerate(zip(rows, log_l)):
        prior = everywhere
        for of in (domain, lambda h: h):
            others = sum((x for j, (r, x) in enumerate(zip(rows, q)) if j != k and row[3] is not None and of(r[3]) == of(row[3])), np.zeros(n))
            prior = (others + la.KAPPA * prior) / (others.sum() + la.KAPPA)
        total = l + np.log(prior)
        for t, column in zip(tables, (1, 2)):
            total = total + t.get(row[column], np.zeros(n))
        out.append(soft(total))
    return out


def test_fusion_against_loops(spark, model):
    hosts = ["a.x.org", "b.x.org", "c.fr", None, "plain"]
    rows = [
        ((EN if k % 4 else FR)[: 3 + k * 2] if k % 7 else None, ["en", "fr", None][k % 3], ["org", "fr", None, "de"][k % 4], hosts[k % 5])
        for k in range(40)
    ]
    df = spark.createDataFrame([(k, *r, "z", "z") for k, r in enumerate(rows)], "id long, text string, declared string, suffix string, host string, l string, q string")
    got = {r.id: r for r in la.identify(df, model).collect()}
    for k, p in enumerate(brute(model, rows)):
        assert got[k].language == model.languages[int(p.argmax())] and abs(got[k].probability - p.max()) < 1e-9


def test_evidence_decides_where_the_text_is_silent(spark, model):
    rows = [(k, EN, "en", "uk", "a.uk") for k in range(20)] + [(100 + k, FR, "fr", "fr", "b.fr") for k in range(20)]
    rows += [(201, None, "en", None, None), (202, "", None, "fr", None), (203, " ", None, None, "b.fr"), (204, None, None, None, "a.uk")]
    df = spark.createDataFrame(rows, "id long, text string, declared string, suffix string, host string")
    got = {r.id: r.language for r in la.identify(df, model).collect()}
    assert [got[k] for k in (201, 202, 203, 204)] == ["en", "fr", "fr", "en"]


def test_addresses_and_markup(spark):
    urls = {
        "https://user@www.site.co.uk:80/en/x?y#z": ("www.site.co.uk", "en"),
        "http://Site.FR": ("site.fr", "fr"), "//a.de/page": ("a.de", "de"), "https://a.org/eng/": ("a.org", "org"),
        "http://10.0.0.1/x": ("10.0.0.1", None), "nothing": (None, None), "": (None, None), None: (None, None),
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = {r.u: (r.h, r.s) for r in df.select("u", la.address_host(F.col("u")).alias("h"), la.address_suffix(F.col("u")).alias("s")).collect()}
    assert got == urls
    pages = {'<html lang="en-US">': "en", "<HTML class=x LANG=de>": "de", "<html>": None, "<p lang=fr>": None, None: None, "<html lang=''>": None}
    df = spark.createDataFrame([(h,) for h in pages], "h string")
    assert {r.h: r.m for r in df.select("h", la.markup_language(F.col("h")).alias("m")).collect()} == pages


def test_more_than_a_hundred_languages(spark):
    """Also of those with the fewest documents."""
    pick = np.random.default_rng(1)
    text = {f"l{k:03d}": " ".join("".join(pick.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(8)) for k in range(130)}
    rows = [(t, lang) for k, (lang, t) in enumerate(text.items()) for _ in range(1 + (k < 110))]
    model = la.train(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == sorted(text)
    asked = spark.createDataFrame([(lang, t, None, None, None) for lang, t in text.items()], "id string, text string, declared string, suffix string, host string")
    got = la.identify(asked, model).collect()
    assert len(got) == 130 and all(r.language == r.id for r in got)


def test_odd_rows(spark, model, odd_documents, no_documents):
    rows = odd_documents.select("doc_id", "text", F.lit(None).cast("string").alias("declared"), F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host"))
    got = la.identify(rows, model).collect()
    assert Counter(r.doc_id for r in got) == Counter([*range(len(ODD_TEXTS)), None, 6])
    assert all(r.language in ("en", "fr") and 0 < r.probability <= 1 for r in got)
    assert la.identify(rows.where("false"), model).count() == 0
    none = la.train(no_documents)
    assert {(r.language, r.probability) for r in la.identify(rows, none).collect()} == {(None, None)}


FOLD = "crc32(cast(cast(doc_id AS string) AS binary)) % 3"


def test_the_query_learns_from_all_documents(spark, tmp_path):
    docs = spark.range(60).select(F.col("id").alias("doc_id"))
    docs = docs.withColumn("lang", F.when(F.expr(FOLD) == 1, "fr").otherwise("en")).withColumn("text", F.when(F.col("lang") == "fr", FR).otherwise(EN))
    docs = docs.unionByName(spark.createDataFrame([(None, "xx", "zzz qqq zzz qqq zzz qqq")], "doc_id long, lang string, text string"))
    docs.withColumn("source", F.lit(None).cast("string")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = la.op2_language_fusion(spark, str(tmp_path)).join(docs.select(F.col("doc_id"), "lang"), "doc_id", "left").collect()
    assert len(got) == 61 and all(r.language == (r.lang or "xx") for r in got)


def test_accuracy_on_a_held_out_fold(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    nothing = F.lit(None).cast("string")
    asked = docs.where(f"{FOLD} = 1").select("doc_id", "lang", "text", nothing.alias("declared"), nothing.alias("suffix"), nothing.alias("host"))
    got = la.identify(asked, la.train(docs.where(f"{FOLD} <> 1"))).where("lang IS NOT NULL").collect()
    assert got and sum(r.language == r.lang for r in got) >= 0.98 * len(got)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = la.op2_language_fusion(spark, sf).join(docs.select("doc_id", "lang"), "doc_id", "left").collect()
    assert len(got) == docs.count() + spark.read.parquet(f"{sf}/pages.parquet").count()
    own = [r for r in got if r.doc_id is not None]
    assert len(own) == docs.count()
    assert sum(r.language == r.lang for r in own) >= 0.98 * len(own)


def test_own_columns_may_have_any_names(spark):
    docs = spark.createDataFrame([("en", EN), ("fr", FR)], "lang string, text string")
    rows = docs.selectExpr("text", "lang AS declared", "lang AS suffix", "lang AS host", "lang AS q", "1 AS l", "2 AS domain", "3 AS p", "4 AS logs", "5 AS own")
    got = la.identify(rows, la.train(docs)).collect()
    assert all((r.q, r.l, r.domain, r.p, r.logs, r.own) == (r.language, 1, 2, 3, 4, 5) for r in got) and len(got) == 2


def test_tags_count_by_their_first_part(spark):
    docs = spark.createDataFrame([("en-US", EN), ("EN_gb", EN), (" en ", EN), ("fr-CA", FR), ("", FR), (None, FR)], "lang string, text string")
    assert la.train(docs).languages == ["en", "fr"]
