import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rankdrift.llm import near_duplicates as nd
from rankdrift.llm.common import components, looked_up
from tests.llm.conftest import ODD_TEXTS

SCHEMA = "doc_id long, text string, n long, rep string, component string"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """doc_id to (set size, least reachable id), by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def result(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], SCHEMA)
    return nd.near_duplicates(docs).collect()


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.op9_minhash_tensored(spark, sf).collect()}
    assert got == brute(rows)
    assert len({c for _, c in got.values()}) < len(rows)


def test_families_around_the_threshold(spark):
    """Many variants of few texts: dense groups in which some pairs are linked, some not and some by others only."""
    pick, rows = random.Random(5), []
    words = [f"w{k}" for k in range(500)]
    for _ in range(6):
        base = pick.choices(words, k=80)
        for _ in range(25):
            own = list(base)
            for _ in range(pick.randint(0, 4)):
                own[pick.randrange(len(own))] = pick.choice(words)
            rows.append((len(rows), " ".join(own)))
    pick.shuffle(rows)
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in result(spark, rows)}
    assert got == brute(rows)


def test_large_buckets(spark, monkeypatch):
    """The same family with every bucket compared block by block."""
    monkeypatch.setattr(nd, "SMALL", 1)
    monkeypatch.setattr(nd, "BLOCK", 7)
    test_families_around_the_threshold(spark)


def test_longer_keys(spark, monkeypatch):
    """The same family with the tables of a far larger corpus."""
    wide = nd.banding_of(10**9)
    assert wide.n_tables > 160
    monkeypatch.setattr(nd, "banding_of", lambda n, percent: wide)
    test_families_around_the_threshold(spark)


def test_banding_follows_the_number_of_documents():
    assert nd.banding_of(0) == nd.banding_of(300_000) == nd.Banding((10, 16), (2, 3))
    for n in (10**6, 10**8, 10**11):
        banding, fixed = nd.banding_of(n), nd.banding_of(0)
        assert banding.missed(0.75) <= nd.MISSED and banding.n_tables < 1000
        cost = [b.n_tables + nd.PAIR_COST * n * b.met(nd.UNRELATED) for b in (banding, fixed)]
        assert cost[0] < cost[1]
        # As many minhashes as the collections need, far fewer than the tables have.
        assert sum(s * r for s, r in zip(banding.sides, banding.rows)) * 4 < banding.n_tables * sum(banding.rows)
    assert nd.banding_of(1000, 50).missed(0.5) <= nd.MISSED and nd.banding_of(1000, 100).missed(0.99) <= nd.MISSED
    with pytest.raises(ValueError):
        nd.banding_of(1000, 40)


def test_sketch_keeps_similar_pairs():
    draw, lost, kept, n_close = np.random.default_rng(8), 0, 0, 0
    for _ in range(2000):
        n = int(draw.integers(5, 900))
        shared = int(np.ceil(6 / 7 * n))  # so that the similarity is 0.75 at least, and hardly more
        pool = np.unique(draw.integers(0, 1 << 63, 2 * n + 9, dtype=np.uint64) * np.uint64(2))
        a, b = pool[:n], np.concatenate((pool[:shared], pool[n : 2 * n - shared]))
        a, b = np.sort(a), np.sort(b)
        assert nd.similar(a, b)
        lost += not nd.possible(nd.bins_of(a), nd.bins_of(b), len(a), len(b))
        c = np.sort(np.concatenate((pool[: n // 2], pool[n : 2 * n - n // 2])))
        if n > 200:
            n_close += 1
            kept += nd.possible(nd.bins_of(a), nd.bins_of(c), len(a), len(c))
    assert lost <= 1 and kept < 0.01 * n_close


def test_odd_rows(spark):
    rows = list(enumerate(ODD_TEXTS)) + [(6, ODD_TEXTS[6]), (None, ODD_TEXTS[6]), (None, None)]
    rows += [(20, "Three Short words"), (21, "three\tshort  WORDS"), (22, "Ärger a b c d e"), (23, "ärger a b c d e")]
    got = defaultdict(list)
    for r in result(spark, rows):
        got[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert sorted(got[None]) == [(0, None, True), (1, None, True)]
    assert got[0] == [(0, 0, True)] and got[1] == [(0, 1, True)] and got[2] == [(0, 2, True)]
    assert got[3] == [(1, 3, True)] and got[4] == [(1, 4, True)] and got[5] == [(1, 5, True)]
    assert got[6] == [(1, 6, True)] * 2 and got[7] == [(1, 6, False)]
    assert got[20] == [(1, 20, True)] and got[21] == [(1, 20, False)]
    assert got[22] == [(2, 22, True)] and got[23] == [(2, 23, True)]


def test_empty_table(spark):
    assert result(spark, []) == []


@pytest.mark.parametrize("hub", [60, 3000])
def test_components(spark, hub):
    pick = random.Random(2)
    links = [(k, k + 1) for k in range(100, 400)] + [(5000, 5000 + k) for k in range(1, hub)] + [(k, 999) for k in range(900, 960)]
    links += [(pick.randrange(2000, 2400), pick.randrange(2000, 2400)) for _ in range(250)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {x: find(x) for x in root}


def test_frequent_keys_are_spread(spark):
    """Every key's value is found, of frequent keys, of other ones and of one without a value."""
    rows = spark.createDataFrame([(k % 7 if k < 4000 else k, k) for k in range(6000)], "key long, other long")
    values = rows.groupBy(F.col("key").alias("node")).agg((F.col("node") * 2).alias("value"), F.count("*").alias("degree"))
    values = values.where("node <> 4001")
    got = looked_up(rows, "key", "other", values)
    assert got.columns == ["key", "other", "value"]
    assert {(r.key, r.other): r.value for r in got.collect()} == {
        (r.key, r.other): None if r.key == 4001 else r.key * 2 for r in rows.collect()
    }
