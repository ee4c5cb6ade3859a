import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from rankdrift.llm import embeddings as em

SCHEMA = "vec_id long, embedding array<float>, label int, code string, unit string"


def brute(rows):
    """vec_id to (links, least reachable id), by all cosines."""
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    unit = np.array([v / np.linalg.norm(v) for _, v in good])
    linked = unit @ unit.T >= 0.9
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = {i: 0 for i, _ in rows}
    for a, (i, _) in enumerate(good):
        links[i] = int(linked[a].sum()) - 1
        for b in np.flatnonzero(linked[a]):
            x, y = sorted((find(i), find(good[b][0])))
            root[y] = x
    return {i: (links[i], find(i)) for i, _ in rows}


def result(spark, rows):
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)
    return {r.vec_id: (r.n_links, r.component_id) for r in em.embedding_duplicates(df).collect()}


def near(draw, base, cosine):
    other = draw.standard_normal(len(base))
    base = base / np.linalg.norm(base)
    other -= other @ base * base
    return cosine * base + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def test_groups_and_chains(spark):
    """Tight groups, whose links are all found; chains and looser pairs, of which at least 0.9 are."""
    draw = np.random.default_rng(3)
    vectors = list(draw.standard_normal((600, 64)))
    for k in range(8):  # copies and near copies
        vectors += [near(draw, vectors[k], 0.995) * draw.uniform(0.1, 9) for _ in range(40)] + [vectors[k]] * 3
    tight = len(vectors)
    for k in range(20, 120):
        vectors.append(near(draw, vectors[k], draw.uniform(0.9, 0.97)))
    order = draw.permutation(len(vectors))
    rows = [(int(order[k]), [float(np.float32(x)) for x in v]) for k, v in enumerate(vectors)]
    want, got = brute(rows), result(spark, rows)
    assert all(got[rows[k][0]] == want[rows[k][0]] for k in [*range(8), *range(600, tight)])
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.9 * sum(n for n, _ in want.values())
    loose = [rows[k][0] for k in range(tight, len(rows))]
    assert sum(got[i][0] for i in loose) >= 0.9 * sum(want[i][0] for i in loose)


def test_clusters_linked_in_part(spark):
    """Two groups around vectors 25 degrees apart: some members are linked across, some are not."""
    draw = np.random.default_rng(4)
    a = draw.standard_normal(64)
    b = near(draw, a, np.cos(np.radians(25)))
    vectors = [near(draw, x, np.cos(np.radians(t))) for x in (a, b) for t in draw.uniform(1, 12, 30)]
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate([*vectors, *draw.standard_normal((200, 64))])]
    want, got = brute(rows), result(spark, rows)
    assert sum(n for n, _ in got.values()) >= 0.9 * sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert any(0 < want[i][0] < 59 for i in range(60))


@pytest.mark.parametrize("share", [0.5, 0.7, 0.85, 0.95])
def test_vectors_with_a_common_mean(spark, share):
    """Pairs between 0.9 and 0.92 on vectors whose mean has that share of the squared norm: at least 0.9 of all links."""
    draw = np.random.default_rng(6)
    mean = draw.standard_normal(64)
    mean *= np.sqrt(share) / np.linalg.norm(mean)
    vectors = []
    for _ in range(400):
        rest = draw.standard_normal(64)
        vectors.append(mean + np.sqrt(1 - share) * rest / np.linalg.norm(rest))
    for k in range(200):
        vectors.append(near(draw, vectors[k], draw.uniform(0.9, 0.92)))
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(vectors)]
    want, got = brute(rows), result(spark, rows)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.9 * sum(n for n, _ in want.values())


@pytest.mark.parametrize("share", [0.0, 0.6])
def test_large_table(spark, tmp_path, share):
    """50,000 vectors with pairs from 0.9 on planted: links of the ids divisible by 20, by all cosines, are found."""
    draw = np.random.default_rng(8)
    n, dim = 50_000, 64
    mean = draw.standard_normal(dim)
    rest = draw.standard_normal((n, dim))
    x = np.sqrt(share) * mean / np.linalg.norm(mean) + np.sqrt(1 - share) * rest / np.linalg.norm(rest, axis=1)[:, None]
    x /= np.linalg.norm(x, axis=1)[:, None]
    for k in range(0, 10_000, 2):  # pairs
        x[k + 1] = near(draw, x[k], draw.uniform(0.9, 0.96))
    for k in range(10_000, 13_000, 30):  # groups
        x[k : k + 30] = [near(draw, x[k], 0.99) for _ in range(30)]
    x[13_000:17_000] = x[13_000]  # copies
    x = x[draw.permutation(n)].astype("f4")
    flat = pa.ListArray.from_arrays(pa.array(np.arange(0, n * dim + 1, dim), pa.int32()), pa.array(x.ravel()))
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": flat}), tmp_path / "embeddings.parquet")
    got = {r.vec_id: r.n_links for r in em.op10_itq_hamming(spark, str(tmp_path)).collect()}
    unit = x.astype("f8") / np.linalg.norm(x.astype("f8"), axis=1)[:, None]
    queries = np.arange(0, n, 20)
    want = (unit[queries] @ unit.T >= 0.9).sum(axis=1) - 1
    found = np.array([got[k] for k in queries])
    copies = want == 3999
    assert len(got) == n and (found <= want).all() and (found[copies] == 3999).all() and copies.sum() > 100
    assert found[~copies].sum() >= 0.9 * want[~copies].sum() > 500


def test_work_grows_with_the_table():
    """The vectors that meet in the tables by chance, for each vector, grow far less than the table."""
    draw = np.random.default_rng(9)
    x = draw.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    plans = [(n, em.plan([x], n, 0.9)) for n in (10_000, 1_000_000, 100_000_000)]
    chance = [n * p.tables / 2**p.width for n, p in plans]
    assert all(b < 10 * a for a, b in zip(chance, chance[1:], strict=False))
    assert all(p.tables * p.width <= em.BITS * p.rotations or p.rotations == em.MOST_ROTATIONS for _, p in plans)
    assert all(len(set(cut)) == p.width for _, p in plans for cut in p.positions())


def test_no_cross_join(spark, capsys):
    """Candidates come from keys, also for vectors near their mean, of which all are linked."""
    x = np.random.default_rng(2).standard_normal((1000, 16)) * 0.05 + 1
    tables = em.plan([x / np.linalg.norm(x, axis=1)[:, None]], len(x), 0.9)
    vectors = spark.createDataFrame([(1, 2, 3, [4], 1)], "vec_id long, size int, code long, keys array<long>, cluster long")
    em.candidates(vectors, tables).explain()
    shown = capsys.readouterr().out
    assert "SortMergeJoin" in shown and "NestedLoop" not in shown and "Cartesian" not in shown


def test_several_vectors_of_one_id_and_lengths(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [1.0, 2.0, 3.0]), (4, [2.0, 4.0, 6.0]), (5, [0.0, 2.0])]
    rows += [(6, [1.0, 0.0, 0.0]), (7, [3.0]), (8, [5.0]), (9, [-5.0])]
    got = result(spark, rows)
    assert got == {1: (2, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (1, 1), 6: (0, 6), 7: (1, 7), 8: (1, 7), 9: (0, 9)}
    draw = np.random.default_rng(12)
    rows = []
    for dim in (24, 48):  # one length has a fit of its own, the other one is too rare for one
        for _ in range(700 if dim == 24 else 100):
            v = draw.standard_normal(dim)
            rows += [(len(rows), list(v)), (len(rows) + 1, list(near(draw, v, draw.uniform(0.9, 0.95))))]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    got = result(spark, rows)
    for dim in (24, 48):
        want = brute(mine := [(i, v) for i, v in rows if len(v) == dim])
        assert all(got[i][0] <= want[i][0] for i, _ in mine)
        assert sum(got[i][0] for i, _ in mine) >= 0.9 * sum(n for n, _ in want.values()) > 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf}/embeddings.parquet'").fetchall()
    got = {r.vec_id: (r.n_links, r.component_id) for r in em.op10_itq_hamming(spark, sf).collect()}
    assert got == brute(rows)


def test_odd_rows(spark):
    one = [1.0] + [0.0] * 7
    rows = [(1, one), (2, [x * 5 for x in one]), (3, None), (4, [0.0] * 8), (5, [float("nan")] * 8), (6, [None, *one[1:]])]
    rows += [(7, [float("inf"), *one[1:]]), (8, [1.0, 2.0]), (9, []), (10, [0.0, 1.0] + [0.0] * 6), (None, one), (2, [x * 5 for x in one])]
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)
    got = em.embedding_duplicates(df).collect()
    assert len(got) == len(rows)
    by_id = {r.vec_id: tuple(r)[1:] for r in got}
    assert by_id[1] == (1, 1, True) and by_id[2] == (1, 1, False) and by_id[None] == (0, None, True)
    assert all(by_id[k] == (0, k, True) for k in range(3, 11))
    assert em.embedding_duplicates(df.where("false")).count() == 0
    assert em.embedding_duplicates(df.where("vec_id IN (3, 4, 5)")).count() == 3
