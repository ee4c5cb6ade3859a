import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from fixtures import day, edge_facts, fact, facts, rows
from rankdrift.functions import hashing, signatures
from rankdrift.operators import compare, exact, minhash
from rankdrift.plans.views import rank_facts
from rankdrift.schema import RANK_COLUMNS, SIGNATURE_SCHEMA

SF_DIR = "/root/testdata/sf0.01"


def string_hash(text):
    state = 0
    units = text.encode("utf-16-be")
    for i in range(0, len(units), 2):
        state = (state * 31 + int.from_bytes(units[i : i + 2])) & 0xFFFFFFFF
    return state - 2**32 if state >= 2**31 else state


def test_string_hash(spark):
    texts = ["", "a", "hello", "é😀", "𝒳y\U0010ffff", "日本語 search", "x" * 300, "a\u0000b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    hashed = dict(rows(df.select("t", hashing.string_hash32(F.col("t")))))
    assert hashed == {t: string_hash(t) for t in texts}
    assert hashed["hello"] == 99162322
    assert hashed["é😀"] == 1996812


def test_golden_hash_value(spark):
    golden = facts(
        spark,
        [
            fact(
                keyword="search analytics",
                market="US-en",
                url="support.google.com/webmasters/answer/6155685?hl=en",
            )
        ],
    )
    text = hashing.element_text(RANK_COLUMNS.element, separator="")
    seeds = golden.select(hashing.string_hash32(text).alias("seed"))
    values = [F.expr(hashing.compat_hash("seed", 62, 92, m)) for m in (3, 401, 10007)]
    assert rows(seeds.select("seed", *values)) == [(-1760612929, 2, 280, 1307)]


def test_compat_hash_wraps_like_32_bit_integers(spark):
    rng = random.Random(3)
    seeds = [rng.randrange(-(2**31), 2**31) for _ in range(500)] + [-(2**31), 2**31 - 1, 0, -1]
    df = spark.createDataFrame([(s,) for s in seeds], "seed bigint")
    for a, b, m in ((62, 92, 1009), (100, 29, 3), (8, 9, 2**31 - 1)):
        for seed, value in rows(df.select("seed", F.expr(hashing.compat_hash("seed", a, b, m)))):
            wrapped = (seed * a + b + 2**31) % 2**32 - 2**31
            assert value == abs(wrapped) % m


def test_element_text_keeps_the_place_of_missing_values(spark):
    df = spark.createDataFrame(
        [("a", None, "b"), ("a", "b", None), ("ab", None, None)], "x string, y string, z string"
    )
    texts = [r[0] for r in rows(df.select(hashing.element_text(["x", "y", "z"])))]
    assert len(set(texts)) == 3


def element_ids(values):
    texts = ["" if v is None else str(v) for v in values]
    md5 = int(hashlib.md5("\u0001".join(texts).encode()).hexdigest()[:15], 16)
    state = 42
    for text in texts:
        state = xxhash.xxh64_intdigest(text.encode(), seed=state)
    return md5, state >> 4


def test_element_ids(spark):
    df = edge_facts(spark, [("desktop", 5, 1, "größe 😀")])
    cols = RANK_COLUMNS.element
    got = rows(df.select(*cols, hashing.md5_id(cols), hashing.xxhash_id(cols)))
    for *values, md5, xx in got:
        assert (md5, xx) == element_ids(values)


@pytest.mark.parametrize("element_id", ["md5", "xxhash64"])
def test_signatures_against_brute_force(spark, element_id):
    df = edge_facts(spark)
    pairs = hashing.coefficients(10, seed=5)
    expected = {}
    for *values, device, crawl_date in rows(df, *RANK_COLUMNS.element, "device", "crawl_date"):
        x = element_ids(values)[element_id == "xxhash64"]
        high, low = x >> 29, x & (2**29 - 1)
        hashes = [((high * a + b) % (2**31 - 1) << 29) + low for a, b in pairs]
        old = expected.get((crawl_date, device), hashes)
        expected[crawl_date, device] = [min(p) for p in zip(old, hashes)]
    got = minhash.minhash_signatures(df, pairs=pairs, element_id=element_id)
    assert {(d, g): list(s) for d, g, s in rows(got)} == expected


def test_binned_signatures_against_brute_force(spark):
    df = edge_facts(spark)
    k, expected = 5, {}
    for *values, device, crawl_date in rows(df, *RANK_COLUMNS.element, "device", "crawl_date"):
        x = element_ids(values)[1]
        sig = expected.setdefault((crawl_date, device), [signatures.EMPTY] * k)
        sig[x % k] = min(sig[x % k], x)
    got = minhash.minhash_signatures(df, k, method="bins")
    assert {(d, g): list(s) for d, g, s in rows(got)} == expected


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        minhash.minhash_signatures(edge_facts(spark), method="other")


def test_extreme_ids_do_not_overflow(spark):
    df = spark.createDataFrame([(0,), (2**60 - 1,), (2**59,)], "id bigint")
    high, low = hashing.split_id(F.col("id"))
    parts = df.select(high.alias("h"), low.alias("l"))
    for a, b in ((hashing.PRIME - 1, hashing.PRIME - 1), (1, 0)):
        values = [r[0] for r in rows(parts.select(F.expr(hashing.affine_hash("h", "l", a, b))))]
        assert all(0 <= v < 2**60 for v in values)


def test_coefficients():
    pairs = hashing.coefficients(100)
    assert pairs[:7] == hashing.coefficients(7)
    assert pairs != hashing.coefficients(100, seed=2)
    assert len(set(pairs)) == 100
    assert all(1 <= a < hashing.PRIME and 0 <= b < hashing.PRIME for a, b in pairs)
    assert len(hashing.COMPAT_COEFFICIENTS) == 100


def test_equal_sets_are_100_and_disjoint_sets_near_0(spark):
    same = [fact(d, url=f"u{i}", rank=i + 1) for i in range(200) for d in ("desktop", "smartphone")]
    apart = [fact(d, 2, i + 1, f"{d}{i}") for i in range(200) for d in ("desktop", "smartphone")]
    alone = [fact("desktop", 3)]
    got = rows(minhash.minhash_similarity(facts(spark, same + apart + alone)))
    assert got[0] == (day(1), 100)
    assert got[1][1] <= 3
    assert got[2] == (day(3), 0)


def test_estimate_is_near_the_exact_value_for_large_sets(spark):
    """Two sets of 60,000 elements sharing a half of 80,000: enough to expose short hashes."""
    n = spark.range(160000).withColumn("i", F.col("id") % 80000)
    df = n.select(
        F.lit("k").alias("keyword"),
        F.lit("US").alias("market"),
        F.lit(None).cast("string").alias("loc"),
        F.when(F.col("id") < 80000, "desktop").otherwise("smartphone").alias("device"),
        F.lit(day(1)).alias("crawl_date"),
        (F.col("i") % 100).cast("int").alias("rank"),
        F.concat(F.lit("u"), F.col("i")).alias("url"),
        F.col("i"),
        F.col("id"),
    ).where("(id < 80000 AND i < 60000) OR (id >= 80000 AND i >= 20000)")
    assert rows(exact.exact_similarity(df)) == [(day(1), 50)]
    for method in ("functions", "bins"):
        estimate = rows(minhash.minhash_similarity(df, k=400, method=method))[0][1]
        assert abs(estimate - 50) <= 8
    sketched = rows(exact.sketch_similarity(df, log_entries=14))[0][1]
    assert abs(sketched - 50) <= 2


def test_estimate_error_is_bounded(spark):
    df = rank_facts(spark, SF_DIR)
    compared = compare.estimate_vs_exact(
        minhash.minhash_similarity(df), exact.exact_similarity(df)
    )
    ((dates, mean_error, max_error),) = rows(compare.estimate_error(compared))
    assert dates == 30 and mean_error < 4 and max_error <= 15


def test_compat_needs_a_modulus(spark):
    with pytest.raises(ValueError):
        minhash.minhash_similarity(edge_facts(spark), semantics="compat")


def test_compat_similarity_of_the_event_view(spark):
    df = rank_facts(spark, SF_DIR)
    got = rows(minhash.minhash_similarity(df, modulus=1009, semantics="compat"))
    assert [s for _, s in got[:6]] == [60, 68, 82, 64, 55, 71]


def sig_rows(spark, *sigs):
    data = [(day(1), "desktop", s) for s in sigs]
    return spark.createDataFrame(data, SIGNATURE_SCHEMA)


def merged(spark, *sigs):
    return rows(minhash.merge_signature_rows(sig_rows(spark, *sigs), 3), "sig")


def test_merge_of_any_number_of_signatures(spark):
    assert merged(spark, [5, 2, 9], [4, 7, 9], []) == [([4, 2, 9],)]
    assert merged(spark, [4, 7, 9], [], [5, 2, 9], [5, 2, 9]) == [([4, 2, 9],)]
    assert merged(spark, [], []) == [([],)]


def test_signatures_of_another_length_do_not_merge(spark):
    with pytest.raises(Exception, match="another length than 3"):
        merged(spark, [5, 2, 9], [5, 2, 9, 1])


def test_pairwise_merge(spark):
    df = spark.createDataFrame(
        [([5, 2, 9], [4, 7, 9]), ([5, 2, 9], []), ([], [4, 7, 9]), ([], []), (None, [1]), ([1], None)],
        "a array<bigint>, b array<bigint>",
    )
    got = [r[0] for r in rows(df.select(signatures.merge_signatures(F.col("a"), F.col("b"))))]
    assert got == [[4, 2, 9], [5, 2, 9], [4, 7, 9], [], [1], [1]]


@pytest.mark.parametrize("method", ["functions", "bins"])
def test_signature_of_a_union_is_the_merge(spark, method):
    df = rank_facts(spark, "/root/testdata/sf0.001")
    split = F.col("rank") > 7
    parts = minhash.minhash_signatures(df.where(split), method=method).union(
        minhash.minhash_signatures(df.where(~split), method=method)
    )
    whole = minhash.minhash_signatures(df, method=method)
    assert sorted(rows(minhash.merge_signature_rows(parts))) == sorted(rows(whole))


def test_estimators(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1, 3, 2, 9])], "a array<bigint>, b array<bigint>")
    similar = lambda e: rows(df.select(signatures.signature_similarity(F.col("a"), F.col("b"), e)))
    assert similar("positional") == [(25,)]
    assert similar("value_set") == [(60,)]


def test_empty_bins_do_not_count(spark):
    e = signatures.EMPTY
    df = spark.createDataFrame(
        [([1, e, 3, e], [1, 2, e, e]), ([e, e], [e, e])], "a array<bigint>, b array<bigint>"
    )
    similar = signatures.positional_similarity(F.col("a"), F.col("b"))
    assert rows(df.select(similar)) == [(33,), (0,)]


def test_every_pair_of_three_devices(spark):
    df = edge_facts(spark, [("tablet", 1, 1, "u1"), ("tablet", 1, 2, "u5"), ("watch", 1, 1, "u1")])
    groups = ("desktop", "smartphone", "tablet")
    sigs = minhash.minhash_signatures(df, k=400)
    pairs = minhash.pairwise_signature_similarity(sigs, groups)
    exactly = exact.pairwise_exact_similarity(df, groups)
    both = pairs.withColumnRenamed("similarity", "estimate").join(
        exactly, ["crawl_date", "device_a", "device_b"]
    )
    assert pairs.count() == exactly.count() == both.count() == 12
    assert both.where("abs(estimate - similarity) > 8").count() == 0


def test_row_order_and_partitions_do_not_matter(spark):
    df = rank_facts(spark, "/root/testdata/sf0.001")
    shuffled = df.repartition(7).orderBy(F.rand(1))
    assert sorted(rows(minhash.minhash_signatures(df))) == sorted(
        rows(minhash.minhash_signatures(shuffled))
    )


def test_first_prime_from():
    primes = [n for n in range(2, 2000) if all(n % q for q in range(2, n))]
    assert [hashing.first_prime_from(n) for n in range(1900)] == [min(p for p in primes if p >= n) for n in range(1900)]
    assert hashing.first_prime_from(2**31 - 4) == 2**31 - 1


def test_compat_modulus_follows_the_distinct_elements(spark):
    df = facts(spark, [fact(device, rank=rank) for rank in range(1, 9) for device in ("desktop", "smartphone")])
    assert minhash.compat_modulus(df) == 11
    assert minhash.compat_modulus(df.limit(0)) == 2


def test_similarities_come_in_date_order(spark):
    """Also if the rows come in another order and the sort has many partitions."""
    days = [fact(device, d, r) for d in range(1, 29) for device in ("desktop", "smartphone") for r in (1, 2)]
    df = facts(spark, days[::-1]).repartition(8, F.rand(3))
    sigs = minhash.minhash_signatures(df, k=4)
    for similar in (
        exact.exact_similarity(df),
        exact.exact_similarity(df, semantics="compat"),
        exact.sketch_similarity(df),
        minhash.minhash_similarity(df, k=4),
        minhash.minhash_similarity(df, ("desktop", "smartphone"), k=4),
        minhash.signature_pairs(sigs),
    ):
        assert rows(similar, "crawl_date") == [(day(d),) for d in range(1, 29)]
