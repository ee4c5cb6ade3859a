import random

import pytest
from pyspark.sql import functions as F

from fixtures import day, edge_facts, fact, facts, rows
from rankdrift.operators import exact, minhash, top_spot, urls
from rankdrift.schema import RankColumns


def test_cutoff_is_strict(spark):
    assert rows(urls.top_urls(edge_facts(spark), 10, k=5)) == [("u3", 2)]


def test_equal_counts_go_by_url_and_empty_stays_empty(spark):
    df = facts(spark, [fact(url=u, rank=20 + i) for i, u in enumerate("bbaac")])
    assert rows(urls.top_urls(df, 10, k=2)) == [("a", 2), ("b", 2)]
    assert rows(urls.top_urls(df, 100)) == []


def departures(df, **kwargs):
    return sorted(rows(top_spot.departure_counts(df, **kwargs), "device", "url", "n"))


EXPECTED = [
    ("desktop", "u1", 2),
    ("desktop", "u2", 1),
    ("smartphone", "u1", 1),
    ("smartphone", "u2", 1),
]


def test_departures_count_runs(spark):
    df = edge_facts(spark)
    assert departures(df) == EXPECTED
    assert departures(df, semantics="compat") == EXPECTED
    assert rows(top_spot.top_spot_departures(df), "device", "url", "n") == [("desktop", "u1", 2)]


def test_copies_hide_a_departure_in_compat_only(spark):
    df = edge_facts(spark, [("desktop", 2, 1, "u1")])
    assert departures(df) == EXPECTED
    assert departures(df, semantics="compat")[0] == ("desktop", "u1", 1)


def test_unknown_semantics(spark):
    with pytest.raises(ValueError):
        top_spot.departure_counts(edge_facts(spark), semantics="other")
    with pytest.raises(ValueError):
        exact.exact_similarity(edge_facts(spark), semantics="other")


def test_three_forms_of_departures_agree_across_mask_blocks(spark):
    """Random presence over 400 days, so runs cross the borders of the day masks."""
    rng = random.Random(7)
    presence = [(d, u) for d in range(400) for u in "xyz" if rng.random() < 0.7]
    df = spark.createDataFrame(
        [(f"k{d % 1}", "US", None, "desktop", d - 100, 1, u) for d, u in presence * 2],
        "keyword string, market string, loc string, device string, d int, rank int, url string",
    ).withColumn("crawl_date", F.date_add(F.lit("1970-01-01").cast("date"), F.col("d")))
    runs = {u: 0 for u in "xyz"}
    for d, u in presence:
        runs[u] += (d + 1, u) not in presence
    expected = sorted(runs.items())
    by_url = lambda d: sorted(rows(d.groupBy("url").count()))
    assert sorted(rows(top_spot.departure_counts(df), "url", "n")) == expected
    assert by_url(top_spot.departure_days(df)) == expected
    assert by_url(top_spot.departure_days_anti_join(df)) == expected


def test_previous_day_needs_the_day_directly_before(spark):
    df = facts(spark, [fact(n=1, url="u1"), fact(n=2, url="u2"), fact(n=4, url="u3")])
    followed = rows(top_spot.prev_day_url(df).orderBy("crawl_date"), "url", "prev_url")
    assert followed == [("u1", None), ("u2", "u1"), ("u3", None)]


def test_previous_url_and_changes_of_edge_rows(spark):
    df = edge_facts(spark)
    top = top_spot.prev_day_url(df.where("rank = 1")).orderBy("device", "crawl_date")
    assert [r[0] for r in rows(top, "prev_url")] == [None, "u1", "u1", "u2", None, "u1"]
    assert sorted(rows(top_spot.top_spot_changes(df), "device", "n")) == [
        ("desktop", 2),
        ("smartphone", 1),
    ]


def test_exact_similarity_of_edge_rows(spark):
    df = edge_facts(spark)
    expected = [(day(1), 40), (day(2), 0), (day(3), 0), (day(4), 0)]
    assert rows(exact.exact_similarity(df)) == expected
    assert rows(exact.exact_similarity(df, element_key="hash")) == expected
    assert rows(exact.exact_similarity(df, semantics="compat")) == expected
    assert rows(exact.sketch_similarity(df)) == expected


def test_copies_count_as_shared_in_compat_only(spark):
    df = edge_facts(spark, [("desktop", 2, 1, "u1")])
    assert rows(exact.exact_similarity(df))[1] == (day(2), 0)
    assert rows(exact.exact_similarity(df, semantics="compat"))[1] == (day(2), 50)


def test_missing_and_empty_location_are_different_elements(spark):
    df = facts(spark, [fact(loc=None), fact(loc="", device="smartphone")])
    for key in ("columns", "hash"):
        assert rows(exact.exact_similarity(df, element_key=key)) == [(day(1), 0)]


def test_similarity_is_symmetric_and_ignores_other_devices(spark):
    df = edge_facts(spark, [("tablet", 1, 1, "u1"), ("tablet", 9, 1, "u1")])
    there = rows(exact.exact_similarity(df, devices=("desktop", "smartphone")))
    back = rows(exact.exact_similarity(df, devices=("smartphone", "desktop")))
    assert there == back == [(day(1), 40), (day(2), 0), (day(3), 0), (day(4), 0), (day(9), 0)]


DAYS_OF_OTHERS = [("tablet", 9, 1, "u1"), ("watch", 9, 1, "u1")]


@pytest.mark.parametrize(
    "similarity",
    [
        exact.exact_similarity,
        exact.sketch_similarity,
        lambda df, devices=None: exact.exact_similarity(df, devices, semantics="compat"),
        minhash.minhash_similarity,
        lambda df, devices=None: minhash.minhash_similarity(df, devices, modulus=1009, semantics="compat"),
    ],
)
def test_every_date_stays_whatever_devices_it_has(spark, similarity):
    df = edge_facts(spark, DAYS_OF_OTHERS)
    named = dict(rows(similarity(df, ("desktop", "smartphone"))))
    assert set(named) == {day(n) for n in (1, 2, 3, 4, 9)} and named[day(9)] == 0 and named[day(1)] > 0
    found = dict(rows(similarity(df)))
    assert found[day(9)] == 100 and found[day(3)] == 0 and found[day(1)] == named[day(1)]
    assert dict(rows(similarity(df, ("Desktop", "mobile")))) == dict.fromkeys(named, 0)


@pytest.mark.parametrize("similarity", [exact.exact_similarity, exact.sketch_similarity, minhash.minhash_similarity])
def test_more_than_two_sets_on_a_date_are_an_error(spark, similarity):
    with pytest.raises(Exception, match="more than two sets"):
        similarity(edge_facts(spark, [("tablet", 1, 1, "u1")])).collect()


def test_every_pair_of_three_devices(spark):
    df = edge_facts(spark, [("tablet", 1, 1, "u1"), ("tablet", 1, 2, "u5")])
    pairs = exact.pairwise_exact_similarity(df, ("desktop", "smartphone", "tablet"))
    first = pairs.where(F.col("crawl_date") == F.lit(day(1)))
    assert sorted(rows(first, "device_a", "device_b", "similarity")) == [
        ("desktop", "smartphone", 40),
        ("desktop", "tablet", 50),
        ("smartphone", "tablet", 66),
    ]


def test_many_groups(spark):
    """Pairs are rows, so the plan is the same for any number of groups."""
    df = facts(spark, [fact(f"d{g:03d}", rank=r) for g in range(100) for r in (g, g + 1)])
    got = {(a, b): s for _, a, b, s in rows(exact.pairwise_exact_similarity(df))}
    near = {(f"d{g:03d}", f"d{g + 1:03d}"): 33 for g in range(99)}
    assert got == {(f"d{a:03d}", f"d{b:03d}"): 0 for a in range(100) for b in range(a + 1, 100)} | near


def test_pairs_of_named_groups(spark):
    shares = {"a": {1, 2}, "b": {2, 3}, "c": {1, 2, 3}, "d": {9}, "e": {2}}
    df = facts(spark, [fact(g, rank=r) for g, ranks in shares.items() for r in ranks])
    got = exact.pairwise_exact_similarity(df, tuple(shares))
    expected = sorted(
        (x, y, 100 * len(shares[x] & shares[y]) // len(shares[x] | shares[y]))
        for x in shares for y in shares if x < y
    )
    assert sorted(rows(got, "device_a", "device_b", "similarity")) == expected


def test_groups_have_to_differ(spark):
    with pytest.raises(ValueError):
        exact.exact_similarity(edge_facts(spark), devices=("desktop", "desktop"))


def test_columns_are_parameters(spark):
    cols = RankColumns(subject=("part",), group="shop", date="day", rank="place", entity="maker")
    df = spark.createDataFrame(
        [("p", "s1", 1, "m"), ("p", "s2", 1, "m"), ("q", "s2", 1, "m")],
        "part string, shop string, place int, maker string",
    ).withColumn("day", F.lit(day(1)))
    assert rows(exact.exact_similarity(df, ("s1", "s2"), cols=cols)) == [(day(1), 50)]
    assert rows(urls.top_urls(df, 0, cols=cols)) == [("m", 3)]
    assert top_spot.departure_counts(df, cols=cols).columns == ["part", "shop", "maker", "n"]
