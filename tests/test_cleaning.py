from itertools import permutations

from pyspark.sql import functions as F

from fixtures import day, edge_facts, fact, facts, rows
from rankdrift.operators import cleaning


def test_missing_location_becomes_empty(spark):
    filled = cleaning.fill_location(facts(spark, [fact(loc=None), fact(loc="Berlin")]))
    assert sorted(rows(filled, "loc")) == [("",), ("Berlin",)]


def test_missing_and_empty_location_are_one_key(spark):
    clean = cleaning.clean_ranks(facts(spark, [fact(loc=None, url="b"), fact(loc="", url="a")]))
    assert rows(clean, "loc", "url") == [("", "a")]


def test_survivor_does_not_depend_on_row_order(spark):
    copies = [fact(url=u) for u in ("c", "a", "b")]
    for order in permutations(copies):
        assert rows(cleaning.clean_ranks(facts(spark, list(order))), "url") == [("a",)]


def test_order_columns_choose_the_survivor(spark):
    numbered = facts(spark, [fact(url=u) for u in "abc"]).withColumn(
        "seen", F.when(F.col("url") == "b", 1).when(F.col("url") == "c", 3).otherwise(2)
    )
    assert rows(cleaning.clean_ranks(numbered, ["seen"]), "url") == [("b",)]
    assert rows(cleaning.clean_ranks(numbered, ["seen"], latest=True), "url") == [("c",)]


def test_clean_table_has_no_duplicate_keys(spark):
    raw = edge_facts(spark, [("desktop", 2, 1, "u9"), ("desktop", 2, 1, "u1")])
    assert rows(cleaning.duplicate_keys(raw), "device", "crawl_date", "rank", "n") == [
        ("desktop", day(2), 1, 3)
    ]
    clean = cleaning.clean_ranks(raw)
    assert clean.count() == 11
    assert cleaning.duplicate_keys(clean).count() == 0
    assert clean.columns == ["keyword", "market", "loc", "device", "crawl_date", "rank", "url"]


def test_date_range_includes_both_ends(spark):
    df = edge_facts(spark)
    days = lambda d: sorted({r[0].day for r in rows(d, "crawl_date")})
    assert days(cleaning.date_range(df, "2017-07-02", "2017-07-03")) == [2, 3]
    assert days(cleaning.date_range(df, start=day(3))) == [3, 4]
    assert days(cleaning.date_range(df, end=day(1))) == [1]
    assert days(cleaning.date_range(df)) == [1, 2, 3, 4]
