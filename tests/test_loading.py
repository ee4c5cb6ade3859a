"""Counts taken while a table is written, and tables that are laid out for finding keys."""

import pytest
from pyspark.sql import functions as F

from fixtures import day, edge_facts, fact, facts, rows
from rankdrift.operators import cleaning, top_spot
from rankdrift.sources import csv_report, rank_table


def test_counts_are_those_of_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = edge_facts(spark, [("desktop", 1, 1, "u9"), ("desktop", 1, 1, "u8"), ("desktop", 2, 1, "u1")])
    counts = rank_table.load_rank_table(df, path)
    assert counts == rank_table.LoadCounts(14, 0, 4, day(1), day(4), 11, 2)
    assert counts.dropped_rows == 3
    assert counts.repeated_keys == cleaning.duplicate_keys(cleaning.fill_location(df)).count()
    assert sorted(rows(rank_table.read_rank_table(spark, path))) == sorted(rows(cleaning.clean_ranks(df)))


def test_bad_rows_are_counted_and_left_out(spark, tmp_path):
    report = tmp_path / "r.csv"
    lines = ["a,US,,desktop,2017-07-01,1,u1", "a,US,,desktop,2017-07-01,x,u1", "a,US,,desktop,2017,1,u1", "a,US,,desktop,2017-07-01,1,u2"]
    report.write_text("k,m,l,d,c,r,u\n" + "\n".join(lines) + "\n")
    df = csv_report.read_rank_csv(spark, str(report), on_bad="keep")
    counts = rank_table.load_rank_table(df, str(tmp_path / "t"))
    assert counts == rank_table.LoadCounts(2, 2, 1, day(1), day(1), 1, 1)
    assert rows(rank_table.read_rank_table(spark, str(tmp_path / "t"))) == [("a", "US", "", "desktop", day(1), 1, "u1")]


def test_only_bad_rows_and_none(spark, tmp_path):
    nothing = rank_table.LoadCounts(0, 0, 0, None, None, 0, 0)
    assert rank_table.load_rank_table(facts(spark, []), str(tmp_path / "a")) == nothing
    bad = edge_facts(spark).withColumn(csv_report.BAD_ROW, F.lit("bad"))
    assert rank_table.load_rank_table(bad, str(tmp_path / "b")) == nothing._replace(bad_rows=11)


def test_one_key_and_one_bad_line_repeated(spark, tmp_path):
    """Copies of a key and bad rows meet before the shuffle."""
    base = edge_facts(spark).limit(1).withColumn(csv_report.BAD_ROW, F.lit(None).cast("string"))
    many = base.crossJoin(spark.range(0, 60000, 1, 4))
    many = many.withColumn(csv_report.BAD_ROW, F.when(F.col("id") % 3 == 0, "bad"))
    counts = rank_table.load_rank_table(many, str(tmp_path / "t"), ["id"])
    assert (counts.rows, counts.bad_rows, counts.keys, counts.repeated_keys) == (40000, 20000, 1, 1)


@pytest.fixture(scope="module")
def lookup_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lookup") / "ranks")
    n = spark.range(0, 120_000, 1, 4)
    df = n.select(
        F.concat(F.lit("keyword "), F.xxhash64(F.col("id") % 20_000)).alias("keyword"),
        F.lit("US").alias("market"),
        F.lit("").alias("loc"),
        F.lit("desktop").alias("device"),
        F.date_add(F.lit("2017-07-01").cast("date"), (F.col("id") % 2).cast("int")).alias("crawl_date"),
        (F.col("id") / 20_000 + 1).cast("int").alias("rank"),
        F.concat(F.lit("https://example/"), F.xxhash64("id", F.lit(1))).alias("url"),
    )
    rank_table.write_rank_table(df, path, lookup=("keyword", "url"), row_group=64 << 10)
    return path


def rows_read(df):
    """Rows that the scan handed on, after row groups and pages were left out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_reads_a_fraction(spark, lookup_table):
    ranks = rank_table.read_rank_table(spark, lookup_table)
    n, some = ranks.count(), ranks.where("rank = 3").orderBy("url").first()
    by_keyword = rank_table.find_ranks(spark, lookup_table, keywords=[some.keyword])
    assert n == 120_000
    assert sorted(rows(by_keyword)) == sorted(rows(ranks.where(F.concat("keyword", F.lit("")) == some.keyword)))
    assert by_keyword.count() == 6 and rows_read(by_keyword) < n / 10
    by_url = rank_table.find_ranks(spark, lookup_table, urls=[some.url])
    assert by_url.count() == 1 and rows_read(by_url) < n / 4
    assert rows_read(rank_table.find_ranks(spark, lookup_table, urls=["https://example/none"])) < n / 20
    both = rank_table.find_ranks(spark, lookup_table, [some.keyword, "other"], [some.url], "2017-07-01", "2017-07-02")
    assert rows(both) == [tuple(some)]


def test_without_lookup_columns_everything_is_read(spark, lookup_table, tmp_path):
    path = str(tmp_path / "plain")
    rank_table.write_rank_table(rank_table.read_rank_table(spark, lookup_table), path)
    some = rank_table.read_rank_table(spark, path).first()
    assert rows_read(rank_table.find_ranks(spark, path, keywords=[some.keyword])) >= 60_000  # its date


# The calendar of crawled days


def crawled(spark, *days):
    return spark.createDataFrame([(day(n),) for n in days], "crawl_date date")


def test_a_missing_report_is_no_departure(spark):
    df = facts(spark, [fact(n=n, url=u) for n, u in ((1, "a"), (2, "a"), (4, "a"), (6, "b"), (7, "a"))])
    calendar = crawled(spark, 1, 2, 4, 6, 7)
    days = lambda c: sorted((r.url, r.crawl_date.day) for r in top_spot.departure_days(df, calendar=c).collect())
    assert days(None) == [("a", 2), ("a", 4), ("a", 7), ("b", 6)]
    assert days(calendar) == [("a", 4), ("a", 7), ("b", 6)]
    # A day that was crawled, on which nobody was seen, is one.
    assert days(crawled(spark, 1, 2, 3, 4, 6, 7)) == [("a", 2), ("a", 4), ("a", 7), ("b", 6)]
    counts = {r.url: r.n for r in top_spot.departure_counts(df, calendar=calendar).collect()}
    assert counts == {"a": 2, "b": 1}
    runs = top_spot.top_spot_runs(df, calendar=calendar)
    assert sorted((r.url, r.first_day.day, r.last_day.day, r.days) for r in runs.collect()) == [
        ("a", 1, 4, 3), ("a", 7, 7, 1), ("b", 6, 6, 1)
    ]
    previous = {r.crawl_date.day: r.prev_url for r in top_spot.prev_day_url(df, calendar=calendar).collect()}
    assert previous == {1: None, 2: "a", 4: "a", 6: "a", 7: "b"}
    assert [r.n for r in top_spot.top_spot_changes(df, calendar=calendar).collect()] == [2]


def test_runs_end_with_departures(spark):
    df = edge_facts(spark)
    runs = top_spot.top_spot_runs(df).withColumnRenamed("last_day", "crawl_date")
    assert sorted(rows(runs.select(*top_spot.departure_days(df).columns)), key=str) == sorted(rows(top_spot.departure_days(df)), key=str)


def test_rows_of_a_day_that_was_not_crawled(spark):
    with pytest.raises(Exception, match="2017-07-03"):
        top_spot.departure_days(edge_facts(spark), calendar=crawled(spark, 1, 2, 4)).collect()


def test_long_calendar_in_blocks(spark):
    """Blocks of days hold calendar days, also across many of them."""
    dates = [n for n in range(1, 400) if n % 5]
    df = spark.createDataFrame([(n,) for n in dates if n % 7], "n int").select(
        F.lit("a").alias("keyword"), F.lit("US").alias("market"), F.lit("").alias("loc"), F.lit("d").alias("device"),
        F.date_add(F.lit("2017-01-01").cast("date"), F.col("n")).alias("crawl_date"), F.lit(1).alias("rank"), F.lit("u").alias("url"),
    )
    calendar = spark.createDataFrame([(n,) for n in dates], "n int").select(
        F.date_add(F.lit("2017-01-01").cast("date"), F.col("n")).alias("crawl_date")
    )
    (counted,) = top_spot.departure_counts(df, calendar=calendar).collect()
    present = [n for n in dates if n % 7]
    following = dict(zip(dates, [*dates[1:], None], strict=True))
    assert counted.n == sum(following[n] not in present for n in present) == top_spot.departure_days(df, calendar=calendar).count()
