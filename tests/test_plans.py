"""The physical plans that make the analyses scale."""

import re

import pytest
from pyspark.sql import functions as F

from fixtures import edge_facts
from rankdrift.operators import cleaning, exact, minhash, top_spot, urls
from rankdrift.sources import rank_table, signature_table


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "ranks")
    rank_table.write_rank_table(cleaning.clean_ranks(edge_facts(spark)), path)
    return rank_table.read_rank_table(spark, path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


def read_columns(df):
    (schema,) = re.findall(r"ReadSchema: struct<(.*?)>", plan(df))
    return {field.split(":")[0] for field in schema.split(",")}


def test_top_urls_reads_two_columns_and_shuffles_counts_only(table):
    df = urls.top_urls(table)
    assert read_columns(df) == {"rank", "url"}
    assert "PushedFilters: [IsNotNull(rank), GreaterThan(rank,10)]" in plan(df)
    assert shuffles(df) == 1
    assert "partial_count" in plan(df) and "TakeOrderedAndProject" in plan(df)


def test_departures_read_top_rows_and_never_sort(table):
    df = top_spot.departure_counts(table)
    assert "EqualTo(rank,1)" in plan(df)
    assert "partial_bit_or" in plan(df)
    assert "Sort" not in plan(df) and "Window" not in plan(df)


def test_exact_similarity_shuffles_elements_once(table):
    df = exact.exact_similarity(table, ("desktop", "smartphone"))
    assert shuffles(df) == 2  # elements, then one row per date and task
    assert plan(df).count("partial_min") == 1
    assert "SortAggregate" not in plan(df)


def test_sketch_and_signatures_do_not_shuffle_elements(table):
    for df in (exact.sketch_similarity(table), minhash.minhash_signatures(table)):
        keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan(df))
        assert keys and all(not re.search("keyword|url|_element", k) for k in keys)


def test_deduplication_combines_before_its_only_shuffle(table):
    df = cleaning.clean_ranks(table)
    assert shuffles(df) == 1
    assert plan(df).index("partial_min") > plan(df).index("Exchange hashpartitioning")


def test_date_filter_prunes_partitions(table):
    df = cleaning.date_range(table, "2017-07-02", "2017-07-03")
    pruned = re.search(r"PartitionFilters: \[(.*?)\], Pushed", plan(df)).group(1)
    assert "2017-07-02" in pruned and "2017-07-03" in pruned


def test_upsert_prunes_partitions(table):
    incoming = table.where("crawl_date > DATE '2017-07-02'").where("rank = 1")
    text = plan(rank_table.merged_ranks(table, incoming))
    pruned = re.findall(r"PartitionFilters: (.*?) PushedFilters", text)
    assert any("2017-07-03" in filters and "2017-07-04" in filters for filters in pruned)


def test_one_day_of_signatures_prunes_partitions(spark, table, tmp_path):
    path = str(tmp_path / "signatures")
    signature_table.write_signature_part(minhash.minhash_signatures(table), path, "one")
    df = signature_table.read_signatures(spark, path, start="2017-07-02", end="2017-07-02")
    assert "2017-07-02" in re.search(r"PartitionFilters: \[(.*?)\], Pushed", plan(df)).group(1)
    assert df.count() == 2


def test_signature_aggregation_is_generated_code(spark, table):
    df = minhash.minhash_signatures(table)
    df.collect()
    text = plan(df)
    assert re.search(r"\*\(\d+\) HashAggregate", text)


def test_table_files_are_sorted_by_rank_within_a_date(spark, tmp_path):
    path = str(tmp_path / "ranks")
    rank_table.write_rank_table(cleaning.clean_ranks(edge_facts(spark)), path)
    stored = spark.read.parquet(f"{path}/crawl_date=2017-07-01")
    ranks = [r[0] for r in stored.coalesce(1).select("rank").collect()]
    assert ranks == sorted(ranks)


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    """Small days stay one file, but for those that hash together with the large one."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        days = F.when(F.col("id") % 10 < 9, 1).otherwise((F.col("id") % 7 + 2).cast("int"))
        df = spark.range(0, 100000, 1, 8).select(
            F.concat(F.lit("k"), F.xxhash64("id")).alias("keyword"),
            F.lit("US").alias("market"),
            F.lit("").alias("loc"),
            F.lit("desktop").alias("device"),
            F.date_add(F.lit("2017-07-01").cast("date"), days).alias("crawl_date"),
            F.lit(1).alias("rank"),
            F.concat(F.lit("u"), F.xxhash64("id", F.lit(1))).alias("url"),
        )
        rank_table.write_rank_table(df, str(tmp_path / "ranks"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "ranks").glob("crawl*")}
    assert files.pop("crawl_date=2017-07-02") > 4
    assert len(files) == 7 and list(files.values()).count(1) >= 5
    assert rank_table.read_rank_table(spark, str(tmp_path / "ranks")).count() == 100000


def test_a_key_with_a_third_of_all_rows(spark):
    """Copies of one key meet before the shuffle, so no task receives them all."""
    n = spark.range(300000)
    hot = F.col("id") % 3 == 0
    df = n.select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("keyword"),
        F.lit("US").alias("market"),
        F.lit(None).cast("string").alias("loc"),
        F.when(hot | (F.col("id") % 2 == 0), "desktop").otherwise("smartphone").alias("device"),
        F.lit("2017-07-01").cast("date").alias("crawl_date"),
        F.when(hot, 1).otherwise((F.col("id") % 30 + 1).cast("int")).alias("rank"),
        F.concat(F.lit("u"), F.col("id") % 7).alias("url"),
        "id",
    )
    clean = cleaning.clean_ranks(df, ["id"])
    assert clean.where("keyword = 'hot'").select("url").collect()[0][0] == "u0"
    assert clean.count() == df.select("keyword", "device", "rank").distinct().count()
    counts = top_spot.departure_counts(df).where("keyword = 'hot'")
    assert counts.count() == 7 and counts.agg(F.sum("n")).collect()[0][0] == 7
    assert exact.exact_similarity(df).count() == 1
