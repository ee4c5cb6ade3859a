"""Append-only batches: what counts, what is read, and what a lost job leaves."""

import re

import pytest
from pyspark.sql import functions as F

from fixtures import day, edge_facts, fact, facts, rows
from rankdrift.operators import cleaning
from rankdrift.sources import batch_table as batches
from rankdrift.sources import rank_table


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "ranks")
    batches.upsert_batch(edge_facts(spark), path)
    return path


def stored(spark, path):
    return sorted(rows(batches.read_batch_table(spark, path)))


def test_same_as_the_table_that_is_overwritten(spark, tmp_path):
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    steps = [
        edge_facts(spark),
        facts(spark, [fact(n=1, url="n"), fact(n=2, url="m"), fact(n=9, rank=4)]),
        edge_facts(spark).where("crawl_date = DATE '2017-07-02'"),
        edge_facts(spark).where("false"),
    ]
    for incoming in steps:
        rank_table.upsert_rank_table(incoming, first)
        batches.upsert_batch(incoming, second)
        assert stored(spark, second) == sorted(rows(rank_table.read_rank_table(spark, first)))
    assert batches.counted_batches(spark, second).count() == 3


def test_the_last_row_of_a_key_wins(spark, tmp_path):
    df = facts(spark, [fact(url="a"), fact(url="b"), fact(url="c")]).withColumn("n", F.ascii("url") % 3)
    path = str(tmp_path / "t")
    batches.upsert_batch(df, path, ["n"])
    assert [r[-1] for r in stored(spark, path)] == ["b"]  # 98 % 3 is the greatest


@pytest.mark.parametrize("dates", [[day(1)], [day(n) for n in range(1, 5)]])
def test_a_batch_that_never_counted(spark, table, dates):
    """A job that was lost after it had written rows: all dates are read as they were, also by the next upsert."""
    before = stored(spark, table)
    lost = batches.next_batch(spark, table)
    broken = edge_facts(spark).where(F.col("crawl_date").isin(dates)).limit(1).withColumn("url", F.lit("broken"))
    batches.write_rows(cleaning.clean_ranks(broken), table, lost)
    assert stored(spark, table) == before
    assert batches.upsert_batch(facts(spark, [fact(n=4, url="new")]), table) > lost.split("-")[0]
    after = stored(spark, table)
    assert [r for r in after if r not in before] == [("a", "US", "", "desktop", day(4), 1, "new")]
    assert len(after) == len(before)


def test_batch_names_grow(spark, table):
    for n in range(3):
        batches.upsert_batch(facts(spark, [fact(url=f"u{n}")]), table)
    names = [r[0] for r in rows(batches.counted_batches(spark, table).orderBy("batch"))]
    assert [int(name.split("-")[0]) for name in names] == [1, 2, 3, 4]
    assert ("a", "US", "", "desktop", day(1), 1, "u2") in stored(spark, table)


def test_source_that_changes(spark, table):
    shaky = edge_facts(spark).where(F.rand() < 0.5).withColumn("url", F.concat("url", F.lit("!")))
    for _ in range(3):
        batches.upsert_batch(shaky, table)
        now = batches.read_batch_table(spark, table)
        assert now.count() == 11 and now.where("crawl_date = DATE '2017-07-01'").count() > 3


def test_dates_are_pruned_when_planned_and_batches_when_run(spark, table):
    df = batches.read_batch_table(spark, table, "2017-07-02", "2017-07-03")
    text = df._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: (.*?)PushedFilters", text)
    assert any("2017-07-02" in f and "2017-07-03" in f for f in filters)
    assert len(re.findall(r"SubqueryAdaptiveBroadcast dynamicpruning", text)) == 2  # on the date and on the batch
    assert sorted({r.crawl_date for r in df.collect()}) == [day(2), day(3)]


def test_superseded_folders_go_and_nothing_else(spark, table, tmp_path):
    batches.upsert_batch(facts(spark, [fact(n=1, url="n"), fact(n=2, url="n")]), table)
    before = stored(spark, table)
    assert len(list((tmp_path / "ranks/rows").glob("*/batch=*"))) == 6
    assert batches.remove_superseded(spark, table) == 2
    assert batches.remove_superseded(spark, table) == 0
    assert len(list((tmp_path / "ranks/rows").glob("*/batch=*"))) == 4
    assert stored(spark, table) == before


def test_a_table_that_is_not_there(spark, tmp_path):
    assert stored(spark, str(tmp_path / "none")) == []
    assert batches.upsert_batch(facts(spark, []), str(tmp_path / "none")) is None
