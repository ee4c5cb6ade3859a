"""Rank facts read out of other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdrift.schema import RankColumns

# Shipments as rank facts under their own names: the place of a supplier on the
# orders shipped with one line status, compared between return flags.
_SHIPMENT = {
    "subject": ("l_linestatus",),
    "group": "l_returnflag",
    "rank": "l_linenumber",
    "entity": "l_suppkey",
}
SHIPMENTS_BY_DAY = RankColumns(date="ship_date", **_SHIPMENT)
# The same places, each held by one supplier a day.
DAY_LEADERS = RankColumns(date="ship_date", **_SHIPMENT)
SHIPMENTS_BY_MONTH = RankColumns(date="ship_month", **_SHIPMENT)

WEEKLY = RankColumns(date="crawl_week")
# The week's results of a keyword: many sets, some of them equal.
RESULT_LISTS = RankColumns(subject=("market",), group="keyword", date="crawl_week", rank="rank", entity="site")
# Parts sold under a line status and number in a year, compared between return flags.
PARTS_BY_YEAR = RankColumns(
    subject=("l_linestatus",), group="l_returnflag", date="ship_year", rank="l_linenumber", entity="l_partkey"
)


def rank_facts_of(events: DataFrame) -> DataFrame:
    """The seven rank columns plus ``event_id`` and ``ts``, the order of arrival.

    Users of events stand in for keywords, the payload ``k`` for rank and URL.
    """
    payload = "cast(get_json_object(props, '$.k') as int) AS k"
    return events.selectExpr("event_id", "ts", "user_id", "event_type", payload).selectExpr(
        "concat('kw', user_id % 5) AS keyword",
        "if(event_type IN ('signup', 'click'), 'US-en', 'CA-en') AS market",
        "if(event_type IN ('signup', 'view'), NULL, event_type) AS loc",
        "if(event_id % 2 = 0, 'desktop', 'smartphone') AS device",
        "cast(ts AS date) AS crawl_date",
        "k % 20 + 1 AS rank",
        "concat('site', if(k >= 50, 1, 0), '.example/p') AS url",
        "event_id",
        "ts",
    )


def rank_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_facts_of(spark.read.parquet(f"{sf_dir}/events.parquet"))


def wide_rank_facts_of(events: DataFrame) -> DataFrame:
    """Rank facts whose keywords and URLs grow in number with the events, one keyword and site for each user.

    One user in ten has a third device. ``crawl_week`` is the first day of the week.
    """
    payload = "cast(get_json_object(props, '$.k') as int) AS k"
    return events.selectExpr("event_id", "ts", "user_id", "event_type", payload).selectExpr(
        "concat('kw', user_id) AS keyword",
        "if(event_type IN ('signup', 'click'), 'US-en', 'CA-en') AS market",
        "if(event_type IN ('signup', 'view'), NULL, event_type) AS loc",
        "CASE WHEN user_id % 10 = 0 THEN 'tablet' WHEN event_id % 2 = 0 THEN 'desktop' ELSE 'smartphone' END AS device",
        "cast(ts AS date) AS crawl_date",
        "cast(date_trunc('week', ts) AS date) AS crawl_week",
        "k % 20 + 1 AS rank",
        "concat('site', user_id, '.example/', k div 10) AS url",
        "event_id",
        "ts",
    )


def wide_rank_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_rank_facts_of(spark.read.parquet(f"{sf_dir}/events.parquet"))


def result_lists_of(events: DataFrame) -> DataFrame:
    """Results per keyword and week, a keyword for each user.

    Every fifth one is there under two more names: once the same, once without some of its results.
    """
    payload = "cast(get_json_object(props, '$.k') as int) AS k"
    return events.selectExpr("ts", "user_id", "event_type", payload).selectExpr(
        "explode(if(user_id % 5 = 0, array('', '+', '~'), array(''))) AS twin",
        "user_id",
        "k",
        "if(event_type IN ('signup', 'click'), 'US-en', 'CA-en') AS market",
        "cast(date_trunc('week', ts) AS date) AS crawl_week",
    ).where("twin <> '~' OR k % 7 <> 0").selectExpr(
        "concat('kw', user_id, twin) AS keyword", "market", "crawl_week", "k % 20 + 1 AS rank", "concat('site', k div 25) AS site"
    )


def result_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_lists_of(spark.read.parquet(f"{sf_dir}/events.parquet"))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "l_linestatus",
        "l_returnflag",
        "l_linenumber",
        "l_suppkey",
        "cast(l_shipdate AS date) AS ship_date",
        "cast(trunc(l_shipdate, 'month') AS date) AS ship_month",
    )


def day_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each place and day the supplier of the dearest shipment; place and day are a key."""
    price = F.struct("l_extendedprice", (-F.col("l_orderkey")).alias("_earlier"))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    place = ["l_linestatus", "l_returnflag", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_date")]
    return lines.groupBy(*place).agg(F.max_by("l_suppkey", price).alias("l_suppkey"))


def part_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sold parts; return flags A and R are one set of returns."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "l_linestatus",
        "if(l_returnflag = 'N', 'N', 'R') AS l_returnflag",
        "l_linenumber",
        "l_partkey",
        "cast(trunc(l_shipdate, 'year') AS date) AS ship_year",
    )
