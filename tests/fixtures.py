"""Hand-made rank facts shared by the tests."""

from __future__ import annotations

from datetime import date

from rankdrift.schema import RANK_SCHEMA

# device, day of July 2017, rank, url; all for keyword "a", market "US", no location.
EDGE = [
    ("desktop", 1, 1, "u1"),
    ("desktop", 2, 1, "u1"),
    ("desktop", 3, 1, "u2"),
    ("desktop", 4, 1, "u1"),
    ("smartphone", 1, 1, "u1"),
    ("smartphone", 2, 1, "u2"),
    ("desktop", 1, 11, "u3"),
    ("smartphone", 1, 12, "u3"),
    ("desktop", 1, 10, "u4"),
    ("smartphone", 1, 2, "u5"),
    ("desktop", 1, 2, "u5"),
]


def day(n: int) -> date:
    return date(2017, 7, n)


def fact(device="desktop", n=1, rank=1, url="u", keyword="a", market="US", loc=None):
    return (keyword, market, loc, device, day(n), rank, url)


def facts(spark, rows):
    return spark.createDataFrame(rows, RANK_SCHEMA)


def edge_facts(spark, extra=()):
    return facts(spark, [fact(*row) for row in [*EDGE, *extra]])


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
