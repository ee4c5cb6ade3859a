"""Every registered query against DuckDB on the same tables."""

import glob
import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as spark_entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TINY = SF_DIR.endswith("sf0.001")
# The training-data operators have tests of their own.
QUERIES = {n: q for n, q in spark_entry.queries().items() if n != "pipeline" and not re.match(r"op\d+_", n)}
ORACLES = {n: sql for n, sql in spark_entry.oracle_sql().items() if n in QUERIES}
SLOW_NODES = ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    return round(value, 9) if isinstance(value, float) and not math.isnan(value) else value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(picked, key=lambda row: [(v is not None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_duckdb(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    oracle = duck.execute(ORACLES[name])
    columns = [d[0] for d in oracle.description]
    assert sorted(result.columns) == sorted(columns)
    expected = sorted_rows(columns, oracle.fetchall())
    actual = sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in SLOW_NODES)
    assert expected or TINY
    assert actual == expected


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 30
