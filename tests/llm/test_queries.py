import glob
import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from rankdrift.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_duckdb(spark, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS FROM '{path}'")
    want = duck.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF).select(columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(spark_entry.queries())
    assert set(ORACLES) <= set(spark_entry.oracle_sql())
