"""The registered queries agree with their SQL in DuckDB on the small tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    return None if value is None or value != value else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = entry_point.queries()[name](spark, SF)
    cursor = duck.execute(entry_point.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted(repr([plain(v) for v in r]) for r in cursor.fetchall())
    have = sorted(repr([plain(v) for v in r]) for r in got.select(*[f"`{n}`" for n in names]).collect())
    assert have == want


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_no_query_runs_python_per_row(spark):
    for name in ("table_as_of", "merge_current", "coerce_timestamp", "spill_overflow", "detect_drift"):
        plan = entry_point.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "MapInPandas" not in plan, name
