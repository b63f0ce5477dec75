"""Every registered query against its SQL twin, and the shape of its plan."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as driver  # noqa: E402
from check import TABLES, rows_of  # noqa: E402
from tabwright.plans.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def base():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, base, name):
    found = QUERIES[name](spark, SF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "PythonRDD", "InPandas"):
        assert slow not in plan, slow
    got = rows_of(found.columns, found.collect())
    cursor = base.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    assert got == rows_of(columns, cursor.fetchall())


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert driver.entry(spark).columns == ["row_no", "raw"]
