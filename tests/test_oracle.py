"""Every registered query against its DuckDB statement."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, duckdb_rows, spark_rows
from tests.plans import final_plan

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLE = entry._snapshot_queries(), entry.oracle.statements()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


# Joins of everything with everything, and Python stages.
NOT_IN_PLANS = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")

# How DuckDB names the types that results have.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns, rows = spark_rows(result)
    expected_columns, expected = duckdb_rows(duck, ORACLE[name])
    assert columns == expected_columns
    assert rows == expected
    plan = final_plan(result)
    assert not [step for step in NOT_IN_PLANS if step in plan]
    described = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
    assert described == {column: TYPES[type_] for column, type_ in result.dtypes}
    assert rows, "an empty result would compare nothing"


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 224
