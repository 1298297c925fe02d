"""Registered corpus queries: their SQL, and what the driver needs of them."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from tripmarts.llm import registry

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "embeddings", "pages", "benchmark", "conversations")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry_point.queries())
    assert "pipeline" in names
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert set(registry.oracle_sql()) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    found = registry.queries()[name](spark, SF_DIR)
    answer = duck.execute(registry.oracle_sql()[name])
    names = [column[0] for column in answer.description]
    assert sorted(names) == sorted(found.columns)
    rows = sorted(map(tuple, found.select(*names).collect()), key=repr)
    expected = sorted(answer.fetchall(), key=repr)
    assert len(rows) == len(expected) > 0
    for row, other in zip(rows, expected):
        for a, b in zip(row, other):
            assert math.isclose(a, b, rel_tol=1e-12) if isinstance(a, float) else a == b, (row, other)


@pytest.mark.parametrize("name", ["op8_mixing", "op9_quality_rules"])
def test_native_plans_have_no_python(spark, name):
    plan = registry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"):
        assert unwanted not in plan
