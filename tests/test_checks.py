"""Registered queries against their SQL in DuckDB, and properties of their plans."""

from __future__ import annotations

import math
import os
import re
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from checks import catalog, lake_queries, oracle, trips
from tripmarts.operators import quantiles
from tripmarts.plans import fare
from tripmarts.sources import zones
from tripmarts.sources.kept import kept as held
from tripmarts.sources.raw import month_path

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
QUERIES = catalog.queries()
ORACLE = oracle.queries()
# Queries with quantiles read counts that are kept, and those of the lake read what the stages stored.
RANKED = re.compile("fare_summary|duration_summary|distance_distribution|anomaly")
STORED = re.compile("lake_|stored_")
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def in_order(rows, names):
    position = [names.index(name) for name in sorted(names)]
    return sorted((tuple(row[i] for i in position) for row in rows), key=repr)


def same(row, other, rel=1e-12):
    def pair(a, b):
        if isinstance(a, float) and isinstance(b, float):
            return math.isclose(a, b, rel_tol=rel)
        return a == b

    return len(row) == len(other) and all(map(pair, row, other))


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    answer = duck.execute(ORACLE[name])
    types = {column[0]: str(column[1]) for column in answer.description}
    assert {column: TYPES[kind] for column, kind in found.dtypes} == types
    rows = in_order(found.collect(), found.columns)
    expected = in_order(answer.fetchall(), list(types))
    assert len(rows) == len(expected)
    for row, other in zip(rows, expected):
        assert same(row, other), (row, other)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_stay_in_the_engine(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "RoundRobin"):
        assert unwanted not in plan
    assert "l_shipdate" not in plan and "o_totalprice" not in plan
    kept = RANKED.search(name) or STORED.match(name)
    assert plan.count("FileScan parquet [l_orderkey") == (0 if kept else 1)


@pytest.mark.parametrize(
    "name", ["gold_fare_summary", "fhv_trip_duration_summary", "fhvhv_distance_distribution_by_borough", "fare_anomaly_detection"]
)
def test_quantiles_scan_the_trips_once(spark, monkeypatch, name):
    """Counts, measures, quantiles and flags come from one scan and one range shuffle."""
    plans = []

    def watched(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
        return held(rows)

    for module in (quantiles, fare):
        monkeypatch.setattr(module, "kept", watched)
    rest = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert len(plans) == 1
    assert plans[0].count("FileScan parquet [l_orderkey") == 1 and plans[0].count("rangepartitioning") == 1
    assert "FileScan parquet [l_orderkey" not in rest and "rangepartitioning" not in rest


def test_payment_trend_counts_once(spark):
    plan = QUERIES["payment_type_trend"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(pickup_year") <= 1 and "Window" not in plan


def test_flagship(spark):
    rows = entry_point.entry(spark)
    assert rows.columns == ["pickup_hour", "avg_trips", "avg_fare", "pct_of_daily_total"]
    assert rows.count() == 24


def test_counts_of_the_mapping(spark):
    raw = trips.bronze(spark, SF_DIR)
    assert raw.filter("pu_location_id IS NULL").count() == 235
    silver = trips.silver(spark, SF_DIR)
    assert silver.count() == 3539
    assert silver.filter("is_airport_trip").count() == 819
    assert silver.filter("pickup_zone IS NULL").count() == 265


def test_a_hot_order_gives_the_same_answer(spark, tmp_path, monkeypatch):
    """A third of all line items on one order, joined by shuffle: same rows as by broadcast."""
    for name in ("orders", "nation", "region"):
        trips.table(spark, SF_DIR, name).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = trips.table(spark, SF_DIR, "lineitem")
    hot = F.when(F.col("l_partkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_orderkey"))
    lines.withColumn("l_orderkey", hot).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("gold_fare_summary", "zone_net_flow", "fare_anomaly_detection"):
        query = QUERIES[name]
        plain = in_order(query(spark, str(tmp_path)).collect(), query(spark, str(tmp_path)).columns)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        monkeypatch.setattr(zones, "BROADCAST_ROWS", 0)
        try:
            frame = query(spark, str(tmp_path))
            assert "BroadcastHashJoin" not in frame._jdf.queryExecution().executedPlan().toString()
            shuffled = in_order(frame.collect(), frame.columns)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            monkeypatch.undo()
        assert len(plain) == len(shuffled)
        for row, other in zip(plain, shuffled):
            assert same(row, other, rel=1e-9), (row, other)


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    monkeypatch.setattr(lake_queries, "shared_folder", lambda spark: None)
    assert lake_queries.folder_for(spark)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://far:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        lake_queries.folder_for(spark)


@pytest.mark.parametrize("missing", ["xxhash", "tiktoken", "regex"])
def test_trip_queries_stand_without_the_libraries_of_the_corpus_part(missing):
    """In a process of its own, where the library cannot be imported."""
    words = (
        f"import sys; sys.modules[{missing!r}] = None\n"
        "import __spark_entry__ as entry\n"
        "from checks import catalog\n"
        "found = set(entry.queries())\n"
        "assert set(catalog.queries()) <= found and set(entry.oracle_sql()) <= found\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", words], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


@pytest.mark.parametrize("name", ["lake_raw_scan", "lake_bronze"])
def test_files_are_named_once_and_not_per_row(spark, name):
    """The rows of a file are added up first; the name is cut out of what is left."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    rows = plan.split("Exchange")[-1]
    assert "FileScan" in rows and "keys=[_source_file#" in rows and "_groupingexpression" not in rows


def test_a_large_month_is_written_by_several_tasks(spark, tmp_path):
    """All trips in one month and a few in another: none is lost, and the large month is no task of its own."""
    keys = spark.range(0, 8000, 1, 4)
    keys.selectExpr(
        "id AS o_orderkey", "id % 50 AS o_custkey", "'O' AS o_orderstatus", "1D AS o_totalprice",
        "IF(id < 40, TIMESTAMP_NTZ'1996-05-05', TIMESTAMP_NTZ'1996-03-03') AS o_orderdate", "'1' AS o_orderpriority",
    ).write.parquet(str(tmp_path / "orders.parquet"))
    keys.selectExpr(
        "id AS l_orderkey", "id * 31 AS l_partkey", "id % 13 AS l_suppkey", "1 AS l_linenumber", "2D AS l_quantity",
        "CAST(id AS DOUBLE) AS l_extendedprice", "0.1D AS l_discount", "0D AS l_tax", "'N' AS l_returnflag",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    advised = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(advised, "8k")
    try:
        months = trips.store_months(spark, str(tmp_path), str(tmp_path / "raw"))
    finally:
        spark.conf.unset(advised)
    assert [*months] == [(1996, 3), (1996, 4), (1996, 5)]
    large, small = (spark.read.parquet(month_path(str(tmp_path / "raw"), "yellow", 1996, m)) for m in (3, 5))
    assert (large.count(), small.count()) == (7960, 40)
    assert len(large.inputFiles()) > 1
