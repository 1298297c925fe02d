"""Raw trips of every kind, derived by Spark from the given tables.

A trip is a line item joined to its order. The formulas are the ones in FIXTURES.md; here
they are delivered under each kind's raw column names and raw types, so that a query runs the
same path as real files: contract, Bronze, Silver, marts, summaries.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmarts.operators.bronze import to_bronze
from tripmarts.operators.silver import to_silver
from tripmarts.session import files_side_by_side, pin_session_zone
from tripmarts.settings import MonthRange, Refinement
from tripmarts.sources.raw import month_path
from tripmarts.sources.zones import Zones, checked_zones

AIRPORTS = (1, 13, 18)
REFINEMENT = Refinement(airport_ids=AIRPORTS)

_SHARED = """
    unix_seconds(CAST(o_orderdate AS TIMESTAMP)) AS midnight,
    l_orderkey * 7919 % 86400 AS pickup_second,
    CAST((l_quantity - 1) * 900 AS BIGINT) AS seconds,
    CAST(l_suppkey % 7 AS DOUBLE) AS passengers,
    CAST(l_partkey * 13 % 2500 AS DOUBLE) / 10 AS miles,
    CAST(l_partkey * 13 % 2500 * 100 + l_suppkey % 100 AS DOUBLE) / 1000 AS fine_miles,
    CAST(nullif(o_custkey % 28, 27) AS INT) AS origin,
    CAST(l_suppkey % 27 AS INT) AS destination,
    l_linenumber AS payment,
    CAST(floor(l_extendedprice * l_quantity / 10000) AS DOUBLE) - 2 AS fare,
    l_discount AS discount,
    l_tax AS tax,
    l_returnflag AS flag
"""

_START = "timestamp_seconds(midnight + pickup_second)"
_END = "timestamp_seconds(midnight + pickup_second + seconds)"

_METERED = {
    "VendorID": "payment % 2 + 1",
    "passenger_count": "passengers",
    "trip_distance": "miles",
    "RatecodeID": "CAST(payment AS DOUBLE)",
    "store_and_fwd_flag": "flag",
    "PULocationID": "origin",
    "DOLocationID": "destination",
    "fare_amount": "fare",
    "mta_tax": "tax",
    "tip_amount": "fare * discount * 3",
    "total_amount": "fare * (1 + discount * 3) + 2.5D",
}

RAW_COLUMNS = {
    "yellow": {
        "tpep_pickup_datetime": _START,
        "tpep_dropoff_datetime": _END,
        **_METERED,
        "payment_type": "CAST(payment AS BIGINT)",
    },
    "green": {
        "lpep_pickup_datetime": _START,
        "lpep_dropoff_datetime": _END,
        **_METERED,
        "payment_type": "CAST(payment AS DOUBLE)",
        "trip_type": "CAST(payment % 2 + 1 AS DOUBLE)",
    },
    "fhv": {
        "dispatching_base_num": "flag",
        "pickup_datetime": _START,
        "dropOff_datetime": _END,
        "PUlocationID": "CAST(origin AS DOUBLE)",
        "DOlocationID": "CAST(destination AS DOUBLE)",
        "SR_Flag": "payment",
    },
    "fhvhv": {
        "hvfhs_license_num": "flag",
        "pickup_datetime": _START,
        "dropoff_datetime": _END,
        "PULocationID": "origin",
        "DOLocationID": "destination",
        "trip_miles": "fine_miles",
        "trip_time": "seconds",
        "base_passenger_fare": "fare",
        "tips": "fare * discount * 3",
    },
}


# The columns of the given tables. Stating them saves a footer read per query.
TABLES = {
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
        o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string""",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str, kind: str = "yellow") -> DataFrame:
    pin_session_zone(spark)
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    columns = [line.strip().rstrip(",") for line in _SHARED.strip().splitlines()]
    shared = joined.selectExpr(*columns)
    return shared.selectExpr(*(f"{sql} AS {name}" for name, sql in RAW_COLUMNS[kind].items()))


def store_months(spark: SparkSession, sf_dir: str, raw: str, kind: str = "yellow") -> MonthRange:
    """A raw file for each month of the trips, below `raw`; the range of months."""
    rows = raw_trips(spark, sf_dir, kind)
    start = next(name for name in rows.columns if name.endswith("pickup_datetime"))
    by_month = rows.withColumn("month", F.date_format(start, "yyyyMM"))
    # Large months are split, small ones share a task.
    with files_side_by_side(spark):
        by_month.hint("rebalance", "month").write.partitionBy("month").parquet(f"{raw}/by_month")
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(raw).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(f"{raw}/{kind}"))
    found = [str(place.getPath()) for place in files.listStatus(path(f"{raw}/by_month"))]
    pattern = re.compile(r".*month=(\d{4})(\d\d)$")
    months = sorted((int(m[1]), int(m[2]), m[0]) for m in map(pattern.match, found) if m)
    for year, month, place in months:
        files.rename(path(place), path(month_path(raw, kind, year, month)))
    return MonthRange(*months[0][:2], *months[-1][:2])


def zone_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).selectExpr(
        "n_nationkey AS location_id", "r_name AS borough", "n_name AS zone_name"
    )


def bronze(spark: SparkSession, sf_dir: str, kind: str = "yellow") -> DataFrame:
    return to_bronze(raw_trips(spark, sf_dir, kind), kind)


def zones(spark: SparkSession, sf_dir: str) -> Zones:
    """The zones, counted and with their key checked, as for a lookup file."""
    return checked_zones(zone_rows(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str, kind: str = "yellow") -> DataFrame:
    return to_silver(bronze(spark, sf_dir, kind), zones(spark, sf_dir), kind, REFINEMENT)
