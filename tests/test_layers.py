"""Bronze and Silver steps."""

from __future__ import annotations

import math

import pytest
from conftest import GREEN, YELLOW, as_dicts, as_set, moment, raw_frame, trip
from pyspark.sql import functions as F

from tripmarts.contracts import KINDS
from tripmarts.operators.bronze import to_bronze
from tripmarts.operators.silver import (
    add_local_time,
    add_trip_facts,
    add_zones,
    drop_incomplete,
    drop_outliers,
    to_silver,
)
from tripmarts.settings import AIRPORT_IDS, LOCAL_ZONE
from tripmarts.sources.zones import Zones, checked_zones


def bronze(spark, rows, kind="yellow"):
    return to_bronze(raw_frame(spark, kind, rows), kind)


@pytest.mark.parametrize("kind", KINDS)
def test_bronze_names_audit_and_partitions(spark, kind):
    rows = bronze(spark, YELLOW, kind)
    assert rows.count() == len(YELLOW)
    names = set(rows.columns)
    assert {"pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id"} <= names
    assert {"_ingested_at", "_trip_type", "year", "month"} <= names
    assert not names & {"VendorID", "PULocationID", "PUlocationID", "trip_miles", "tips"}
    found = {(r["_trip_type"], r["year"], r["month"]) for r in rows.collect()}
    assert found == {(kind, 2022, 3)}


def test_bronze_keeps_the_source_file(spark):
    raw = raw_frame(spark, "green", GREEN).withColumn("_source_file", F.lit("somewhere"))
    assert {r["_source_file"] for r in to_bronze(raw, "green").collect()} == {"somewhere"}


def test_measures_of_high_volume_trips_get_common_names(spark):
    row = bronze(spark, YELLOW[:1], "fhvhv").first()
    assert (row["trip_distance"], row["fare_amount"], row["tip_amount"]) == (3.5, 14.0, 3.0)


REQUIRED = ["pu_location_id", "do_location_id", "fare_amount", "trip_distance"]


@pytest.mark.parametrize("column", REQUIRED)
def test_metered_trips_need_places_fare_and_distance(spark, column):
    rows = bronze(spark, [trip(), trip(**{column: None})])
    assert drop_incomplete(rows, "yellow").count() == 1


@pytest.mark.parametrize("kind", KINDS)
def test_every_trip_needs_both_times(spark, kind):
    rows = bronze(spark, [trip(), trip(start=None), trip(minutes=None)], kind)
    assert drop_incomplete(rows, kind).count() == 1


def test_nan_counts_as_missing(spark):
    rows = bronze(spark, [trip(), trip(trip_distance=math.nan), trip(fare_amount=math.nan)])
    assert drop_incomplete(rows, "yellow").count() == 1


def test_unmetered_trips_may_lack_places(spark):
    rows = bronze(spark, [trip(pu_location_id=None, do_location_id=None)], "fhv")
    assert drop_incomplete(rows, "fhv").count() == 1


KEPT = [
    {"fare_amount": 0.0},
    {"fare_amount": 500.0},
    {"trip_distance": 0.01},
    {"trip_distance": 200.0},
    {"minutes": 1},
    {"minutes": 720},
]
DROPPED = [
    {"fare_amount": -0.01},
    {"fare_amount": 500.01},
    {"trip_distance": 0.0},
    {"trip_distance": 200.01},
    {"minutes": 59 / 60},
    {"minutes": 720 + 1 / 60},
    {"minutes": -5},
    {"passenger_count": 0.0},
    {"passenger_count": None},
    {"fare_amount": math.nan},
]


@pytest.mark.parametrize("change", KEPT, ids=str)
def test_limits_are_inclusive(spark, change):
    assert drop_outliers(bronze(spark, [trip(**change)]), "yellow").count() == 1


@pytest.mark.parametrize("change", DROPPED, ids=str)
def test_beyond_the_limits(spark, change):
    assert drop_outliers(bronze(spark, [trip(**change)]), "yellow").count() == 0


def test_unmetered_trips_have_no_limits(spark):
    rows = bronze(spark, [trip(minutes=-5), trip(minutes=5000)], "fhv")
    assert drop_outliers(rows, "fhv").count() == 2


def test_high_volume_trips_have_no_passenger_rule(spark):
    rows = bronze(spark, [trip(), trip(fare_amount=501.0), trip(minutes=0)], "fhvhv")
    assert drop_outliers(rows, "fhvhv").count() == 1


def local_parts(spark, start):
    row = add_local_time(bronze(spark, [trip(start)]), LOCAL_ZONE).first()
    return (
        row["pickup_datetime_local"],
        row["pickup_year"],
        row["pickup_month"],
        row["pickup_hour"],
        row["pickup_day_of_week"],
        row["is_weekend"],
    )


@pytest.mark.parametrize(
    "utc, local, day, weekend",
    [
        ("2022-03-01 08:00", "2022-03-01 03:00", 3, False),
        ("2022-03-02 22:00", "2022-03-02 17:00", 4, False),
        ("2022-04-02 18:00", "2022-04-02 14:00", 7, True),
        # Clocks go forward at 07:00 UTC and back at 06:00 UTC.
        ("2022-03-13 06:59", "2022-03-13 01:59", 1, True),
        ("2022-03-13 07:00", "2022-03-13 03:00", 1, True),
        ("2022-11-06 05:30", "2022-11-06 01:30", 1, True),
        ("2022-11-06 06:30", "2022-11-06 01:30", 1, True),
        # The local month and year may be earlier ones.
        ("2022-04-01 03:59", "2022-03-31 23:59", 5, False),
        ("2022-01-01 02:00", "2021-12-31 21:00", 6, False),
    ],
)
def test_local_time(spark, utc, local, day, weekend):
    at = moment(local)
    assert local_parts(spark, utc) == (at, at.year, at.month, at.hour, day, weekend)


def test_raw_month_and_local_month_are_kept_apart(spark):
    row = add_local_time(bronze(spark, [trip("2022-04-01 02:00")]), LOCAL_ZONE).first()
    assert (row["year"], row["month"]) == (2022, 4)
    assert (row["pickup_year"], row["pickup_month"]) == (2022, 3)


def test_unknown_places_have_no_zone(spark, zones):
    rows = bronze(spark, [trip(), trip(pu_location_id=999), trip(do_location_id=None)])
    found = {
        (r["pu_location_id"], r["do_location_id"]): (r["pickup_zone"], r["dropoff_borough"])
        for r in add_zones(rows, zones).collect()
    }
    assert found == {
        (161, 236): ("Midtown Center", "Manhattan"),
        (999, 236): (None, "Manhattan"),
        (161, None): ("Midtown Center", None),
    }


def test_zone_joins_are_broadcast_when_counted_and_correct_when_not(spark, zones):
    rows = bronze(spark, YELLOW)
    plan = add_zones(rows, zones)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        uncounted = add_zones(rows, Zones(zones.rows))
        assert "BroadcastHashJoin" not in uncounted._jdf.queryExecution().executedPlan().toString()
        named = {(r["pu_location_id"], r["pickup_zone"]) for r in uncounted.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert named == {(161, "Midtown Center"), (132, "JFK Airport"),
                     (236, "Upper East Side North"), (100, None)}


def test_a_large_lookup_is_joined_evenly(spark):
    """More zones than are broadcast, half of the trips without a location, a third at one."""
    many = spark.range(20_001).selectExpr("CAST(id AS INT) AS location_id", "concat('b', id % 7) AS borough",
                                          "concat('z', id) AS zone_name", "'' AS service_zone")
    assert not checked_zones(many).few
    rows = spark.range(30_000).selectExpr(
        "timestamp_seconds(id * 61) AS pickup_datetime", "timestamp_seconds(id * 61 + 600) AS dropoff_datetime",
        "CAST(CASE WHEN id % 2 = 0 THEN NULL WHEN id % 3 = 0 THEN 17 ELSE id % 30000 END AS INT) AS pu_location_id",
        "CAST(CASE WHEN id % 2 = 1 THEN NULL ELSE 5 END AS INT) AS do_location_id", "id",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = add_zones(rows, checked_zones(many))
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        found = as_set(joined.select("id", "pickup_zone", "pickup_borough", "dropoff_zone"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 4 and sizes[-1] < 2 * sizes[len(sizes) // 2]
    assert found == as_set(add_zones(rows, Zones(many, few=True)).select("id", "pickup_zone", "pickup_borough", "dropoff_zone"))


def test_airport_flag_and_minutes(spark):
    rows = bronze(spark, [
        trip(minutes=10.5),
        trip(pu_location_id=132, minutes=1),
        trip(do_location_id=1, minutes=2),
    ])
    facts = [(r["trip_duration_mins"], r["is_airport_trip"]) for r in
             add_trip_facts(rows, AIRPORT_IDS).collect()]
    assert facts == [(10.5, False), (1.0, True), (2.0, True)]


def test_without_places_nothing_is_an_airport_trip(spark):
    rows = bronze(spark, [trip()]).drop("pu_location_id", "do_location_id")
    assert add_trip_facts(rows, AIRPORT_IDS).first()["is_airport_trip"] is False


def test_golden_silver(spark, zones):
    shown = ["pickup_hour", "pickup_day_of_week", "is_weekend", "trip_duration_mins",
             "is_airport_trip"]
    yellow = to_silver(bronze(spark, YELLOW), zones, "yellow").orderBy("pickup_datetime")
    assert [tuple(r) for r in yellow.select(*shown).collect()] == [
        (3, 3, False, 20.0, False),
        (4, 3, False, 35.0, True),
        (17, 4, False, 10.0, False),
    ]
    green = to_silver(bronze(spark, GREEN, "green"), zones, "green").orderBy("pickup_datetime")
    assert [tuple(r) for r in green.select(*shown).collect()] == [
        (3, 6, False, 25.0, False),
        (14, 7, True, 40.0, False),
    ]


@pytest.mark.parametrize("kind", KINDS)
def test_silver_accepts_an_empty_month(spark, zones, kind):
    rows = to_silver(bronze(spark, YELLOW, kind).limit(0), zones, kind)
    assert rows.count() == 0 and "trip_duration_mins" in rows.columns


def test_cleaning_reaches_the_scan(spark, zones, tmp_path):
    bronze(spark, YELLOW).write.parquet(str(tmp_path / "b"))
    rows = to_silver(spark.read.parquet(str(tmp_path / "b")), zones, "yellow")
    plan = rows.select("pickup_hour", "fare_amount")._jdf.queryExecution().toString()
    for pushed in (
        "IsNotNull(pu_location_id)",
        "GreaterThanOrEqual(fare_amount,0.0)",
        "LessThanOrEqual(trip_distance,200.0)",
        "GreaterThan(passenger_count,0.0)",
    ):
        assert pushed in plan
    assert "Python" not in plan
    assert as_dicts(rows.select("fare_amount"))
