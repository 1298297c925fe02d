from __future__ import annotations

import pytest
from conftest import GREEN, YELLOW, as_dicts, as_set, raw_frame, trip

from tripmarts.contracts import KINDS
from tripmarts.operators import marts
from tripmarts.operators.bronze import to_bronze
from tripmarts.operators.silver import to_silver


def silver(spark, zones, rows, kind="yellow"):
    return to_silver(to_bronze(raw_frame(spark, kind, rows), kind), zones, kind)


def test_golden_days(spark, zones):
    days = marts.trips_by_date(silver(spark, zones, YELLOW)).orderBy("pickup_date")
    found = [(str(r["pickup_date"]), r["trip_count"], r["total_revenue"]) for r in days.collect()]
    assert found == [
        ("2022-03-01", 2, pytest.approx(52.1)),
        ("2022-03-02", 1, pytest.approx(8.8)),
    ]


def test_golden_fares(spark, zones):
    def by_label(rows, kind):
        found = as_dicts(marts.fare_summary(silver(spark, zones, rows, kind)))
        return {
            r["payment_label"]: (r["trip_count"], r["avg_tip_pct"], r["median_fare"], r["p95_fare"])
            for r in found
        }

    yellow = by_label(YELLOW, "yellow")
    assert yellow["Credit card"] == (2, pytest.approx(19.642857), 14.0, 28.0)
    assert yellow["Cash"] == (1, 0.0, 7.5, 7.5)
    green = by_label(GREEN, "green")
    assert green == {"Credit card": (2, pytest.approx(16.666667), 15.0, 30.0)}


def test_codes_without_label_form_one_group(spark, zones):
    rows = [trip(payment_type=7), trip(payment_type=None), trip(fare_amount=0.0)]
    found = {r["payment_label"]: r for r in as_dicts(marts.fare_summary(silver(spark, zones, rows)))}
    assert found[None]["trip_count"] == 2
    assert found["Credit card"]["avg_tip_pct"] is None, "no fare, no tip share"


def test_golden_hours_boroughs_and_durations(spark, zones):
    trips = silver(spark, zones, YELLOW)
    hours = {r["pickup_hour"]: r["avg_fare"] for r in as_dicts(marts.trips_by_hour(trips))}
    assert hours == {3: 14.0, 4: 28.0, 17: 7.5}
    boroughs = {r["pickup_borough"]: r["trip_count"] for r in as_dicts(marts.trips_by_borough(trips))}
    assert boroughs == {"Manhattan": 2, "Queens": 1}
    only = as_dicts(marts.trip_duration_summary(trips))
    assert only == [
        {
            "pickup_year": 2022,
            "pickup_month": 3,
            "trip_count": 3,
            "avg_duration_mins": pytest.approx(65 / 3),
            "p25_duration": 10.0,
            "p50_duration": 20.0,
            "p75_duration": 35.0,
            "p95_duration": 35.0,
        }
    ]


EXPECTED = {
    "yellow": 5,
    "green": 5,
    "fhv": 4,
    "fhvhv": 4,
}


@pytest.mark.parametrize("kind", KINDS)
def test_each_kind_gets_the_marts_and_measures_it_has(spark, zones, kind):
    trips = silver(spark, zones, YELLOW[:3], kind)
    built = marts.build_marts(trips, kind)
    assert len(built) == EXPECTED[kind]
    assert ("fare_summary" in built) == (kind in ("yellow", "green"))
    for rows in built.values():
        assert rows.count() > 0
        assert ("avg_fare" in rows.columns) <= (kind != "fhv")
        assert ("total_revenue" in rows.columns) <= (kind in ("yellow", "green"))


@pytest.mark.parametrize("kind", KINDS)
def test_marts_from_slots_equal_marts_from_trips(spark, zones, kind):
    trips = silver(spark, zones, YELLOW + GREEN, kind)
    direct = marts.build_marts(trips, kind)
    shared = marts.build_marts(trips, kind, marts.slot_grain(trips))
    for name, rows in direct.items():
        assert rows.columns == shared[name].columns
        assert as_set(rows) == as_set(shared[name]), name


def test_no_trips_no_mart_rows(spark, zones):
    trips = silver(spark, zones, YELLOW).limit(0)
    for rows in marts.build_marts(trips, "yellow").values():
        assert rows.count() == 0
