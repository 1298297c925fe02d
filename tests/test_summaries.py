from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from conftest import as_dicts, as_set, raw_frame, trip
from pyspark.sql import functions as F

from tripmarts.functions import labels
from tripmarts.operators import marts
from tripmarts.operators.bronze import to_bronze
from tripmarts.operators.silver import to_silver
from tripmarts.plans import demand, fare, geo, time_series, trip_patterns
from tripmarts.plans.grains import edge_grain, profile_grain
from tripmarts.plans.ranking import top
from tripmarts.plans.registry import DOMAINS, EDGES, PROFILE, SUMMARIES


@pytest.fixture(scope="module")
def silver(spark):
    """Some hundred trips with unknown places, odd codes and every bucket."""
    from conftest import ZONE_ROWS
    from tripmarts.sources.zones import Zones

    pick = random.Random(11)
    places = [row[0] for row in ZONE_ROWS] + [900, 901]
    rows = []
    for _ in range(400):
        charged = pick.choice([0.0, 5.0, 12.5, 40.0, 480.0])
        day = date(2019, 11, 1) + timedelta(days=pick.randrange(500))
        rows.append(trip(
            f"{day} {pick.randrange(24):02d}:15",
            pick.choice([2, 17, 45]),
            trip_distance=pick.choice([0.5, 2.0, 5.0, 10.0, 20.0]),
            pu_location_id=pick.choice(places),
            do_location_id=pick.choice(places),
            payment_type=pick.choice([1, 1, 2, 7]),
            fare_amount=charged,
            tip_amount=charged * pick.choice([-0.1, 0, 0.05, 0.12, 0.17, 0.22, 0.3]),
            total_amount=charged + 2.5,
        ))
    columns = "location_id int, borough string, zone_name string, service_zone string"
    dimension = Zones(spark.createDataFrame(ZONE_ROWS, columns), few=True)
    found = to_silver(to_bronze(raw_frame(spark, "yellow", rows), "yellow"), dimension, "yellow")
    found = found.cache()
    yield found
    found.unpersist()


def test_the_registry_is_complete():
    assert len(SUMMARIES) == 22
    counts = {domain: sum(s.domain == domain for s in SUMMARIES.values()) for domain in DOMAINS}
    assert counts == {"demand": 4, "fare": 5, "trip_patterns": 5, "geo": 4, "time_series": 4}
    assert SUMMARIES["top_corridors"].output_name() == "top_25_corridors"
    assert SUMMARIES["top_corridors"].output_name(top_n=3) == "top_3_corridors"


GRAINED = [s for s in SUMMARIES.values() if s.source in (EDGES, PROFILE)]


@pytest.mark.parametrize("summary", GRAINED, ids=lambda s: s.name)
def test_grains_answer_like_trips(silver, summary):
    build = edge_grain if summary.source == EDGES else profile_grain
    direct = summary.build(silver, **summary.params)
    shared = summary.build(build(silver), **summary.params)
    assert direct.columns == shared.columns
    assert as_set(direct, 6) == as_set(shared, 6)


# -- labels ----------------------------------------------------------------------------------


def label_of(spark, column, value):
    typed = F.lit(value).cast("double")
    return spark.range(1).select(column(typed).alias("label")).first()["label"]


@pytest.mark.parametrize("miles, label", [
    (0.5, "0-2 mi"), (2, "2-5 mi"), (4.99, "2-5 mi"), (5, "5-10 mi"), (10, "10-20 mi"),
    (20, "20+ mi"), (None, "20+ mi"),
])
def test_distance_buckets(spark, miles, label):
    assert label_of(spark, labels.distance_bucket, miles) == label


@pytest.mark.parametrize("percent, label", [
    (None, "no_tip"), (0, "0%"), (-4, "1-10%"), (9.99, "1-10%"), (10, "10-15%"),
    (15, "15-20%"), (20, "20-25%"), (25, "25%+"), (400, "25%+"),
])
def test_tip_buckets(spark, percent, label):
    assert label_of(spark, labels.tip_bucket, percent) == label


@pytest.mark.parametrize("code, label", [
    (1, "Credit card"), (2, "Cash"), (3, "No charge"), (4, "Dispute"), (5, "Unknown"),
    (6, "Voided"), (7, None), (0, None), (None, None),
])
def test_payment_labels(spark, code, label):
    assert label_of(spark, labels.payment_label, code) == label


@pytest.mark.parametrize("year, month, label", [
    (2019, 12, "Pre-COVID"), (2020, 2, "Pre-COVID"), (2020, 3, "Impact"), (2020, 5, "Impact"),
    (2020, 6, "Early recovery"), (2020, 12, "Early recovery"), (2021, 1, "Recovery"),
    (2022, 1, "Post-COVID"), (2030, 1, "Post-COVID"),
])
def test_recovery_periods(spark, year, month, label):
    at = labels.recovery_period(F.lit(year), F.lit(month), 2020)
    assert spark.range(1).select(at.alias("p")).first()["p"] == label


# -- demand and time series ------------------------------------------------------------------


def daily(spark, days):
    rows = [
        (day, day.year, day.month, trips, float(trips * 10), fare_, 2.0)
        for day, trips, fare_ in days
    ]
    return spark.createDataFrame(
        rows,
        "pickup_date date, pickup_year int, pickup_month int, trip_count bigint,"
        " total_revenue double, avg_fare double, avg_distance double",
    )


def monthly(spark, months):
    return daily(spark, [(date(y, m, 1), trips, 10.0) for (y, m), trips in months])


def test_hourly_profile_is_a_mean_over_months(spark):
    by_hour = spark.createDataFrame(
        [(2022, 1, 8, 10, 5.0), (2022, 2, 8, 30, 7.0), (2022, 1, 9, 60, 1.0)],
        "pickup_year int, pickup_month int, pickup_hour int, trip_count bigint, avg_fare double",
    )
    found = {r["pickup_hour"]: tuple(r)[1:] for r in demand.hourly_demand_profile(by_hour).collect()}
    assert found == {8: (20.0, 6.0, 25.0), 9: (60.0, 1.0, 75.0)}


def test_rolling_mean_covers_seven_rows_not_days(spark):
    start = date(2022, 1, 1)
    days = [(start + timedelta(days=3 * i), i + 1, 1.0) for i in range(9)]
    found = [r["rolling_7d_avg"] for r in
             demand.daily_trip_trend(daily(spark, days)).orderBy("pickup_date").collect()]
    assert found == [1.0, 2.0, 2.0, 3.0, 3.0, 4.0, 4.0, 5.0, 6.0]


def test_month_over_month_uses_the_previous_row(spark):
    by_date = monthly(spark, [((2022, 1), 100), ((2022, 4), 150), ((2022, 5), 0), ((2022, 6), 7)])
    found = demand.mom_trip_volume(by_date).orderBy("pickup_month").collect()
    assert [r["prev_month_trips"] for r in found] == [None, 100, 150, 0]
    assert [r["mom_change_pct"] for r in found] == [None, 50.0, -100.0, None]


def test_year_over_year_uses_the_twelfth_row_back(spark):
    months = [((2020 + i // 12, i % 12 + 1), 100 + i) for i in range(14)]
    found = time_series.monthly_volume_trend(monthly(spark, months))
    last = found.orderBy("pickup_year", "pickup_month").collect()[-1]
    assert (last["prev_year_trips"], last["yoy_trips_change_pct"]) == (101, 11.88)
    assert (last["prev_year_revenue"], last["yoy_revenue_change_pct"]) == (1010.0, 11.88)


def test_recovery_against_the_baseline(spark):
    by_date = monthly(spark, [((2020, 1), 100), ((2020, 2), 300), ((2020, 3), 50), ((2021, 1), 400)])
    found = time_series.covid_impact_recovery(by_date).orderBy("pickup_year", "pickup_month")
    assert [(r["pct_of_baseline"], r["covid_period"]) for r in found.collect()] == [
        (50.0, "Pre-COVID"), (150.0, "Pre-COVID"), (25.0, "Impact"), (200.0, "Recovery"),
    ]


@pytest.mark.parametrize("months", [[((2019, 1), 5)], [((2020, 1), 0), ((2021, 3), 4)]])
def test_without_a_baseline_the_columns_are_typed_nulls(spark, months):
    found = time_series.covid_impact_recovery(monthly(spark, months))
    assert dict(found.dtypes)["pct_of_baseline"] == "double"
    assert dict(found.dtypes)["covid_period"] == "string"
    assert {(r["pct_of_baseline"], r["covid_period"]) for r in found.collect()} == {(None, None)}


def test_seasonal_index_is_relative_to_all_months(spark):
    by_date = monthly(spark, [((2021, 1), 10), ((2022, 1), 30), ((2022, 2), 80)])
    found = {r["pickup_month"]: tuple(r)[1:] for r in
             time_series.seasonal_decomposition_proxy(by_date).collect()}
    assert found == {1: (20.0, 0.5), 2: (80.0, 2.0)}


def test_fare_evolution(spark):
    days = [(date(2021, 1, 1), 5, 10.0), (date(2021, 1, 2), 500, 20.0), (date(2022, 1, 1), 1, 18.0)]
    found = time_series.fare_evolution_yoy(daily(spark, days)).orderBy("pickup_year").collect()
    assert [(r["annual_trips"], r["avg_fare"], r["yoy_fare_change_pct"]) for r in found] == [
        (505, 15.0, None), (1, 18.0, 20.0),
    ]


def test_borough_shares(spark):
    by_borough = spark.createDataFrame(
        [("Queens", 1, 10.0, 4.0), ("Queens", 2, 20.0, 6.0), (None, 9, 0.0, 1.0)],
        "pickup_borough string, trip_count bigint, total_revenue double, avg_fare double",
    )
    found = {r["pickup_borough"]: tuple(r)[1:] for r in
             demand.borough_demand_breakdown(by_borough).collect()}
    assert found == {"Queens": (3, 30.0, 5.0, 25.0), None: (9, 0.0, 1.0, 75.0)}


# -- geo: by hand; the SQL checks compare them with the joins they replace -------------------------

EDGE_COLUMNS = (
    "pu_location_id int, pickup_zone string, pickup_borough string, "
    "do_location_id int, dropoff_zone string, dropoff_borough string, total_amount double"
)
A, B, C = (1, "Alley", "North"), (2, "Bay", "North"), (3, "Court", "South")
STRANGE, NOWHERE = (9, None, None), (None, None, None)


@pytest.fixture(scope="module")
def journeys(spark):
    """Three from A to B, one back, one from C to itself, and some with unknown ends."""
    rows = [(*A, *B, 10.0), (*A, *B, 20.0), (*A, *B, None), (*B, *A, 5.0), (*C, *C, 7.0)]
    rows += [(*A, *STRANGE, 1.0), (*STRANGE, *A, 2.0), (*STRANGE, *STRANGE, 4.0), (*NOWHERE, *B, 3.0)]
    return spark.createDataFrame(rows, EDGE_COLUMNS)


def test_zone_volume_by_hand(journeys):
    found = geo.zone_trip_volume(journeys)
    columns = ("location_id", "zone", "borough", "pickup_count", "pickup_revenue", "dropoff_count", "net_flow")
    assert set(map(tuple, found.select(*columns).collect())) == {
        (*A, 4, 31.0, 2, 2),
        (*B, 1, 5.0, 4, -3),
        (*C, 1, 7.0, 1, 0),
        # Unknown areas match nothing, so their pickups and drop-offs stay apart.
        (*STRANGE, 2, 6.0, None, None),
        (*STRANGE, None, None, 2, None),
        (*NOWHERE, 1, 3.0, None, None),
    }
    assert found.count() == 6
    one_way = geo.zone_trip_volume(journeys.filter("pu_location_id = 1 AND do_location_id = 2"))
    assert set(map(tuple, one_way.select(*columns).collect())) == {
        (*A, 3, 30.0, None, None), (*B, None, None, 3, None),
    }


def test_net_flow_by_hand(journeys):
    columns = ("location_id", "zone", "borough", "pickups", "dropoffs", "net_flow")
    found = geo.zone_net_flow(journeys).select(*columns).collect()
    assert len(found) == 5 and set(map(tuple, found)) == {
        (*A, 4, 2, 2), (*B, 1, 4, -3), (*C, 1, 1, 0), (*STRANGE, 2, 2, 0),
        # Without an id nothing can be looked up.
        (*NOWHERE, 0, 0, 0),
    }
    # Only areas with a pickup have a row; one without drop-offs has zero.
    one_way = geo.zone_net_flow(journeys.filter("pu_location_id = 1 AND do_location_id = 2"))
    assert [tuple(r) for r in one_way.select(*columns).collect()] == [(*A, 3, 0, 3)]


def test_geo_reads_the_trips_once(silver, spark, tmp_path):
    silver.write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    for build in (geo.zone_trip_volume, geo.zone_net_flow):
        plan = build(stored)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1


def test_standing_trips_have_no_fare_per_mile(spark, silver):
    still = silver.limit(3).withColumn("trip_distance", F.lit(0.0))
    assert geo.zone_revenue_per_mile(still).count() == 0
    assert geo.zone_revenue_per_mile(edge_grain(still)).count() == 0


# -- fares and ranking -----------------------------------------------------------------------


def test_anomalies_against_brute_force(silver):
    fares = sorted(r["fare_amount"] for r in silver.select("fare_amount").collect())
    q1, q3 = (fares[-(-len(fares) * n // 4) - 1] for n in (1, 3))
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    odd = (F.col("fare_amount") < low) | (F.col("fare_amount") > high)
    expected = silver.groupBy("pickup_year", "pickup_month").agg(
        F.count("*").alias("total_trips"), F.count_if(odd).alias("anomaly_count")
    )
    found = fare.fare_anomaly_detection(silver)
    assert as_set(found.drop("anomaly_pct")) == as_set(expected)
    assert found.agg(F.sum("anomaly_count")).first()[0] > 0
    for row in found.collect():
        assert row["anomaly_pct"] == round(row["anomaly_count"] / row["total_trips"] * 100, 2)


def test_no_trips_no_anomalies(silver):
    assert fare.fare_anomaly_detection(silver.limit(0)).count() == 0


def test_equal_groups_are_ranked_by_key(spark):
    groups = spark.createDataFrame(
        [("b", 5), ("a", 5), (None, 5), ("c", 9)], "k string, n bigint"
    )
    assert [r["k"] for r in top(groups, 3, "n", ["k"]).collect()] == ["c", "a", "b"]
    assert [r["k"] for r in top(groups, 4, "n", ["k"]).collect()] == ["c", "a", "b", None]


def test_top_k_needs_no_full_sort(silver):
    for build in (fare.top_revenue_zones, trip_patterns.top_corridors,
                  trip_patterns.busiest_pickup_zones):
        plan = build(silver, 3)._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan
        assert build(silver, 3).count() == 3


def test_only_card_tips_are_distributed(silver):
    found = as_dicts(fare.tip_percentage_distribution(silver))
    assert sum(r["trip_count"] for r in found) == silver.filter("payment_type = 1").count()
    assert {r["tip_pct_bucket"] for r in found} == {
        "no_tip", "0%", "1-10%", "10-15%", "15-20%", "20-25%", "25%+",
    }


def test_orders_of_the_summaries(silver):
    summary = SUMMARIES["inter_borough_flow"]
    counts = [r["trip_count"] for r in summary.ordered(summary.build(silver)).collect()]
    assert counts == sorted(counts, reverse=True)
    summary = SUMMARIES["hourly_pattern_by_day_type"]
    keys = [(r["is_weekend"], r["pickup_hour"]) for r in
            summary.ordered(summary.build(silver)).collect()]
    assert keys == sorted(keys)


def test_payment_trend_comes_from_the_mart(silver):
    trend = fare.payment_type_trend(marts.fare_summary(silver))
    assert trend.agg(F.sum("trip_count")).first()[0] == silver.count()
