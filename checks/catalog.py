"""Every registered query: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import lake_queries, trips
from checks.rounding import DIGITS
from tripmarts.contracts import contract_for
from tripmarts.operators import marts
from tripmarts.operators.silver import (
    add_local_time,
    add_trip_facts,
    add_zones,
    drop_incomplete,
    drop_outliers,
)
from tripmarts.plans.grains import GRAINS, edge_grain, profile_grain
from tripmarts.plans.registry import SUMMARIES
from tripmarts.settings import LOCAL_ZONE

Query = Callable[[SparkSession, str], DataFrame]

# The given orders span 1995-2001, so the recovery baseline moves to a year they contain.
BASELINE_YEAR = 2000
SUMMARY_PARAMS = {"covid_impact_recovery": {"baseline_year": BASELINE_YEAR}}
QUERY_NAMES = {
    "covid_impact_recovery": "baseline_recovery",
    "seasonal_decomposition_proxy": "seasonal_index",
}

_MONEY = ("trip_distance", "fare_amount", "tip_amount", "total_amount")


def _sums(columns: tuple[str, ...]) -> list:
    return [F.sum(name).alias(f"sum_{name}") for name in columns]


def bronze_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows under their Bronze names, audited per raw month and vendor."""
    rows = trips.bronze(spark, sf_dir)
    return rows.groupBy("_trip_type", "year", "month", "vendor_id", "store_and_fwd_flag").agg(
        F.count("*").alias("trip_count"),
        F.count("pu_location_id").alias("with_pickup_location"),
        F.count("airport_fee").alias("with_airport_fee"),
        F.sum("rate_code_id").alias("sum_rate_code_id"),
        F.sum("passenger_count").alias("sum_passenger_count"),
        F.sum("mta_tax").alias("sum_mta_tax"),
        F.sum("payment_type").alias("sum_payment_type"),
        F.sum("do_location_id").alias("sum_do_location_id"),
        *_sums(_MONEY),
    )


def _bronze_of(kind: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = trips.bronze(spark, sf_dir, kind)
        present = [name for name in _MONEY if name in rows.columns]
        return rows.groupBy("_trip_type", "year", "month").agg(
            F.count("*").alias("trip_count"),
            F.sum("pu_location_id").alias("sum_pu_location_id"),
            F.sum("do_location_id").alias("sum_do_location_id"),
            *_sums(tuple(present)),
        )

    return query


def silver_null_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_incomplete(trips.bronze(spark, sf_dir), "yellow")
    return kept.groupBy("year", "month").agg(F.count("*").alias("trip_count"), *_sums(_MONEY))


def silver_outlier_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_outliers(trips.bronze(spark, sf_dir), "yellow")
    measured = (*_MONEY, "passenger_count")
    return kept.groupBy("year", "month").agg(F.count("*").alias("trip_count"), *_sums(measured))


def silver_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = add_local_time(trips.bronze(spark, sf_dir), LOCAL_ZONE)
    parts = ("pickup_year", "pickup_month", "pickup_day_of_week", "is_weekend", "pickup_hour")
    return timed.groupBy(F.to_date("pickup_datetime_local").alias("pickup_date"), *parts).agg(
        F.count("*").alias("trip_count")
    )


def silver_zone_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = add_zones(trips.bronze(spark, sf_dir), trips.zones(spark, sf_dir))
    ends = [f"{role}_{part}" for role in ("pickup", "dropoff") for part in ("borough", "zone")]
    return named.groupBy("pu_location_id", "do_location_id", *ends).agg(
        F.count("*").alias("trip_count")
    )


def silver_duration_airport(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = add_trip_facts(trips.bronze(spark, sf_dir), trips.AIRPORTS)
    return facts.groupBy("trip_duration_mins", "is_airport_trip").agg(
        F.count("*").alias("trip_count")
    )


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver itself, row by row."""
    return trips.silver(spark, sf_dir).select(
        F.to_date("pickup_datetime_local").alias("pickup_date"),
        "pickup_hour",
        "is_weekend",
        "pickup_zone",
        "dropoff_zone",
        "trip_distance",
        "fare_amount",
        "trip_duration_mins",
        "is_airport_trip",
    )


def bronze_contract_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per raw month, the rows and how many lack each column that a trip cannot do without."""
    rows = trips.bronze(spark, sf_dir)
    lacking = [F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in contract_for("yellow").required]
    return rows.groupBy("year", "month").agg(F.count("*").alias("trip_count"), *lacking)


def _mart_of(silver: DataFrame, name: str) -> DataFrame:
    """A mart the way the stages build it: those by hour, date and borough through their grain."""
    source = marts.slot_grain(silver) if name in marts.SLOT_MARTS else silver
    return getattr(marts, name)(source)


def _mart(name: str, kind: str = "yellow", direct: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        silver = trips.silver(spark, sf_dir, kind)
        return getattr(marts, name)(silver) if direct else _mart_of(silver, name)

    return query


def _grain(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(trips.silver(spark, sf_dir))


# Of the fare mart, this summary needs the trips of each group only, no quantiles.
COUNTED = "payment_type_trend"


def _summary(name: str, kind: str = "yellow", direct: bool = False, **params: int) -> Query:
    """A summary in one plan from the raw trips on, through the mart or grain the stages use.

    `direct` builds it from the trips where the stages use a grain.
    """
    summary = SUMMARIES[name]
    params = {**summary.params, **SUMMARY_PARAMS.get(name, {}), **params}

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = trips.silver(spark, sf_dir, kind)
        if name == COUNTED:
            source = marts.payment_counts(source)
        elif summary.source in GRAINS and not direct:
            source = GRAINS[summary.source].build(source)
        elif summary.source not in GRAINS:
            source = _mart_of(source, summary.source)
        return summary.build(source, **params)

    return query


def _steady(query: Query, columns: Mapping[str, int]) -> Query:
    """Round away the last bits of doubles, which depend on the order of additions."""

    def rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = query(spark, sf_dir)
        return rows.withColumns({name: F.round(name, to) for name, to in columns.items()})

    return rounded


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "bronze_projection": bronze_projection,
        "bronze_green": _bronze_of("green"),
        "bronze_fhv": _bronze_of("fhv"),
        "bronze_fhvhv": _bronze_of("fhvhv"),
        "bronze_contract_audit": bronze_contract_audit,
        "silver_null_drop": silver_null_drop,
        "silver_outlier_filter": silver_outlier_filter,
        "silver_datetime": silver_datetime,
        "silver_zone_join": silver_zone_join,
        "silver_duration_airport": silver_duration_airport,
        "silver_trips": silver_trips,
    }
    for name in (*marts.SLOT_MARTS, "fare_summary", "trip_duration_summary"):
        found[f"gold_{name}"] = _mart(name)
    found |= {
        "slot_grain": _grain(marts.slot_grain),
        "edge_grain": _grain(edge_grain),
        "profile_grain": _grain(profile_grain),
    }
    for name in SUMMARIES:
        found[QUERY_NAMES.get(name, name)] = _summary(name)
    found |= {
        "green_fare_summary": _mart("fare_summary", "green"),
        "green_top_revenue_zones": _summary("top_revenue_zones", "green"),
        "green_trip_duration_summary": _mart("trip_duration_summary", "green"),
        "green_tip_percentage_distribution": _summary("tip_percentage_distribution", "green"),
        "fhv_trips_by_hour": _mart("trips_by_hour", "fhv"),
        "fhv_trip_duration_summary": _mart("trip_duration_summary", "fhv"),
        "fhv_zone_trip_volume": _summary("zone_trip_volume", "fhv"),
        "fhv_zone_net_flow": _summary("zone_net_flow", "fhv"),
        "fhv_top_corridors": _summary("top_corridors", "fhv"),
        "fhv_busiest_pickup_zones": _summary("busiest_pickup_zones", "fhv"),
        "fhv_inter_borough_flow": _summary("inter_borough_flow", "fhv"),
        "fhvhv_trips_by_date": _mart("trips_by_date", "fhvhv"),
        "fhvhv_monthly_volume_trend": _summary("monthly_volume_trend", "fhvhv"),
        "fhvhv_fare_anomaly_detection": _summary("fare_anomaly_detection", "fhvhv"),
        "fhvhv_hourly_demand_profile": _summary("hourly_demand_profile", "fhvhv"),
        "fhvhv_mom_trip_volume": _summary("mom_trip_volume", "fhvhv"),
        "fhvhv_top_corridors": _summary("top_corridors", "fhvhv"),
        "fhvhv_zone_revenue_per_mile": _summary("zone_revenue_per_mile", "fhvhv"),
        "fhvhv_seasonal_index": _summary("seasonal_decomposition_proxy", "fhvhv"),
        "fhvhv_distance_distribution_by_borough": _summary("distance_distribution_by_borough", "fhvhv"),
        # A baseline early enough that all periods occur.
        "early_baseline_recovery": _summary("covid_impact_recovery", baseline_year=1999),
        # The same from the trips where the stages use a grain.
        "direct_trips_by_hour": _mart("trips_by_hour", direct=True),
        "direct_trips_by_borough": _mart("trips_by_borough", direct=True),
        "direct_top_revenue_zones": _summary("top_revenue_zones", direct=True),
        "direct_fare_by_distance_bucket": _summary("fare_by_distance_bucket", direct=True),
    }
    found |= lake_queries.queries()
    return {name: _steady(query, DIGITS.get(name, {})) for name, query in found.items()}
