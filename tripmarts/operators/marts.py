"""Silver rows to the five KPI marts."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmarts.contracts import contract_for
from tripmarts.functions.labels import payment_label
from tripmarts.operators.quantiles import rollup_with_quantiles
from tripmarts.operators.rollup import grain, is_grain, mean, rollup, total, trips_as

MONTH = ("pickup_year", "pickup_month")

TRIP_COUNT = trips_as("trip_count")
REVENUE = total("total_revenue", "total_amount")
AVG_FARE = mean("avg_fare", "fare_amount")
AVG_DISTANCE = mean("avg_distance", "trip_distance")
AVG_DURATION = mean("avg_duration_mins", "trip_duration_mins")


def with_date(trips: DataFrame) -> DataFrame:
    return trips.withColumn("pickup_date", F.to_date("pickup_datetime_local"))


def slot_grain(silver: DataFrame) -> DataFrame:
    """Trips per local hour and pickup borough: the common pre-aggregate of three marts."""
    return grain(
        with_date(silver),
        (*MONTH, "pickup_date", "pickup_hour", "pickup_borough"),
        ("total_amount", "fare_amount", "trip_distance", "trip_duration_mins"),
    )


def trips_by_hour(trips: DataFrame) -> DataFrame:
    measures = TRIP_COUNT, AVG_FARE, AVG_DISTANCE, REVENUE
    return rollup(trips, (*MONTH, "pickup_hour"), measures)


def trips_by_date(trips: DataFrame) -> DataFrame:
    dated = trips if is_grain(trips) else with_date(trips)
    measures = TRIP_COUNT, REVENUE, AVG_FARE, AVG_DISTANCE, AVG_DURATION
    return rollup(dated, ("pickup_date", *MONTH), measures)


def trips_by_borough(trips: DataFrame) -> DataFrame:
    measures = TRIP_COUNT, REVENUE, AVG_FARE, AVG_DISTANCE
    return rollup(trips, (*MONTH, "pickup_borough"), measures)


def with_payment_label(silver: DataFrame) -> DataFrame:
    if "payment_type" not in silver.columns:
        return silver
    return silver.withColumn("payment_label", payment_label(F.col("payment_type")))


def with_tip_ratio(silver: DataFrame) -> DataFrame:
    if not {"tip_amount", "fare_amount"} <= set(silver.columns):
        return silver
    return silver.withColumn("tip_ratio", F.try_divide("tip_amount", "fare_amount"))


def payment_counts(silver: DataFrame) -> DataFrame:
    """The fare mart's groups with their trips alone."""
    return rollup(with_payment_label(silver), (*MONTH, "payment_label"), (TRIP_COUNT,))


def fare_summary(trips: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Fares and tips per payment label; codes without a label form a group of their own."""
    paid = trips if is_grain(trips) else with_tip_ratio(with_payment_label(trips))
    measures = (
        TRIP_COUNT,
        AVG_FARE,
        mean("avg_tip", "tip_amount"),
        mean("avg_tip_pct", "tip_ratio", scale=100),
    )
    points = {"median_fare": "0.5", "p95_fare": "0.95"}
    keys = (*MONTH, "payment_label")
    return rollup_with_quantiles(paid, keys, measures, "fare_amount", points, accuracy)


def trip_duration_summary(trips: DataFrame, accuracy: int | None = None) -> DataFrame:
    points = {
        "p25_duration": "0.25",
        "p50_duration": "0.5",
        "p75_duration": "0.75",
        "p95_duration": "0.95",
    }
    measures = TRIP_COUNT, AVG_DURATION
    return rollup_with_quantiles(trips, MONTH, measures, "trip_duration_mins", points, accuracy)


SLOT_MARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "trips_by_hour": trips_by_hour,
    "trips_by_date": trips_by_date,
    "trips_by_borough": trips_by_borough,
}


def marts_of(kind: str) -> tuple[str, ...]:
    """The marts that the kind supports."""
    fares = ("fare_summary",) if contract_for(kind).has_payments else ()
    return (*SLOT_MARTS, "trip_duration_summary", *fares)


def mart_builders(
    silver: DataFrame,
    kind: str,
    slots: DataFrame | None = None,
    durations: DataFrame | None = None,
    fares: DataFrame | None = None,
    accuracy: int | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """What builds each mart the kind supports, from grains where there are any.

    `slots` is a held `slot_grain`. Sketches, asked for by `accuracy`, need the trips themselves.
    """

    def counts(grain_: DataFrame | None) -> DataFrame:
        return silver if grain_ is None or accuracy is not None else grain_

    builders = {name: partial(build, silver if slots is None else slots) for name, build in SLOT_MARTS.items()}
    builders["trip_duration_summary"] = partial(trip_duration_summary, counts(durations), accuracy)
    if contract_for(kind).has_payments:
        builders["fare_summary"] = partial(fare_summary, counts(fares), accuracy)
    return builders


def build_marts(silver: DataFrame, kind: str, *grains: DataFrame | None) -> dict[str, DataFrame]:
    """Every mart the kind supports."""
    return {name: build() for name, build in mart_builders(silver, kind, *grains).items()}
