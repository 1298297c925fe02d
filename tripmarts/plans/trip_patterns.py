"""Between which places and when people travel."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmarts.operators.marts import AVG_DISTANCE, AVG_FARE, MONTH, TRIP_COUNT
from tripmarts.operators.quantiles import rollup_with_quantiles
from tripmarts.operators.rollup import rollup
from tripmarts.plans.ranking import top


def top_corridors(trips: DataFrame, top_n: int = 25) -> DataFrame:
    """Most travelled pairs of pickup and drop-off zone."""
    pair = ("pickup_zone", "dropoff_zone", "pickup_borough", "dropoff_borough")
    corridors = rollup(trips, pair, (TRIP_COUNT, AVG_DISTANCE, AVG_FARE))
    return top(corridors, top_n, "trip_count", pair)


def airport_trip_share(trips: DataFrame) -> DataFrame:
    """Airport and other trips per month."""
    keys = (*MONTH, "is_airport_trip")
    return rollup(trips, keys, (TRIP_COUNT, AVG_FARE, AVG_DISTANCE))


def distance_distribution_by_borough(trips: DataFrame, accuracy: int | None = None) -> DataFrame:
    points = {
        "p25_distance": "0.25",
        "p50_distance": "0.5",
        "p75_distance": "0.75",
        "p95_distance": "0.95",
    }
    measures = TRIP_COUNT, AVG_DISTANCE
    keys = ("pickup_borough",)
    return rollup_with_quantiles(trips, keys, measures, "trip_distance", points, accuracy)


def busiest_pickup_zones(trips: DataFrame, top_n: int = 30) -> DataFrame:
    zone = ("pickup_zone", "pickup_borough")
    return top(rollup(trips, zone, (TRIP_COUNT, AVG_FARE)), top_n, "trip_count", zone)


def hourly_pattern_by_day_type(trips: DataFrame) -> DataFrame:
    """Trips per hour of day, working days and weekends apart."""
    keys = ("pickup_hour", "is_weekend")
    return rollup(trips, keys, (TRIP_COUNT, AVG_DISTANCE, AVG_FARE))
