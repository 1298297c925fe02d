"""The pre-aggregates of Silver that serve all Silver-based summaries and the marts with quantiles.

Their size depends on the zones, the calendar and how finely values are told, not on the trips: at most one
row per pair of zones; 480 rows per month (24 hours x 2 kinds of day x 2 x 5 buckets); a row per
different fare and label, duration, or distance and borough. With the month among their keys they are
stored month by month, and months are merged by adding up, so a rerun of one month reads that month alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmarts.contracts import CONTRACTS
from tripmarts.functions.labels import CARD, distance_bucket, tip_bucket, tip_percent
from tripmarts.operators.marts import MONTH, with_payment_label, with_tip_ratio
from tripmarts.operators.rollup import grain

PICKUP_AREA = ("pu_location_id", "pickup_zone", "pickup_borough")
DROPOFF_AREA = ("do_location_id", "dropoff_zone", "dropoff_borough")
MOVED = "_moved"


def with_distance_bucket(trips: DataFrame) -> DataFrame:
    if "distance_bucket" in trips.columns or "trip_distance" not in trips.columns:
        return trips
    return trips.withColumn("distance_bucket", distance_bucket(F.col("trip_distance")))


def with_fare_per_mile(trips: DataFrame) -> DataFrame:
    """Whether a trip covered any distance, and its fare per mile if it did."""
    if MOVED in trips.columns or not {"trip_distance", "fare_amount"} <= set(trips.columns):
        return trips
    return trips.withColumns(
        {
            MOVED: F.col("trip_distance") > 0,
            "fare_per_mile": F.try_divide("fare_amount", "trip_distance"),
        }
    )


def edge_grain(silver: DataFrame, *more_keys: str) -> DataFrame:
    """Trips per origin and destination."""
    return grain(
        with_fare_per_mile(silver),
        (*more_keys, *PICKUP_AREA, *DROPOFF_AREA, MOVED),
        ("fare_amount", "tip_amount", "total_amount", "trip_distance", "fare_per_mile"),
    )


def profile_grain(silver: DataFrame) -> DataFrame:
    """Trips per month, hour, kind of day, airport flag and distance bucket."""
    return grain(
        with_distance_bucket(silver),
        (*MONTH, "pickup_hour", "is_weekend", "is_airport_trip", "distance_bucket"),
        ("fare_amount", "tip_amount", "total_amount", "trip_distance", "trip_duration_mins"),
    )


def monthly_edge_grain(silver: DataFrame) -> DataFrame:
    return edge_grain(silver, *MONTH)


def fare_grain(silver: DataFrame) -> DataFrame:
    """Trips per month, payment label and fare."""
    paid = with_tip_ratio(with_payment_label(silver))
    return grain(paid, (*MONTH, "payment_label", "fare_amount"), ("fare_amount", "tip_amount", "tip_ratio"))


def duration_grain(silver: DataFrame) -> DataFrame:
    """Trips per month and duration."""
    return grain(silver, (*MONTH, "trip_duration_mins"), ("trip_duration_mins",))


def distance_grain(silver: DataFrame) -> DataFrame:
    """Trips per month, pickup borough and distance."""
    return grain(silver, (*MONTH, "pickup_borough", "trip_distance"), ("trip_distance",))


def tip_grain(silver: DataFrame) -> DataFrame:
    """Card trips per month and bucket of tip over fare."""
    card = silver.filter(F.col("payment_type") == CARD)
    tipped = card.withColumn("tip_pct", tip_percent(F.col("tip_amount"), F.col("fare_amount")))
    bucketed = tipped.withColumn("tip_pct_bucket", tip_bucket(F.col("tip_pct")))
    return grain(bucketed, (*MONTH, "tip_pct_bucket"), ("tip_pct",))


@dataclass(frozen=True)
class StoredGrain:
    """A grain that the lake stores by month, and the columns without which a kind has none."""

    build: Callable[[DataFrame], DataFrame]
    needs: tuple[str, ...] = ()

    def supports(self, kind: str) -> bool:
        return set(self.needs) <= set(CONTRACTS[kind].columns)


EDGES, PROFILE, FARES, DURATIONS, DISTANCES, TIPS = "edges", "profile", "fares", "durations", "distances", "tips"

GRAINS: dict[str, StoredGrain] = {
    EDGES: StoredGrain(monthly_edge_grain),
    PROFILE: StoredGrain(profile_grain),
    FARES: StoredGrain(fare_grain, ("fare_amount",)),
    DURATIONS: StoredGrain(duration_grain),
    DISTANCES: StoredGrain(distance_grain, ("trip_distance",)),
    TIPS: StoredGrain(tip_grain, ("payment_type", "tip_amount", "fare_amount")),
}
