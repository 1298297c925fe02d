"""What trips cost and how they are paid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmarts.functions.trends import percent
from tripmarts.operators.marts import MONTH
from tripmarts.operators.quantiles import counted, in_order, quantiles_in_order
from tripmarts.operators.rollup import TRIPS, is_grain, mean, rollup, total, trips_as
from tripmarts.plans.grains import tip_grain, with_distance_bucket
from tripmarts.plans.ranking import top
from tripmarts.sources.kept import kept


def fare_by_distance_bucket(trips: DataFrame) -> DataFrame:
    measures = (
        trips_as("trip_count"),
        mean("avg_fare", "fare_amount"),
        mean("avg_tip", "tip_amount"),
        mean("avg_total", "total_amount"),
        mean("avg_duration_mins", "trip_duration_mins"),
    )
    return rollup(with_distance_bucket(trips), ("distance_bucket",), measures)


def tip_percentage_distribution(trips: DataFrame) -> DataFrame:
    """Card trips per bucket of tip over fare."""
    tipped = trips if is_grain(trips) else tip_grain(trips)
    measures = trips_as("trip_count"), mean("avg_tip_pct", "tip_pct")
    return rollup(tipped, ("tip_pct_bucket",), measures)


def payment_type_trend(fares: DataFrame) -> DataFrame:
    """Trips per month and payment label, from the fare mart."""
    return rollup(fares, (*MONTH, "payment_label"), (total("trip_count", "trip_count"),))


def top_revenue_zones(trips: DataFrame, top_n: int = 20) -> DataFrame:
    measures = (
        trips_as("trip_count"),
        total("total_revenue", "total_amount"),
        mean("avg_fare", "fare_amount"),
        mean("avg_tip", "tip_amount"),
    )
    zones = ("pickup_zone", "pickup_borough")
    return top(rollup(trips, zones, measures), top_n, "total_revenue", zones)


def fare_anomaly_detection(trips: DataFrame) -> DataFrame:
    """Per month, trips whose fare lies beyond 1.5 interquartile ranges of the quartiles.

    Trips are counted once per month and fare, and the counts kept in the order of the fares. Both
    the overall quartiles and the flags come from those counts, so the trips are read once; the
    two fences enter the second step as a scalar subquery.
    """
    counts = kept(in_order(counted(trips, MONTH, "fare_amount", ()), (), "fare_amount"))
    quartiles = quantiles_in_order(counts, (), "fare_amount", {"q1": "0.25", "q3": "0.75"})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    fences = quartiles.select(
        F.struct((F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))
    ).scalar()

    fare = F.col("fare_amount")
    outside = (fare < fences["low"]) | (fare > fences["high"])
    monthly = counts.groupBy(*MONTH).agg(
        F.sum(TRIPS).alias("total_trips"),
        F.sum(outside.cast("int") * F.col(TRIPS)).alias("anomaly_count"),
    )
    return monthly.withColumn("anomaly_pct", percent(F.col("anomaly_count"), F.col("total_trips")))
