"""Where trips start and end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmarts.operators.marts import AVG_DISTANCE, AVG_FARE, TRIP_COUNT
from tripmarts.operators.rollup import TRIPS, is_grain, mean, rollup
from tripmarts.plans.grains import (
    DROPOFF_AREA,
    MOVED,
    PICKUP_AREA,
    edge_grain,
    with_fare_per_mile,
)

AREA = ("location_id", "zone", "borough")


def _visits(trips: DataFrame) -> DataFrame:
    """Two rows per origin-destination pair: what it adds to the pickups of one area, and to
    the drop-offs of another. One read of the trips serves both sides."""
    edges = trips if is_grain(trips) else edge_grain(trips)
    has_revenue = "_sum_total_amount" in edges.columns
    revenue = F.col("_sum_total_amount") if has_revenue else F.lit(None).cast("double")
    nothing = F.lit(None)

    def side(area: tuple[str, ...], pickups: Column, dropoffs: Column, paid: Column) -> Column:
        named = [F.col(column).alias(name) for column, name in zip(area, AREA)]
        return F.struct(
            *named,
            pickups.cast("bigint").alias("pickups"),
            dropoffs.cast("bigint").alias("dropoffs"),
            paid.cast("double").alias("revenue"),
        )

    trips_made = F.col(TRIPS)
    sides = F.array(
        side(PICKUP_AREA, trips_made, nothing, revenue),
        side(DROPOFF_AREA, nothing, trips_made, nothing),
    )
    return edges.select(F.explode(sides).alias("visit")).select("visit.*")


def zone_trip_volume(trips: DataFrame) -> DataFrame:
    """Pickups, drop-offs and revenue per area.

    Equals a full outer join of pickups and drop-offs on id, zone and borough: a side without
    trips is null, and so is the net flow. As in such a join, areas with an unknown part
    never match, so their two sides stay apart.
    """
    pickup_side = F.col("pickups").isNotNull()
    unknown = F.col("location_id").isNull() | F.col("zone").isNull() | F.col("borough").isNull()
    return (
        _visits(trips)
        .groupBy(*AREA, F.when(unknown, pickup_side).alias("_apart"))
        .agg(
            F.sum("pickups").alias("pickup_count"),
            F.sum("revenue").alias("pickup_revenue"),
            F.sum("dropoffs").alias("dropoff_count"),
        )
        .drop("_apart")
        .withColumn("net_flow", F.col("pickup_count") - F.col("dropoff_count"))
    )


def zone_revenue_per_mile(trips: DataFrame) -> DataFrame:
    """Mean fare per mile of the trips picked up in each area."""
    moved = with_fare_per_mile(trips).filter(MOVED)
    measures = TRIP_COUNT, mean("avg_fare_per_mile", "fare_per_mile"), AVG_FARE, AVG_DISTANCE
    return rollup(moved, PICKUP_AREA, measures)


def inter_borough_flow(trips: DataFrame) -> DataFrame:
    keys = ("pickup_borough", "dropoff_borough")
    return rollup(trips, keys, (TRIP_COUNT, AVG_DISTANCE, AVG_FARE))


def zone_net_flow(trips: DataFrame) -> DataFrame:
    """Pickups minus drop-offs of every area that has a pickup.

    Equals the distinct pickup areas left-joined, on the id alone, with pickups and drop-offs
    per id, gaps filled with zero; hence an area without an id has zeros.
    """
    same_id = Window.partitionBy("location_id")
    known = F.col("location_id").isNotNull()

    def per_id(column: str) -> Column:
        return F.when(known, F.coalesce(F.sum(column).over(same_id), F.lit(0))).otherwise(0)

    return (
        _visits(trips)
        .groupBy(*AREA)
        .agg(F.sum("pickups").alias("own"), F.sum("dropoffs").alias("incoming"))
        .select(
            *AREA,
            F.col("own").isNotNull().alias("_has_pickup"),
            per_id("own").alias("pickups"),
            per_id("incoming").alias("dropoffs"),
        )
        .filter("_has_pickup")
        .drop("_has_pickup")
        .withColumn("net_flow", F.col("pickups") - F.col("dropoffs"))
    )
