"""Bronze rows to Silver rows: clean, then enrich.

Everything here is a projection, a filter or a join with the zone dimension. While that is counted
as small, the whole step runs without moving trips between executors; beyond, trips are
shuffled with salted locations.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmarts.contracts import contract_for
from tripmarts.functions.clock import local_clock, minutes_between, on_weekend, seconds_between
from tripmarts.settings import Quality, Refinement
from tripmarts.sources.zones import Zones

PICKUP, DROPOFF = "pickup_datetime", "dropoff_datetime"
# Tasks that share the trips of one location, if the lookup is too large to broadcast.
SALTS = 16
LOOSE_SALTS = 1 << 16
SALT = "_salt"


def _present(trips: DataFrame, name: str) -> Column:
    """Neither null nor NaN, as separate conditions: `IS NOT NULL` reaches the Parquet scan."""
    column = F.col(name)
    is_float = trips.schema[name].dataType.typeName() in ("double", "float")
    return column.isNotNull() & ~F.isnan(column) if is_float else column.isNotNull()


def drop_incomplete(trips: DataFrame, kind: str) -> DataFrame:
    """Keep trips that have every column their kind requires."""
    required = contract_for(kind).required
    return trips.filter(reduce(and_, (_present(trips, name) for name in required)))


def drop_outliers(trips: DataFrame, kind: str, quality: Quality = Quality()) -> DataFrame:
    """Keep trips within the limits that apply to their kind.

    Limits on stored columns are compared directly, which lets the scan skip row groups. A
    null fails every comparison, so an unknown passenger count falls out as well.
    """
    checks = {
        "distance": lambda: F.col("trip_distance").between(*quality.distance),
        "fare": lambda: F.col("fare_amount").between(*quality.fare),
        "duration": lambda: seconds_between(PICKUP, DROPOFF).between(*quality.duration_secs),
        "passengers": lambda: F.col("passenger_count") > quality.passengers_above,
    }
    rules = contract_for(kind).rules
    return trips.filter(reduce(and_, (checks[rule]() for rule in rules))) if rules else trips


def add_local_time(trips: DataFrame, zone: str) -> DataFrame:
    """Local pickup time and its calendar parts. Day of week runs from 1 = Sunday."""
    local = F.col("pickup_datetime_local")
    return trips.withColumn("pickup_datetime_local", local_clock(PICKUP, zone)).withColumns(
        {
            "pickup_hour": F.hour(local),
            "pickup_day_of_week": F.dayofweek(local),
            "is_weekend": on_weekend(local),
            "pickup_month": F.month(local),
            "pickup_year": F.year(local),
        }
    )


def add_zones(trips: DataFrame, zones: Zones) -> DataFrame:
    """Zone and borough of both ends; null where the lookup has no such location."""
    for role, key in (("pickup", "pu_location_id"), ("dropoff", "do_location_id")):
        named = zones.rows.select(
            F.col("location_id").alias(key),
            F.col("borough").alias(f"{role}_borough"),
            F.col("zone_name").alias(f"{role}_zone"),
        )
        if zones.few:
            trips = trips.join(F.broadcast(named), key, "left")
        else:
            trips = _salted_join(trips, named, key)
    return trips


def _salted_join(trips: DataFrame, named: DataFrame, key: str) -> DataFrame:
    """A left join by shuffle in which no location is hot.

    Every row of the lookup stands under each salt, a trip under one, drawn from its times; so the
    trips of one location go to as many tasks as there are salts. Trips without a location match
    nothing, so theirs is drawn from far more numbers and they spread over all tasks.
    """
    drawn = F.xxhash64(PICKUP, DROPOFF, key)
    salt = F.pmod(drawn, F.when(F.col(key).isNull(), LOOSE_SALTS).otherwise(SALTS))
    salted = named.filter(F.col(key).isNotNull()).withColumn(
        SALT, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    )
    return trips.withColumn(SALT, salt).join(salted, [key, SALT], "left").drop(SALT)


def add_trip_facts(trips: DataFrame, airport_ids: tuple[int, ...]) -> DataFrame:
    """Duration in minutes, and whether either end is an airport."""
    if "pu_location_id" in trips.columns:
        ends = F.col("pu_location_id"), F.col("do_location_id")
        at_airport = ends[0].isin(*airport_ids) | ends[1].isin(*airport_ids)
    else:
        at_airport = F.lit(False)
    return trips.withColumns(
        {"trip_duration_mins": minutes_between(PICKUP, DROPOFF), "is_airport_trip": at_airport}
    )


def refine(
    bronze: DataFrame, kind: str, refinement: Refinement = Refinement()
) -> DataFrame:
    """Silver without zone names: all that summaries by time, fare or duration need."""
    clean = drop_outliers(drop_incomplete(bronze, kind), kind, refinement.quality)
    timed = add_local_time(clean, refinement.local_zone)
    return add_trip_facts(timed, refinement.airport_ids)


def to_silver(
    bronze: DataFrame, zones: Zones, kind: str, refinement: Refinement = Refinement()
) -> DataFrame:
    return add_zones(refine(bronze, kind, refinement), zones)
