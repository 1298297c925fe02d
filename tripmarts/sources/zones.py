"""The zone dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A zone row is well under 200 bytes, so this many are a few megabytes on each executor.
BROADCAST_ROWS = 20_000


@dataclass(frozen=True)
class Zones:
    """Zone rows with a unique `location_id`, and whether they were counted as few."""

    rows: DataFrame
    few: bool = False


def load_zone_lookup(spark: SparkSession, path: str) -> Zones:
    """Read the lookup file, refusing ids that occur twice: they would multiply trips."""
    rows = spark.read.option("header", True).csv(path).select(
        F.col("LocationID").try_cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone"),
    )
    return checked_zones(rows, path)


def checked_zones(rows: DataFrame, label: str = "zones") -> Zones:
    """Count the dimension (one row comes back) and check that its key is one."""
    tally = rows.agg(
        F.count("*").alias("total"),
        F.count("location_id").alias("keyed"),
        F.count_distinct("location_id").alias("ids"),
    ).first()
    if tally["keyed"] != tally["ids"]:
        repeats = tally["keyed"] - tally["ids"]
        raise ValueError(f"{label}: location_id is not unique ({repeats} repeated rows)")
    return Zones(rows, few=tally["total"] <= BROADCAST_ROWS)
