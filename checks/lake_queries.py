"""Queries over a lake: raw files written, all stages run on them, and what they stored read back.

The lake lies in the folder that driver and executors share, and is built once for each session and set of
tables: months are transformed in two runs, the earlier half first, so that what is read back was merged. A
session without a shared folder gets a temporary one if it is local; a cluster is refused.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import trips
from tripmarts import cli
from tripmarts.operators.marts import marts_of
from tripmarts.plans import stages
from tripmarts.plans.registry import SUMMARIES
from tripmarts.settings import MonthRange
from tripmarts.sources.kept import shared_folder
from tripmarts.sources.lake import Lake
from tripmarts.sources.raw import read_trip_data
from tripmarts.sources.zones import load_zone_lookup

KIND = "yellow"


@dataclass(frozen=True)
class Built:
    lake: Lake
    raw: str
    lookup: str
    months: MonthRange
    ingested: list[tuple[int, int]]
    namespace: str


_built: dict[tuple[str, str], Built] = {}


def folder_for(spark: SparkSession) -> str:
    folder = shared_folder(spark)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="lake-")


def built(spark: SparkSession, sf_dir: str) -> Built:
    """The lake of this session and these tables, built when it is first asked for."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _built:
        _built[key] = _build(spark, sf_dir, f"{folder_for(spark)}/lake-{uuid.uuid4().hex}")
    return _built[key]


def _build(spark: SparkSession, sf_dir: str, root: str) -> Built:
    raw, lookup, namespace = f"{root}/raw", f"{root}/zones", f"lake_{uuid.uuid4().hex[:8]}"
    months = trips.store_months(spark, sf_dir, raw, KIND)
    zones = trips.zone_rows(spark, sf_dir).selectExpr(
        "location_id AS LocationID", "borough AS Borough", "zone_name AS Zone", "'' AS service_zone"
    )
    zones.coalesce(1).write.option("header", True).csv(lookup)
    spark.sql(f"CREATE NAMESPACE {namespace} LOCATION '{root}/tables'")
    lake = Lake(spark, f"{root}/layers")
    ingested = stages.ingest(lake, raw, KIND, months, skip_missing=True)
    # A local month may begin in the month before the first.
    middle = (months.start_year + months.end_year) // 2
    for part in (
        MonthRange(months.start_year - 1, 1, middle, 12), MonthRange(middle + 1, 1, months.end_year, months.end_month)
    ):
        stages.transform(lake, lookup, KIND, part, refinement=trips.REFINEMENT)
    words = ["analytics", "--trip-type", KIND, "--lake", lake.root, "--catalog", namespace]
    cli.execute(cli.build_parser().parse_args(words), lake)
    lake.register(namespace, "silver", lake.silver_path(KIND))
    for mart in marts_of(KIND):
        lake.register(namespace, mart, lake.mart_path(mart, KIND))
    return Built(lake, raw, lookup, months, ingested, namespace)


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files as one DataFrame, with the file each row came from."""
    there = built(spark, sf_dir)
    rows = read_trip_data(spark, there.raw, KIND, there.months, skip_missing=True)
    per_file = rows.groupBy("_source_file").agg(
        F.count("*").alias("trip_count"), F.sum("fare_amount").alias("sum_fare_amount"),
        F.sum("PULocationID").alias("sum_pu_location_id"), F.count("airport_fee").alias("with_airport_fee"),
    )
    return _per_month_file(per_file)


def _per_month_file(per_file: DataFrame, *keys: str) -> DataFrame:
    """Counts and sums per stored file, added up per monthly file that it is a part of, named without its path."""
    named = F.regexp_extract("_source_file", "([a-z]+_tripdata_[0-9-]+)[.]parquet", 1).alias("source_file")
    added = [F.sum(name).alias(name) for name in per_file.columns if name not in ("_source_file", *keys)]
    return per_file.groupBy(named, *keys).agg(*added)


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = load_zone_lookup(spark, built(spark, sf_dir).lookup)
    return found.rows.select("location_id", "borough", "zone_name")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored Bronze per source file and month of the raw clock."""
    rows = built(spark, sf_dir).lake.read_bronze(KIND)
    keys = "_trip_type", "year", "month"
    per_file = rows.groupBy("_source_file", *keys).agg(
        F.count("*").alias("trip_count"), F.count("_ingested_at").alias("with_time"),
        F.sum("fare_amount").alias("sum_fare_amount"), F.sum("passenger_count").alias("sum_passenger_count"),
    )
    return _per_month_file(per_file, *keys)


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ingest counted, per column: files, values made null, values cut."""
    return built(spark, sf_dir).lake.read_audit(KIND).groupBy("column_name").agg(
        F.countDistinct("source_month").alias("files"), F.sum("nulled").alias("nulled"), F.sum("cut").alias("cut")
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored Silver per local month, borough and airport flag."""
    rows = built(spark, sf_dir).lake.read_silver(KIND)
    return rows.groupBy("pickup_year", "pickup_month", "pickup_borough", "is_airport_trip").agg(
        F.count("*").alias("trip_count"), F.sum("fare_amount").alias("sum_fare_amount"),
        F.max("pickup_hour").alias("last_hour"),
    )


def silver_of_some_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month range of Silver, by partition pruning: the last whole year."""
    there = built(spark, sf_dir)
    year = there.months.end_year - 1
    rows = there.lake.read_silver(KIND, MonthRange(year, 1, year, 12))
    return rows.groupBy("pickup_year", "pickup_month").agg(F.count("*").alias("trip_count"))


def _positions(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows with their place in the stored order: of files, and within them."""
    stored = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    order = Window.partitionBy("pickup_year", "pickup_month").orderBy("_file", "_row")
    return stored.select("pickup_year", "pickup_month", F.row_number().over(order).alias("position"), *columns)


def _mart_order(mart: str, *columns: str):
    return lambda spark, sf_dir: _positions(built(spark, sf_dir).lake.read_mart(mart, KIND), *columns)


def mart_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stored mart: rows, months, trips."""
    lake = built(spark, sf_dir).lake
    sizes = [
        lake.read_mart(mart, KIND).agg(
            F.lit(mart).alias("mart"), F.count("*").alias("mart_rows"),
            F.countDistinct("pickup_year", "pickup_month").alias("months"), F.sum("trip_count").alias("trips"),
        )
        for mart in marts_of(KIND)
    ]
    first, *others = sizes
    for other in others:
        first = first.unionByName(other)
    return first


def _summary_order(name: str, *columns: str):
    """A summary in its stored order; it is one file."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        summary = SUMMARIES[name]
        rows = built(spark, sf_dir).lake.read_summary(summary.domain, summary.output_name(**summary.params), KIND)
        stored = rows.select("*", F.col("_metadata.row_index").alias("_row"))
        return stored.select((F.col("_row") + 1).alias("position"), *columns)

    return query


def _stored(name: str):
    """A summary as `analyse` wrote it from grains that two runs stored."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        summary = SUMMARIES[name]
        return built(spark, sf_dir).lake.read_summary(summary.domain, summary.output_name(**summary.params), KIND)

    return query


def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered tables: rows of Silver, of the marts and of some summaries, asked by name."""
    namespace = built(spark, sf_dir).namespace
    names = ["silver", *marts_of(KIND), "inter_borough_flow_yellow", "zone_net_flow_yellow", "monthly_volume_trend_yellow"]
    return spark.sql(
        " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS table_rows FROM {namespace}.{name}" for name in names)
    )


def ingested_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months that ingest reported, each with what it stored."""
    there = built(spark, sf_dir)
    named = spark.createDataFrame(there.ingested, "year int, month int")
    rows = spark.read.parquet(there.lake.bronze_path(KIND)).groupBy("source_month").agg(F.count("*").alias("trip_count"))
    return named.join(rows, F.col("source_month") == F.col("year") * 100 + F.col("month")).drop("source_month")


STORED = (
    "fare_anomaly_detection", "top_corridors", "tip_percentage_distribution", "distance_distribution_by_borough",
    "hourly_pattern_by_day_type", "zone_trip_volume",
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "lake_ingested_months": ingested_months,
        "lake_raw_scan": raw_scan,
        "lake_zone_lookup": zone_lookup,
        "lake_bronze": bronze,
        "lake_audit": audit,
        "lake_silver": silver,
        "lake_silver_of_a_year": silver_of_some_months,
        "lake_order_by_hour": _mart_order("trips_by_hour", "pickup_hour", "trip_count"),
        "lake_order_by_date": _mart_order("trips_by_date", "pickup_date", "trip_count"),
        "lake_order_by_borough": _mart_order("trips_by_borough", "pickup_borough", "trip_count"),
        "lake_mart_sizes": mart_sizes,
        "lake_order_zone_net_flow": _summary_order("zone_net_flow", "net_flow"),
        "lake_order_hourly_pattern": _summary_order("hourly_pattern_by_day_type", "is_weekend", "pickup_hour"),
        "lake_order_monthly_volume": _summary_order("monthly_volume_trend", "pickup_year", "pickup_month"),
        "lake_tables": tables,
    } | {f"stored_{name}": _stored(name) for name in STORED}
