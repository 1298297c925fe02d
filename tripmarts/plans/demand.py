"""When and where trips are asked for. Inputs are marts.

Means over mart rows are means of means: each month (or day) counts once, however many trips
it had.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmarts.functions.trends import change_since, rolling_mean, rows_back, share_of_total
from tripmarts.operators.marts import MONTH
from tripmarts.operators.rollup import mean, rollup, total


def hourly_demand_profile(by_hour: DataFrame) -> DataFrame:
    """Mean monthly trips per hour of day, and each hour's share of their sum."""
    measures = mean("avg_trips", "trip_count"), mean("avg_fare", "avg_fare")
    hourly = rollup(by_hour, ("pickup_hour",), measures)
    return hourly.withColumn("pct_of_daily_total", share_of_total("avg_trips"))


def daily_trip_trend(by_date: DataFrame) -> DataFrame:
    """Trips per day with the mean of the last seven rows (days without trips have no row)."""
    shown = ("pickup_date", "trip_count", "total_revenue", "avg_fare")
    rolling = F.round(rolling_mean("trip_count", 7, "pickup_date"), 0)
    return by_date.select(
        *(name for name in shown if name in by_date.columns), rolling.alias("rolling_7d_avg")
    )


def borough_demand_breakdown(by_borough: DataFrame) -> DataFrame:
    """Trips, revenue and share of trips per pickup borough."""
    measures = (
        total("total_trips", "trip_count"),
        total("total_revenue", "total_revenue"),
        mean("avg_fare", "avg_fare"),
    )
    boroughs = rollup(by_borough, ("pickup_borough",), measures)
    return boroughs.withColumn("trip_share_pct", share_of_total("total_trips"))


def monthly_totals(by_date: DataFrame) -> DataFrame:
    measures = (
        total("monthly_trips", "trip_count"),
        total("monthly_revenue", "total_revenue"),
        mean("avg_fare", "avg_fare"),
    )
    return rollup(by_date, MONTH, measures)


def mom_trip_volume(by_date: DataFrame) -> DataFrame:
    """Trips and revenue per month with the change from the month before."""
    return (
        monthly_totals(by_date)
        .drop("avg_fare")
        .withColumn("prev_month_trips", rows_back("monthly_trips", 1, *MONTH))
        .withColumn("mom_change_pct", change_since("monthly_trips", F.col("prev_month_trips")))
    )
