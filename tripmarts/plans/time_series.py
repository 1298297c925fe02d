"""How volumes and fares move over months and years. Inputs are the daily mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmarts.functions.labels import recovery_period
from tripmarts.functions.trends import change_since, everything, percent, rows_back
from tripmarts.operators.marts import MONTH
from tripmarts.operators.rollup import mean, rollup, total
from tripmarts.plans.demand import monthly_totals


def monthly_volume_trend(by_date: DataFrame) -> DataFrame:
    """Monthly trips and revenue against the row twelve months earlier."""
    trend = monthly_totals(by_date)
    for unit in ("trips", "revenue"):
        now, before = f"monthly_{unit}", f"prev_year_{unit}"
        if now in trend.columns:
            trend = trend.withColumn(before, rows_back(now, 12, *MONTH))
            trend = trend.withColumn(f"yoy_{unit}_change_pct", change_since(now, F.col(before)))
    return trend


def covid_impact_recovery(by_date: DataFrame, baseline_year: int = 2020) -> DataFrame:
    """Each month against the mean of January and February of the baseline year.

    Without such a baseline (or with one of zero) both added columns are null.
    """
    year, month = (F.col(name) for name in MONTH)
    in_baseline = (year == baseline_year) & month.isin(1, 2)
    baseline = F.avg(F.when(in_baseline, F.col("monthly_trips"))).over(everything())
    usable = F.col("_baseline") != 0
    return (
        rollup(by_date, MONTH, (total("monthly_trips", "trip_count"),))
        .withColumn("_baseline", baseline)
        .withColumns(
            {
                "pct_of_baseline": percent(F.col("monthly_trips"), F.col("_baseline")),
                "covid_period": F.when(usable, recovery_period(year, month, baseline_year)),
            }
        )
        .drop("_baseline")
    )


def seasonal_decomposition_proxy(by_date: DataFrame) -> DataFrame:
    """Mean trips per month of year, relative to the mean over all months."""
    monthly = rollup(by_date, MONTH, (total("monthly_trips", "trip_count"),))
    measured = monthly.withColumn("_grand_mean", F.avg("monthly_trips").over(everything()))
    index = F.try_divide("avg_monthly_trips", "_grand_mean")
    return (
        measured.groupBy("pickup_month")
        .agg(
            F.avg("monthly_trips").alias("avg_monthly_trips"),
            F.max("_grand_mean").alias("_grand_mean"),
        )
        .select("pickup_month", "avg_monthly_trips", F.round(index, 4).alias("seasonal_index"))
    )


def fare_evolution_yoy(by_date: DataFrame) -> DataFrame:
    """Annual trips and revenue, mean daily fare and distance, and the change in fare."""
    measures = (
        total("annual_trips", "trip_count"),
        total("annual_revenue", "total_revenue"),
        mean("avg_fare", "avg_fare"),
        mean("avg_distance", "avg_distance"),
    )
    annual = rollup(by_date, ("pickup_year",), measures)
    change = change_since("avg_fare", rows_back("avg_fare", 1, "pickup_year"))
    return annual.withColumn("yoy_fare_change_pct", change)
