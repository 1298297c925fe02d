"""The 22 summaries: what each is built from, called and ordered by."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmarts.contracts import CONTRACTS
from tripmarts.plans import demand, fare, geo, time_series, trip_patterns
from tripmarts.plans.grains import DISTANCES, EDGES, FARES, PROFILE, TIPS

MARTS = ("trips_by_hour", "trips_by_date", "trips_by_borough", "fare_summary")
DOMAINS = ("demand", "fare", "trip_patterns", "geo", "time_series")


@dataclass(frozen=True)
class Summary:
    domain: str
    build: Callable[..., DataFrame]
    source: str
    output: str
    order: tuple[str, ...]
    needs: tuple[str, ...] = ()
    params: dict[str, int] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return self.build.__name__

    def output_name(self, **params: int) -> str:
        return self.output.format(**{**self.params, **params})

    def supports(self, kind: str) -> bool:
        return set(self.needs) <= set(CONTRACTS[kind].columns)

    def sort_columns(self) -> tuple[Column, ...]:
        """`-name` sorts from large to small."""
        return tuple(
            F.desc_nulls_last(key[1:]) if key.startswith("-") else F.asc_nulls_first(key)
            for key in self.order
        )

    def ordered(self, rows: DataFrame) -> DataFrame:
        return rows.orderBy(*self.sort_columns())


def _summary(domain, build, source, output, order, needs="", **params) -> Summary:
    return Summary(domain, build, source, output, tuple(order.split()), tuple(needs.split()), params)


_MONTH = "pickup_year pickup_month"

SUMMARIES: dict[str, Summary] = {
    s.name: s
    for s in (
        _summary("demand", demand.hourly_demand_profile, "trips_by_hour",
                 "hourly_demand_profile", "pickup_hour"),
        _summary("demand", demand.daily_trip_trend, "trips_by_date",
                 "daily_trip_trend", "pickup_date"),
        _summary("demand", demand.borough_demand_breakdown, "trips_by_borough",
                 "borough_demand_breakdown", "-total_trips"),
        _summary("demand", demand.mom_trip_volume, "trips_by_date",
                 "mom_trip_volume", _MONTH),
        _summary("fare", fare.fare_by_distance_bucket, PROFILE,
                 "fare_by_distance_bucket", "distance_bucket", "trip_distance"),
        _summary("fare", fare.tip_percentage_distribution, TIPS,
                 "tip_pct_distribution", "avg_tip_pct", "payment_type tip_amount fare_amount"),
        _summary("fare", fare.payment_type_trend, "fare_summary",
                 "payment_type_trend", f"{_MONTH} payment_label", "payment_type"),
        _summary("fare", fare.top_revenue_zones, EDGES,
                 "top_{top_n}_revenue_zones", "-total_revenue", "total_amount", top_n=20),
        _summary("fare", fare.fare_anomaly_detection, FARES,
                 "fare_anomaly_by_month", _MONTH, "fare_amount"),
        _summary("trip_patterns", trip_patterns.top_corridors, EDGES,
                 "top_{top_n}_corridors", "-trip_count", top_n=25),
        _summary("trip_patterns", trip_patterns.airport_trip_share, PROFILE,
                 "airport_trip_share", f"{_MONTH} is_airport_trip"),
        _summary("trip_patterns", trip_patterns.distance_distribution_by_borough, DISTANCES,
                 "distance_distribution_by_borough", "-avg_distance", "trip_distance"),
        _summary("trip_patterns", trip_patterns.busiest_pickup_zones, EDGES,
                 "top_{top_n}_pickup_zones", "-trip_count", top_n=30),
        _summary("trip_patterns", trip_patterns.hourly_pattern_by_day_type, PROFILE,
                 "hourly_pattern_weekday_vs_weekend", "is_weekend pickup_hour"),
        _summary("geo", geo.zone_trip_volume, EDGES,
                 "zone_trip_volume", "-pickup_count"),
        _summary("geo", geo.zone_revenue_per_mile, EDGES,
                 "zone_revenue_per_mile", "-avg_fare_per_mile", "fare_amount trip_distance"),
        _summary("geo", geo.inter_borough_flow, EDGES,
                 "inter_borough_flow", "-trip_count"),
        _summary("geo", geo.zone_net_flow, EDGES,
                 "zone_net_flow", "-net_flow"),
        _summary("time_series", time_series.monthly_volume_trend, "trips_by_date",
                 "monthly_volume_trend", _MONTH),
        _summary("time_series", time_series.covid_impact_recovery, "trips_by_date",
                 "covid_impact_recovery", _MONTH),
        _summary("time_series", time_series.seasonal_decomposition_proxy, "trips_by_date",
                 "seasonal_index", "pickup_month"),
        _summary("time_series", time_series.fare_evolution_yoy, "trips_by_date",
                 "fare_evolution_yoy", "pickup_year", "fare_amount"),
    )
}
