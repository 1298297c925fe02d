"""Digits to which averages and sums of doubles are compared.

Adding doubles in another order changes their last bits, in either engine. Both sides are
therefore rounded: averages to nine digits, sums (whose true values have two) to six.
"""

from __future__ import annotations

_MEAN, _SUM = 9, 6

# Query, its averaged columns, its summed columns.
_COLUMNS = """
bronze_projection                 | | sum_mta_tax sum_trip_distance sum_fare_amount sum_tip_amount sum_total_amount
bronze_green                      | | sum_trip_distance sum_fare_amount sum_tip_amount sum_total_amount
bronze_fhvhv                      | | sum_trip_distance sum_fare_amount sum_tip_amount
silver_null_drop                  | | sum_trip_distance sum_fare_amount sum_tip_amount sum_total_amount
silver_outlier_filter             | | sum_trip_distance sum_fare_amount sum_tip_amount sum_total_amount
gold_trips_by_hour                | avg_fare avg_distance | total_revenue
gold_trips_by_date                | avg_fare avg_distance avg_duration_mins | total_revenue
gold_trips_by_borough             | avg_fare avg_distance | total_revenue
gold_fare_summary                 | avg_fare avg_tip avg_tip_pct |
gold_trip_duration_summary        | avg_duration_mins |
slot_grain                        | | _sum_total_amount _sum_fare_amount _sum_trip_distance _sum_trip_duration_mins
edge_grain                        | | _sum_total_amount _sum_fare_amount _sum_trip_distance _sum_tip_amount _sum_fare_per_mile
profile_grain                     | | _sum_total_amount _sum_fare_amount _sum_trip_distance _sum_tip_amount _sum_trip_duration_mins
hourly_demand_profile             | avg_trips avg_fare |
daily_trip_trend                  | avg_fare | total_revenue
borough_demand_breakdown          | avg_fare | total_revenue
mom_trip_volume                   | | monthly_revenue
fare_by_distance_bucket           | avg_fare avg_tip avg_total avg_duration_mins |
tip_percentage_distribution       | avg_tip_pct |
top_revenue_zones                 | avg_fare avg_tip | total_revenue
top_corridors                     | avg_fare avg_distance |
airport_trip_share                | avg_fare avg_distance |
distance_distribution_by_borough  | avg_distance |
busiest_pickup_zones              | avg_fare |
hourly_pattern_by_day_type        | avg_fare avg_distance |
zone_trip_volume                  | | pickup_revenue
zone_revenue_per_mile             | avg_fare_per_mile avg_fare avg_distance |
inter_borough_flow                | avg_fare avg_distance |
monthly_volume_trend              | avg_fare | monthly_revenue prev_year_revenue
seasonal_index                    | avg_monthly_trips |
fare_evolution_yoy                | avg_fare avg_distance | annual_revenue
green_fare_summary                | avg_fare avg_tip avg_tip_pct |
green_top_revenue_zones           | avg_fare avg_tip | total_revenue
fhv_trip_duration_summary         | avg_duration_mins |
fhvhv_trips_by_date               | avg_fare avg_distance avg_duration_mins |
fhvhv_monthly_volume_trend        | avg_fare |
green_trip_duration_summary       | avg_duration_mins |
green_tip_percentage_distribution | avg_tip_pct |
fhvhv_hourly_demand_profile       | avg_trips avg_fare |
fhvhv_top_corridors               | avg_fare avg_distance |
fhvhv_zone_revenue_per_mile       | avg_fare_per_mile avg_fare avg_distance |
fhvhv_seasonal_index              | avg_monthly_trips |
fhvhv_distance_distribution_by_borough | avg_distance |
direct_trips_by_hour              | avg_fare avg_distance | total_revenue
direct_trips_by_borough           | avg_fare avg_distance | total_revenue
direct_top_revenue_zones          | avg_fare avg_tip | total_revenue
direct_fare_by_distance_bucket    | avg_fare avg_tip avg_total avg_duration_mins |
stored_top_corridors              | avg_fare avg_distance |
stored_tip_percentage_distribution | avg_tip_pct |
stored_distance_distribution_by_borough | avg_distance |
stored_hourly_pattern_by_day_type | avg_fare avg_distance |
stored_zone_trip_volume           | | pickup_revenue
"""


def _parse(line: str) -> tuple[str, dict[str, int]]:
    name, means, sums = line.split("|")
    digits = {column: _MEAN for column in means.split()}
    return name.strip(), digits | {column: _SUM for column in sums.split()}


DIGITS: dict[str, dict[str, int]] = dict(map(_parse, _COLUMNS.strip().splitlines()))
