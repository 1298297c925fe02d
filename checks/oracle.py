"""Plain SQL for every registered query, written from the definitions and not from the Spark
code: real joins where the library avoids them, `quantile_disc` where it refines histograms."""

from __future__ import annotations

from checks.rounding import DIGITS

_TRIPS = """
WITH priced AS (
    SELECT *, CAST(floor(l_extendedprice * l_quantity / 10000) AS DOUBLE) - 2 AS fare
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), trips AS (
    SELECT
        o_orderdate + to_seconds(l_orderkey * 7919 % 86400) AS pickup,
        o_orderdate + to_seconds(
            l_orderkey * 7919 % 86400 + CAST((l_quantity - 1) * 900 AS BIGINT)) AS dropoff,
        CAST(l_linenumber % 2 + 1 AS INTEGER) AS vendor_id,
        CAST(l_linenumber AS DOUBLE) AS rate_code_id,
        l_returnflag AS store_and_fwd_flag,
        l_tax AS mta_tax,
        CAST(l_suppkey % 7 AS DOUBLE) AS passenger_count,
        CAST(l_partkey * 13 % 2500 AS DOUBLE) / 10 AS trip_distance,
        CAST(nullif(o_custkey % 28, 27) AS INTEGER) AS pu_location_id,
        CAST(l_suppkey % 27 AS INTEGER) AS do_location_id,
        CAST(l_linenumber AS BIGINT) AS payment_type,
        fare AS fare_amount,
        fare * l_discount * 3 AS tip_amount,
        fare * (1 + l_discount * 3) + 2.5 AS total_amount
    FROM priced
), zones AS (
    SELECT n_nationkey AS location_id, n_name AS zone, r_name AS borough
    FROM nation JOIN region ON n_regionkey = r_regionkey
), timed AS (
    SELECT *,
        timezone('America/New_York', timezone('UTC', pickup)) AS local,
        CAST(year(pickup) AS INTEGER) AS year,
        CAST(month(pickup) AS INTEGER) AS month
    FROM trips
), enriched AS (
    SELECT t.*,
        CAST(local AS DATE) AS pickup_date,
        CAST(year(local) AS INTEGER) AS pickup_year,
        CAST(month(local) AS INTEGER) AS pickup_month,
        CAST(hour(local) AS INTEGER) AS pickup_hour,
        CAST(dayofweek(local) + 1 AS INTEGER) AS pickup_day_of_week,
        dayofweek(local) IN (0, 6) AS is_weekend,
        date_diff('second', pickup, dropoff) / 60 AS trip_duration_mins,
        pu_location_id IN (1, 13, 18) OR do_location_id IN (1, 13, 18) AS is_airport_trip,
        p.zone AS pickup_zone, p.borough AS pickup_borough,
        d.zone AS dropoff_zone, d.borough AS dropoff_borough
    FROM timed t
    LEFT JOIN zones p ON p.location_id = pu_location_id
    LEFT JOIN zones d ON d.location_id = do_location_id
), hailed AS (
    SELECT * FROM enriched WHERE pickup IS NOT NULL AND dropoff IS NOT NULL
), ranged AS (
    SELECT * FROM hailed
    WHERE trip_distance BETWEEN 0.01 AND 200
      AND fare_amount BETWEEN 0 AND 500
      AND date_diff('second', pickup, dropoff) BETWEEN 60 AND 43200
), silver AS (
    SELECT * FROM ranged
    WHERE passenger_count > 0
      AND pu_location_id IS NOT NULL AND do_location_id IS NOT NULL
), by_hour AS (
    SELECT pickup_year, pickup_month, pickup_hour, count(*) AS trip_count,
        avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance,
        sum(total_amount) AS total_revenue
    FROM silver GROUP BY ALL
), by_date AS (
    SELECT pickup_date, pickup_year, pickup_month, count(*) AS trip_count,
        sum(total_amount) AS total_revenue, avg(fare_amount) AS avg_fare,
        avg(trip_distance) AS avg_distance, avg(trip_duration_mins) AS avg_duration_mins
    FROM silver GROUP BY ALL
), by_borough AS (
    SELECT pickup_year, pickup_month, pickup_borough, count(*) AS trip_count,
        sum(total_amount) AS total_revenue, avg(fare_amount) AS avg_fare,
        avg(trip_distance) AS avg_distance
    FROM silver GROUP BY ALL
), labelled AS (
    SELECT *, CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash'
        WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown'
        WHEN 6 THEN 'Voided' END AS payment_label
    FROM silver
), fares AS (
    SELECT pickup_year, pickup_month, payment_label, count(*) AS trip_count,
        avg(fare_amount) AS avg_fare, avg(tip_amount) AS avg_tip,
        avg(tip_amount / nullif(fare_amount, 0)) * 100 AS avg_tip_pct,
        quantile_disc(fare_amount, 0.5) AS median_fare,
        quantile_disc(fare_amount, 0.95) AS p95_fare
    FROM labelled GROUP BY ALL
), months AS (
    SELECT pickup_year, pickup_month, CAST(sum(trip_count) AS BIGINT) AS monthly_trips,
        sum(total_revenue) AS monthly_revenue, avg(avg_fare) AS avg_fare
    FROM by_date GROUP BY ALL
)
"""

_DURATIONS = """
SELECT pickup_year, pickup_month, count(*) AS trip_count,
    avg(trip_duration_mins) AS avg_duration_mins,
    quantile_disc(trip_duration_mins, 0.25) AS p25_duration,
    quantile_disc(trip_duration_mins, 0.5) AS p50_duration,
    quantile_disc(trip_duration_mins, 0.75) AS p75_duration,
    quantile_disc(trip_duration_mins, 0.95) AS p95_duration
FROM {source} GROUP BY ALL
"""

_VOLUME = """
, pickups AS (
    SELECT pu_location_id AS location_id, pickup_zone AS zone, pickup_borough AS borough,
        count(*) AS pickup_count, {revenue} AS pickup_revenue
    FROM {source} GROUP BY 1, 2, 3
), dropoffs AS (
    SELECT do_location_id AS location_id, dropoff_zone AS zone, dropoff_borough AS borough,
        count(*) AS dropoff_count
    FROM {source} GROUP BY 1, 2, 3
)
SELECT location_id, zone, borough, pickup_count, pickup_revenue, dropoff_count,
    pickup_count - dropoff_count AS net_flow
FROM pickups FULL JOIN dropoffs USING (location_id, zone, borough)
"""

_NET_FLOW = """
, areas AS (
    SELECT DISTINCT pu_location_id AS location_id, pickup_zone AS zone, pickup_borough AS borough
    FROM {source}
), pickups AS (
    SELECT pu_location_id AS location_id, count(*) AS n FROM {source} GROUP BY 1
), dropoffs AS (
    SELECT do_location_id AS location_id, count(*) AS n FROM {source} GROUP BY 1
)
SELECT location_id, zone, borough, coalesce(p.n, 0) AS pickups, coalesce(d.n, 0) AS dropoffs,
    coalesce(p.n, 0) - coalesce(d.n, 0) AS net_flow
FROM areas LEFT JOIN pickups p USING (location_id) LEFT JOIN dropoffs d USING (location_id)
"""

_ANOMALIES = """
, fences AS (
    SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high
    FROM (SELECT quantile_disc(fare_amount, 0.25) AS q1, quantile_disc(fare_amount, 0.75) AS q3
          FROM {source})
)
SELECT pickup_year, pickup_month, count(*) AS total_trips,
    CAST(sum(CAST(fare_amount < low OR fare_amount > high AS INTEGER)) AS BIGINT) AS anomaly_count,
    round(sum(CAST(fare_amount < low OR fare_amount > high AS INTEGER)) / count(*) * 100, 2)
        AS anomaly_pct
FROM {source}, fences GROUP BY 1, 2
"""

_BRONZE = """
SELECT '{kind}' AS _trip_type, year, month, count(*) AS trip_count,
    CAST(sum(pu_location_id) AS BIGINT) AS sum_pu_location_id,
    CAST(sum(do_location_id) AS BIGINT) AS sum_do_location_id{sums}
FROM timed GROUP BY year, month
"""

_MONEY = ("trip_distance", "fare_amount", "tip_amount", "total_amount")


def _sums(*columns: str) -> str:
    return "".join(f", sum({column}) AS sum_{column}" for column in columns)


def _partials(*columns: str) -> str:
    return "".join(
        f", sum({c}) AS _sum_{c}, count({c}) AS _n_{c}" for c in sorted(columns)
    )


_BUCKETED = """
, bucketed AS (
    SELECT *, CASE WHEN trip_distance < 2 THEN '0-2 mi' WHEN trip_distance < 5 THEN '2-5 mi'
        WHEN trip_distance < 10 THEN '5-10 mi' WHEN trip_distance < 20 THEN '10-20 mi'
        ELSE '20+ mi' END AS distance_bucket
    FROM silver
)
"""

_BODIES = {
    "bronze_projection": f"""
        SELECT 'yellow' AS _trip_type, year, month, vendor_id, store_and_fwd_flag,
            count(*) AS trip_count, count(pu_location_id) AS with_pickup_location,
            CAST(0 AS BIGINT) AS with_airport_fee, sum(rate_code_id) AS sum_rate_code_id,
            sum(passenger_count) AS sum_passenger_count, sum(mta_tax) AS sum_mta_tax,
            CAST(sum(payment_type) AS BIGINT) AS sum_payment_type,
            CAST(sum(do_location_id) AS BIGINT) AS sum_do_location_id {_sums(*_MONEY)}
        FROM timed GROUP BY year, month, vendor_id, store_and_fwd_flag""",
    "bronze_green": _BRONZE.format(kind="green", sums=_sums(*_MONEY)),
    "bronze_fhv": _BRONZE.format(kind="fhv", sums=""),
    "bronze_fhvhv": _BRONZE.format(kind="fhvhv", sums=_sums(*_MONEY[:3])),
    "silver_null_drop": f"""
        SELECT year, month, count(*) AS trip_count {_sums(*_MONEY)} FROM timed
        WHERE pickup IS NOT NULL AND dropoff IS NOT NULL AND pu_location_id IS NOT NULL
          AND do_location_id IS NOT NULL AND fare_amount IS NOT NULL AND NOT isnan(fare_amount)
          AND trip_distance IS NOT NULL AND NOT isnan(trip_distance)
        GROUP BY year, month""",
    "silver_outlier_filter": f"""
        SELECT year, month, count(*) AS trip_count {_sums(*_MONEY, "passenger_count")}
        FROM ranged WHERE passenger_count > 0 GROUP BY year, month""",
    "silver_datetime": """
        SELECT pickup_date, pickup_year, pickup_month, pickup_day_of_week, is_weekend,
            pickup_hour, count(*) AS trip_count
        FROM enriched GROUP BY ALL""",
    "silver_zone_join": """
        SELECT pu_location_id, do_location_id, pickup_borough, pickup_zone, dropoff_borough,
            dropoff_zone, count(*) AS trip_count
        FROM enriched GROUP BY ALL""",
    "silver_duration_airport": """
        SELECT trip_duration_mins, is_airport_trip, count(*) AS trip_count
        FROM enriched GROUP BY ALL""",
    "silver_trips": """
        SELECT pickup_date, pickup_hour, is_weekend, pickup_zone, dropoff_zone, trip_distance,
            fare_amount, trip_duration_mins, is_airport_trip
        FROM silver""",
    "gold_trips_by_hour": "SELECT * FROM by_hour",
    "gold_trips_by_date": "SELECT * FROM by_date",
    "gold_trips_by_borough": "SELECT * FROM by_borough",
    "gold_fare_summary": "SELECT * FROM fares",
    "gold_trip_duration_summary": _DURATIONS.format(source="silver"),
    "slot_grain": f"""
        SELECT pickup_year, pickup_month, pickup_date, pickup_hour, pickup_borough,
            count(*) AS _trips
            {_partials("total_amount", "fare_amount", "trip_distance", "trip_duration_mins")}
        FROM silver GROUP BY ALL""",
    "edge_grain": f"""
        , paced AS (
            SELECT *, trip_distance > 0 AS _moved, fare_amount / trip_distance AS fare_per_mile
            FROM silver
        )
        SELECT pu_location_id, pickup_zone, pickup_borough, do_location_id, dropoff_zone,
            dropoff_borough, _moved, count(*) AS _trips
            {_partials(*_MONEY, "fare_per_mile")}
        FROM paced GROUP BY ALL""",
    "profile_grain": f"""
        {_BUCKETED}
        SELECT pickup_year, pickup_month, pickup_hour, is_weekend, is_airport_trip,
            distance_bucket, count(*) AS _trips {_partials(*_MONEY, "trip_duration_mins")}
        FROM bucketed GROUP BY ALL""",
    "hourly_demand_profile": """
        , hours AS (
            SELECT pickup_hour, avg(trip_count) AS avg_trips, avg(avg_fare) AS avg_fare
            FROM by_hour GROUP BY 1
        )
        SELECT *, round(avg_trips / (SELECT sum(avg_trips) FROM hours) * 100, 2)
            AS pct_of_daily_total
        FROM hours""",
    "daily_trip_trend": """
        SELECT pickup_date, trip_count, total_revenue, avg_fare,
            round(avg(trip_count) OVER (
                ORDER BY pickup_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 0)
            AS rolling_7d_avg
        FROM by_date""",
    "borough_demand_breakdown": """
        , boroughs AS (
            SELECT pickup_borough, CAST(sum(trip_count) AS BIGINT) AS total_trips,
                sum(total_revenue) AS total_revenue, avg(avg_fare) AS avg_fare
            FROM by_borough GROUP BY 1
        )
        SELECT *, round(total_trips / (SELECT CAST(sum(total_trips) AS BIGINT) FROM boroughs)
            * 100, 2) AS trip_share_pct
        FROM boroughs""",
    "mom_trip_volume": """
        , lagged AS (
            SELECT pickup_year, pickup_month, monthly_trips, monthly_revenue,
                lag(monthly_trips) OVER (ORDER BY pickup_year, pickup_month) AS prev_month_trips
            FROM months
        )
        SELECT *, round((monthly_trips - prev_month_trips) / nullif(prev_month_trips, 0) * 100, 2)
            AS mom_change_pct
        FROM lagged""",
    "fare_by_distance_bucket": f"""
        {_BUCKETED}
        SELECT distance_bucket, count(*) AS trip_count, avg(fare_amount) AS avg_fare,
            avg(tip_amount) AS avg_tip, avg(total_amount) AS avg_total,
            avg(trip_duration_mins) AS avg_duration_mins
        FROM bucketed GROUP BY 1""",
    "tip_percentage_distribution": """
        , tipped AS (
            SELECT CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 END AS tip_pct
            FROM silver WHERE payment_type = 1
        )
        SELECT CASE WHEN tip_pct IS NULL THEN 'no_tip' WHEN tip_pct = 0 THEN '0%'
                WHEN tip_pct < 10 THEN '1-10%' WHEN tip_pct < 15 THEN '10-15%'
                WHEN tip_pct < 20 THEN '15-20%' WHEN tip_pct < 25 THEN '20-25%'
                ELSE '25%+' END AS tip_pct_bucket,
            count(*) AS trip_count, avg(tip_pct) AS avg_tip_pct
        FROM tipped GROUP BY 1""",
    "payment_type_trend": """
        SELECT pickup_year, pickup_month, payment_label,
            CAST(sum(trip_count) AS BIGINT) AS trip_count
        FROM fares GROUP BY 1, 2, 3""",
    "top_revenue_zones": """
        SELECT pickup_zone, pickup_borough, count(*) AS trip_count,
            sum(total_amount) AS total_revenue, avg(fare_amount) AS avg_fare,
            avg(tip_amount) AS avg_tip
        FROM silver GROUP BY 1, 2
        ORDER BY total_revenue DESC NULLS LAST, pickup_zone NULLS LAST, pickup_borough NULLS LAST
        LIMIT 20""",
    "fare_anomaly_detection": _ANOMALIES.format(source="silver"),
    "top_corridors": """
        SELECT pickup_zone, dropoff_zone, pickup_borough, dropoff_borough,
            count(*) AS trip_count, avg(trip_distance) AS avg_distance,
            avg(fare_amount) AS avg_fare
        FROM silver GROUP BY 1, 2, 3, 4
        ORDER BY trip_count DESC, pickup_zone NULLS LAST, dropoff_zone NULLS LAST,
            pickup_borough NULLS LAST, dropoff_borough NULLS LAST
        LIMIT 25""",
    "airport_trip_share": """
        SELECT pickup_year, pickup_month, is_airport_trip, count(*) AS trip_count,
            avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance
        FROM silver GROUP BY 1, 2, 3""",
    "distance_distribution_by_borough": """
        SELECT pickup_borough, count(*) AS trip_count, avg(trip_distance) AS avg_distance,
            quantile_disc(trip_distance, 0.25) AS p25_distance,
            quantile_disc(trip_distance, 0.5) AS p50_distance,
            quantile_disc(trip_distance, 0.75) AS p75_distance,
            quantile_disc(trip_distance, 0.95) AS p95_distance
        FROM silver GROUP BY 1""",
    "busiest_pickup_zones": """
        SELECT pickup_zone, pickup_borough, count(*) AS trip_count, avg(fare_amount) AS avg_fare
        FROM silver GROUP BY 1, 2
        ORDER BY trip_count DESC, pickup_zone NULLS LAST, pickup_borough NULLS LAST LIMIT 30""",
    "hourly_pattern_by_day_type": """
        SELECT pickup_hour, is_weekend, count(*) AS trip_count,
            avg(trip_distance) AS avg_distance, avg(fare_amount) AS avg_fare
        FROM silver GROUP BY 1, 2""",
    "zone_trip_volume": _VOLUME.format(source="silver", revenue="sum(total_amount)"),
    "zone_revenue_per_mile": """
        SELECT pu_location_id, pickup_zone, pickup_borough, count(*) AS trip_count,
            avg(fare_amount / trip_distance) AS avg_fare_per_mile,
            avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance
        FROM silver WHERE trip_distance > 0 GROUP BY 1, 2, 3""",
    "inter_borough_flow": """
        SELECT pickup_borough, dropoff_borough, count(*) AS trip_count,
            avg(trip_distance) AS avg_distance, avg(fare_amount) AS avg_fare
        FROM silver GROUP BY 1, 2""",
    "zone_net_flow": _NET_FLOW.format(source="silver"),
    "monthly_volume_trend": """
        , lagged AS (
            SELECT *, lag(monthly_trips, 12) OVER w AS prev_year_trips,
                lag(monthly_revenue, 12) OVER w AS prev_year_revenue
            FROM months WINDOW w AS (ORDER BY pickup_year, pickup_month)
        )
        SELECT *,
            round((monthly_trips - prev_year_trips) / nullif(prev_year_trips, 0) * 100, 2)
                AS yoy_trips_change_pct,
            round((monthly_revenue - prev_year_revenue) / nullif(prev_year_revenue, 0) * 100, 2)
                AS yoy_revenue_change_pct
        FROM lagged""",
    "baseline_recovery": """
        , baseline AS (
            SELECT avg(monthly_trips) AS b FROM months
            WHERE pickup_year = 2000 AND pickup_month IN (1, 2)
        )
        SELECT pickup_year, pickup_month, monthly_trips,
            round(monthly_trips / nullif(b, 0) * 100, 2) AS pct_of_baseline,
            CASE WHEN coalesce(b, 0) = 0 THEN NULL
                WHEN pickup_year = 2000 AND pickup_month BETWEEN 3 AND 5 THEN 'Impact'
                WHEN pickup_year = 2000 AND pickup_month BETWEEN 6 AND 12 THEN 'Early recovery'
                WHEN pickup_year = 2001 THEN 'Recovery'
                WHEN pickup_year >= 2002 THEN 'Post-COVID'
                ELSE 'Pre-COVID' END AS covid_period
        FROM months, baseline""",
    "seasonal_index": """
        SELECT pickup_month, avg(monthly_trips) AS avg_monthly_trips,
            round(avg(monthly_trips) / (SELECT avg(monthly_trips) FROM months), 4)
                AS seasonal_index
        FROM months GROUP BY 1""",
    "fare_evolution_yoy": """
        , years AS (
            SELECT pickup_year, CAST(sum(trip_count) AS BIGINT) AS annual_trips,
                sum(total_revenue) AS annual_revenue, avg(avg_fare) AS avg_fare,
                avg(avg_distance) AS avg_distance
            FROM by_date GROUP BY 1
        ), lagged AS (
            SELECT *, lag(avg_fare) OVER (ORDER BY pickup_year) AS before FROM years
        )
        SELECT * EXCLUDE (before),
            round((avg_fare - before) / nullif(before, 0) * 100, 2) AS yoy_fare_change_pct
        FROM lagged""",
    "green_fare_summary": "SELECT * FROM fares",
    "fhv_trips_by_hour": """
        SELECT pickup_year, pickup_month, pickup_hour, count(*) AS trip_count
        FROM hailed GROUP BY 1, 2, 3""",
    "fhv_trip_duration_summary": _DURATIONS.format(source="hailed"),
    "fhv_zone_trip_volume": _VOLUME.format(source="hailed", revenue="CAST(NULL AS DOUBLE)"),
    "fhv_zone_net_flow": _NET_FLOW.format(source="hailed"),
    "fhvhv_trips_by_date": """
        SELECT pickup_date, pickup_year, pickup_month, count(*) AS trip_count,
            avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance,
            avg(trip_duration_mins) AS avg_duration_mins
        FROM ranged GROUP BY 1, 2, 3""",
    "fhvhv_monthly_volume_trend": """
        , days AS (
            SELECT pickup_date, pickup_year, pickup_month, count(*) AS n,
                avg(fare_amount) AS fare
            FROM ranged GROUP BY 1, 2, 3
        ), lagged AS (
            SELECT pickup_year, pickup_month, CAST(sum(n) AS BIGINT) AS monthly_trips,
                avg(fare) AS avg_fare,
                lag(CAST(sum(n) AS BIGINT), 12) OVER (ORDER BY pickup_year, pickup_month)
                    AS prev_year_trips
            FROM days GROUP BY 1, 2
        )
        SELECT *, round((monthly_trips - prev_year_trips) / nullif(prev_year_trips, 0) * 100, 2)
            AS yoy_trips_change_pct
        FROM lagged""",
    "fhvhv_fare_anomaly_detection": _ANOMALIES.format(source="ranged"),
}


def _without(columns: str, body: str) -> str:
    """For a kind whose trips lack what these columns measure."""
    return f"SELECT * EXCLUDE ({columns}) FROM ({body})"


_BODIES |= {
    "bronze_contract_audit": "SELECT year, month, count(*) AS trip_count, "
    + ", ".join(
        f"count(*) - count({source}) AS no_{name}"
        for name, source in {
            "pickup_datetime": "pickup", "dropoff_datetime": "dropoff",
            **{c: c for c in ("pu_location_id", "do_location_id", "fare_amount", "trip_distance")},
        }.items()
    )
    + " FROM timed GROUP BY year, month",
    "green_top_revenue_zones": _BODIES["top_revenue_zones"],
    "green_trip_duration_summary": _BODIES["gold_trip_duration_summary"],
    "green_tip_percentage_distribution": _BODIES["tip_percentage_distribution"],
    "fhv_top_corridors": _without("avg_distance, avg_fare", _BODIES["top_corridors"]),
    "fhv_busiest_pickup_zones": _without("avg_fare", _BODIES["busiest_pickup_zones"]),
    "fhv_inter_borough_flow": _without("avg_distance, avg_fare", _BODIES["inter_borough_flow"]),
    "fhvhv_hourly_demand_profile": _BODIES["hourly_demand_profile"],
    "fhvhv_mom_trip_volume": _BODIES["mom_trip_volume"].replace(" monthly_revenue,", ""),
    "fhvhv_top_corridors": _BODIES["top_corridors"],
    "fhvhv_zone_revenue_per_mile": _BODIES["zone_revenue_per_mile"],
    "fhvhv_seasonal_index": _BODIES["seasonal_index"],
    "fhvhv_distance_distribution_by_borough": _BODIES["distance_distribution_by_borough"],
    "early_baseline_recovery": _BODIES["baseline_recovery"]
    .replace("2002", "YEAR+2").replace("2001", "YEAR+1").replace("2000", "1999")
    .replace("YEAR+2", "2001").replace("YEAR+1", "2000"),
    "direct_trips_by_hour": _BODIES["gold_trips_by_hour"],
    "direct_trips_by_borough": _BODIES["gold_trips_by_borough"],
    "direct_top_revenue_zones": _BODIES["top_revenue_zones"],
    "direct_fare_by_distance_bucket": _BODIES["fare_by_distance_bucket"],
}


_PLACED = """
    SELECT pickup_year, pickup_month, CAST(row_number() OVER (
        PARTITION BY pickup_year, pickup_month ORDER BY {order}) AS INTEGER) AS position, {columns}
    FROM {mart}"""

_BODIES |= {
    "lake_ingested_months": "SELECT year, month, count(*) AS trip_count FROM timed GROUP BY ALL",
    "lake_raw_scan": """
        SELECT 'yellow_tripdata_' || strftime(pickup, '%Y-%m') AS source_file, count(*) AS trip_count,
            sum(fare_amount) AS sum_fare_amount, CAST(sum(pu_location_id) AS BIGINT) AS sum_pu_location_id,
            CAST(0 AS BIGINT) AS with_airport_fee
        FROM timed GROUP BY 1""",
    "lake_zone_lookup": "SELECT CAST(location_id AS INTEGER) AS location_id, borough, zone AS zone_name FROM zones",
    "lake_bronze": """
        SELECT 'yellow_tripdata_' || strftime(pickup, '%Y-%m') AS source_file, 'yellow' AS _trip_type, year, month,
            count(*) AS trip_count, count(*) AS with_time, sum(fare_amount) AS sum_fare_amount,
            sum(passenger_count) AS sum_passenger_count
        FROM timed GROUP BY 1, year, month""",
    "lake_audit": """
        SELECT unnest(['vendor_id', 'pickup_datetime', 'dropoff_datetime', 'passenger_count', 'trip_distance',
                'rate_code_id', 'store_and_fwd_flag', 'pu_location_id', 'do_location_id', 'payment_type',
                'fare_amount', 'mta_tax', 'tip_amount', 'total_amount']) AS column_name,
            files, CAST(0 AS BIGINT) AS nulled, CAST(0 AS BIGINT) AS cut
        FROM (SELECT count(DISTINCT year * 100 + month) AS files FROM timed)""",
    "lake_silver": """
        SELECT pickup_year, pickup_month, pickup_borough, is_airport_trip, count(*) AS trip_count,
            sum(fare_amount) AS sum_fare_amount, max(pickup_hour) AS last_hour
        FROM silver GROUP BY ALL""",
    "lake_silver_of_a_year": """
        SELECT pickup_year, pickup_month, count(*) AS trip_count FROM silver
        WHERE pickup_year = (SELECT max(year) - 1 FROM timed) GROUP BY ALL""",
    "lake_order_by_hour": _PLACED.format(mart="by_hour", order="pickup_hour", columns="pickup_hour, trip_count"),
    "lake_order_by_date": _PLACED.format(mart="by_date", order="pickup_date", columns="pickup_date, trip_count"),
    "lake_order_by_borough": _PLACED.format(
        mart="by_borough", order="trip_count DESC, pickup_borough NULLS FIRST", columns="pickup_borough, trip_count"
    ),
    "lake_mart_sizes": " UNION ALL ".join(
        f"SELECT '{mart}' AS mart, count(*) AS mart_rows, count(DISTINCT pickup_year * 100 + pickup_month) AS months, "
        f"CAST(sum(trip_count) AS BIGINT) AS trips FROM ({source})"
        for mart, source in {
            "trips_by_hour": "by_hour", "trips_by_date": "by_date", "trips_by_borough": "by_borough",
            "fare_summary": "fares", "trip_duration_summary": _DURATIONS.format(source="silver"),
        }.items()
    ),
    "lake_order_zone_net_flow": f"""
        SELECT row_number() OVER (ORDER BY net_flow DESC) AS position, net_flow
        FROM ({_NET_FLOW.replace(", areas", "WITH areas", 1).format(source="silver")})""",
    "lake_order_hourly_pattern": """
        SELECT row_number() OVER (ORDER BY is_weekend, pickup_hour) AS position, is_weekend, pickup_hour
        FROM (SELECT DISTINCT is_weekend, pickup_hour FROM silver)""",
    "lake_order_monthly_volume": """
        SELECT row_number() OVER (ORDER BY pickup_year, pickup_month) AS position, pickup_year, pickup_month FROM months""",
    "lake_tables": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS table_rows FROM ({source})"
        for name, source in {
            "silver": "SELECT * FROM silver", "trips_by_hour": "by_hour", "trips_by_date": "by_date",
            "trips_by_borough": "by_borough", "fare_summary": "fares",
            "trip_duration_summary": _DURATIONS.format(source="silver"),
            "inter_borough_flow_yellow": "SELECT DISTINCT pickup_borough, dropoff_borough FROM silver",
            "zone_net_flow_yellow": "SELECT DISTINCT pu_location_id, pickup_zone, pickup_borough FROM silver",
            "monthly_volume_trend_yellow": "months",
        }.items()
    ),
} | {
    f"stored_{name}": _BODIES[name]
    for name in (
        "fare_anomaly_detection", "top_corridors", "tip_percentage_distribution",
        "distance_distribution_by_borough", "hourly_pattern_by_day_type", "zone_trip_volume",
    )
}


def _trips_of(name: str) -> str:
    """The common part; other kinds have their own Silver, and one has distances in thousandths."""
    cleaned = _TRIPS[_TRIPS.index("), silver AS (") : _TRIPS.index("), by_hour AS (")]
    if name.startswith(("fhvhv_", "bronze_fhvhv")):
        tenths = "CAST(l_partkey * 13 % 2500 AS DOUBLE) / 10"
        fine = "CAST(l_partkey * 13 % 2500 * 100 + l_suppkey % 100 AS DOUBLE) / 1000"
        own = _TRIPS.replace(tenths, fine)
        return own.replace(cleaned, "), silver AS (SELECT * FROM ranged\n")
    if name.startswith("fhv_"):
        return _TRIPS.replace(cleaned, "), silver AS (SELECT * FROM hailed\n")
    return _TRIPS


def _steady(name: str, sql: str) -> str:
    rounded = [f"round({c}, {to}) AS {c}" for c, to in DIGITS.get(name, {}).items()]
    return f"SELECT * REPLACE ({', '.join(rounded)}) FROM ({sql})" if rounded else sql


def queries() -> dict[str, str]:
    return {name: _steady(name, _trips_of(name) + body) for name, body in _BODIES.items()}
