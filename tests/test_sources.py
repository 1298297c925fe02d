from __future__ import annotations

import pytest
from conftest import ZONE_ROWS, YELLOW, raw_frame
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tripmarts.settings import MonthRange
from tripmarts.sources import zones as zone_source
from tripmarts.sources.raw import month_path, month_paths, read_trip_data, scan_groups
from tripmarts.sources.zones import load_zone_lookup


def test_month_paths():
    assert month_paths("s3a://raw/", "green", MonthRange(2021, 12, 2022, 1)) == [
        "s3a://raw/green/green_tripdata_2021-12.parquet",
        "s3a://raw/green/green_tripdata_2022-01.parquet",
    ]


def write_month(frame, root, kind, year, month):
    frame.coalesce(1).write.mode("overwrite").parquet(month_path(str(root), kind, year, month))


def test_rows_carry_their_file(spark, tmp_path):
    write_month(raw_frame(spark, "yellow", YELLOW), tmp_path, "yellow", 2022, 3)
    rows = read_trip_data(spark, str(tmp_path), "yellow", MonthRange(2022, 3, 2022, 3))
    assert rows.count() == 4
    files = {r._source_file for r in rows.select("_source_file").collect()}
    assert len(files) == 1 and "yellow_tripdata_2022-03.parquet" in files.pop()
    assert len(rows.columns) == 19 + 1


def test_months_with_different_physical_types_read_together(spark, tmp_path):
    frame = raw_frame(spark, "yellow", YELLOW)
    write_month(frame, tmp_path, "yellow", 2022, 3)
    drifted = frame.withColumns(
        {
            "PULocationID": F.col("PULocationID").cast("bigint"),
            "passenger_count": F.col("passenger_count").cast("bigint"),
            "tpep_pickup_datetime": F.col("tpep_pickup_datetime").cast("timestamp_ntz"),
        }
    ).drop("tip_amount")
    write_month(drifted, tmp_path, "yellow", 2022, 4)
    rows = read_trip_data(spark, str(tmp_path), "yellow", MonthRange(2022, 3, 2022, 4))
    assert rows.count() == 8
    assert rows.filter("tip_amount IS NULL").count() == 4
    starts = rows.groupBy("tpep_pickup_datetime").count().collect()
    assert [r["count"] for r in starts] == [2, 2, 2, 2]


def test_missing_month_fails_unless_skipped(spark, tmp_path):
    write_month(raw_frame(spark, "yellow", YELLOW), tmp_path, "yellow", 2022, 3)
    months = MonthRange(2022, 2, 2022, 3)
    with pytest.raises(AnalysisException):
        read_trip_data(spark, str(tmp_path), "yellow", months)
    assert read_trip_data(spark, str(tmp_path), "yellow", months, skip_missing=True).count() == 4
    with pytest.raises(FileNotFoundError):
        nothing = MonthRange(2020, 1, 2020, 2)
        read_trip_data(spark, str(tmp_path), "yellow", nothing, skip_missing=True)


def test_unknown_kind_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        read_trip_data(spark, str(tmp_path), "tram", MonthRange(2022, 1, 2022, 1))


def test_raw_scan_reads_only_what_is_used(spark, tmp_path):
    write_month(raw_frame(spark, "yellow", YELLOW), tmp_path, "yellow", 2022, 3)
    rows = read_trip_data(spark, str(tmp_path), "yellow", MonthRange(2022, 3, 2022, 3))
    plan = rows.filter("fare_amount >= 0").select("fare_amount")._jdf.queryExecution().toString()
    read = plan.split("ReadSchema: ")[-1]
    assert "fare_amount:double" in read and "LocationID" not in read
    assert "GreaterThanOrEqual(fare_amount,0.0)" in plan


def write_lookup(path, rows):
    lines = ['"LocationID","Borough","Zone","service_zone"']
    lines += [f'{key},"{borough}","{zone}","{service}"' for key, borough, zone, service in rows]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_zone_lookup(spark, tmp_path):
    zones = load_zone_lookup(spark, write_lookup(tmp_path / "zones.csv", ZONE_ROWS))
    assert zones.few
    assert dict(zones.rows.dtypes)["location_id"] == "int"
    assert {tuple(r) for r in zones.rows.collect()} == set(ZONE_ROWS)


def test_repeated_zone_ids_are_refused(spark, tmp_path):
    path = write_lookup(tmp_path / "zones.csv", [*ZONE_ROWS, ZONE_ROWS[0]])
    with pytest.raises(ValueError, match="not unique"):
        load_zone_lookup(spark, path)


def test_a_large_dimension_is_not_hinted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(zone_source, "BROADCAST_ROWS", 3)
    assert not load_zone_lookup(spark, write_lookup(tmp_path / "zones.csv", ZONE_ROWS)).few


def test_the_month_is_that_of_the_file_and_not_of_a_folder_above(spark, tmp_path):
    root = tmp_path / "yellow_tripdata_2020-01.parquet" / "yellow" / "yellow_tripdata_2021-02.parquet"
    months = MonthRange(2022, 3, 2022, 4)
    for year, month in months:
        write_month(raw_frame(spark, "yellow", YELLOW[:month]), root, "yellow", year, month)
    groups = scan_groups(spark, str(root), "yellow", months)
    found = [tuple(r) for group in groups for r in group.rows().groupBy("source_month").count().collect()]
    assert sorted(found) == [(202203, 3), (202204, 4)]


def test_the_month_of_a_row_takes_no_regular_expression(spark, tmp_path):
    write_month(raw_frame(spark, "yellow", YELLOW), tmp_path, "yellow", 2022, 3)
    (group,) = scan_groups(spark, str(tmp_path), "yellow", MonthRange(2022, 3, 2022, 3))
    assert "regexp" not in group.rows()._jdf.queryExecution().executedPlan().toString()
