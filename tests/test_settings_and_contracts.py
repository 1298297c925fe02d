from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tripmarts.contracts import CONTRACTS, KINDS, BrokenContract, contract_for
from tripmarts.settings import MonthRange


def test_start_and_end_months_apply_to_their_years_only():
    months = list(MonthRange(2021, 11, 2023, 2))
    assert months[:3] == [(2021, 11), (2021, 12), (2022, 1)]
    assert months[-1] == (2023, 2)
    assert len(months) == 2 + 12 + 2


@pytest.mark.parametrize("bad", [(2022, 0, 2022, 3), (2022, 1, 2022, 13), (2022, 5, 2022, 4)])
def test_impossible_ranges_are_refused(bad):
    with pytest.raises(ValueError):
        MonthRange(*bad)


def test_widened_crosses_years():
    assert list(MonthRange(2022, 1, 2022, 12).widened())[0] == (2021, 12)
    assert list(MonthRange(2022, 1, 2022, 12).widened())[-1] == (2023, 1)


def test_covers_agrees_with_iteration(spark):
    months = MonthRange(2021, 11, 2022, 2)
    every = spark.range(2020 * 12, 2024 * 12).select(
        (F.col("id") / 12).cast("int").alias("y"), (F.col("id") % 12 + 1).cast("int").alias("m")
    )
    kept = {(r.y, r.m) for r in every.filter(months.covers("y", "m")).collect()}
    assert kept == set(months)


def test_field_counts():
    assert {kind: len(CONTRACTS[kind].fields) for kind in KINDS} == {
        "yellow": 19,
        "green": 20,
        "fhv": 7,
        "fhvhv": 24,
    }


def test_every_kind_knows_where_and_when():
    for contract in CONTRACTS.values():
        assert {"pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id"} <= set(
            contract.columns
        )
        assert set(contract.required) <= set(contract.columns)


def test_unknown_kind():
    with pytest.raises(ValueError, match="rickshaw"):
        contract_for("rickshaw")


REQUIRED = "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp_ntz, dolocationid int, fare_amount int, trip_distance float"


def test_enforce_fills_and_types(spark):
    row = (None, None, 7, 1, 2.0, 5, "x", None)
    schema = f"{REQUIRED}, pulocationid bigint, unexpected string, ratecodeid void"
    raw = spark.createDataFrame([row], schema)
    rows = raw.selectExpr(*CONTRACTS["yellow"].enforce(raw))
    assert rows.columns == [f.raw for f in CONTRACTS["yellow"].fields]
    assert dict(rows.dtypes)["PULocationID"] == "int"
    assert dict(rows.dtypes)["airport_fee"] == "double"
    only = rows.first()
    assert only["PULocationID"] == 5 and only["airport_fee"] is None


def test_a_number_out_of_range_becomes_null(spark):
    schema = "PUlocationID double, pickup_datetime timestamp, dropOff_datetime timestamp"
    values = (1e12, 7.0, None, 1.75, float("nan"))
    raw = spark.createDataFrame([(v, None, None) for v in values], schema)
    rows = raw.selectExpr(*CONTRACTS["fhv"].enforce(raw))
    assert [r["PUlocationID"] for r in rows.collect()] == [None, 7, None, 1, None]
    altered = raw.agg(*CONTRACTS["fhv"].altered(raw)).first().asDict()
    assert {name: tuple(counts) for name, counts in altered.items()} == {"pu_location_id": (2, 1)}
    assert CONTRACTS["fhv"].names_delivered(raw) == ["pickup_datetime", "dropoff_datetime", "pu_location_id"]


def test_broken_files_are_refused(spark):
    """A renamed or retyped required column, or an optional one of another kind of value."""
    good = f"{REQUIRED}, PULocationID int"
    contract = CONTRACTS["yellow"]
    contract.enforce(spark.createDataFrame([], good))
    for broken, said in (
        (good.replace("fare_amount", "fare"), "no column fare_amount"),
        (good.replace("trip_distance float", "trip_distance string"), "trip_distance is string, not double"),
        (good.replace("tpep_pickup_datetime timestamp", "tpep_pickup_datetime bigint"), "tpep_pickup_datetime is bigint"),
        (f"{good}, tip_amount string", "tip_amount is string"),
    ):
        with pytest.raises(BrokenContract, match=said):
            contract.enforce(spark.createDataFrame([], broken))
