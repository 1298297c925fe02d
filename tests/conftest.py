from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripmarts.contracts import CONTRACTS  # noqa: E402
from tripmarts.session import get_session  # noqa: E402
from tripmarts.sources.zones import Zones  # noqa: E402

ZONE_ROWS = [
    (1, "EWR", "Newark Airport", "EWR"),
    (41, "Manhattan", "Central Harlem", "Boro Zone"),
    (48, "Manhattan", "Clinton East", "Yellow Zone"),
    (74, "Manhattan", "East Harlem North", "Boro Zone"),
    (132, "Queens", "JFK Airport", "Airports"),
    (138, "Queens", "LaGuardia Airport", "Airports"),
    (161, "Manhattan", "Midtown Center", "Yellow Zone"),
    (236, "Manhattan", "Upper East Side North", "Yellow Zone"),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = get_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "5000",
            # Tables of a few rows: compiling each stage would take longer than running it.
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def zones(spark) -> Zones:
    columns = "location_id int, borough string, zone_name string, service_zone string"
    return Zones(spark.createDataFrame(ZONE_ROWS, columns), few=True)


def moment(text: str) -> datetime:
    return datetime.fromisoformat(text)


def trip(start: str | None = "2022-03-01 08:00", minutes: float | None = 20, **values) -> dict:
    """A plain metered trip under Bronze names, with the given values changed."""
    begin = moment(start) if start else None
    ordinary = {
        "pickup_datetime": begin,
        "dropoff_datetime": begin + timedelta(minutes=minutes) if begin and minutes is not None else None,
        "passenger_count": 1.0,
        "trip_distance": 3.5,
        "pu_location_id": 161,
        "do_location_id": 236,
        "payment_type": 1,
        "fare_amount": 14.0,
        "tip_amount": 3.0,
        "total_amount": 18.3,
    }
    return {**ordinary, **values}


# The golden trips: three good ones and a negative fare; two good ones.
YELLOW = [
    trip("2022-03-01 08:00", 20),
    trip("2022-03-01 09:00", 35, passenger_count=2.0, trip_distance=8.2, pu_location_id=132,
         do_location_id=48, fare_amount=28.0, tip_amount=5.0, total_amount=33.8),
    trip("2022-03-02 22:00", 10, trip_distance=1.1, pu_location_id=236, do_location_id=161,
         payment_type=2, fare_amount=7.5, tip_amount=0.0, total_amount=8.8),
    trip("2022-03-03 10:00", 15, trip_distance=2.0, pu_location_id=100, do_location_id=200,
         fare_amount=-5.0, tip_amount=0.0, total_amount=0.0),
]
GREEN = [
    trip("2022-04-01 07:00", 25, trip_distance=4.5, pu_location_id=74, do_location_id=41,
         fare_amount=15.0, tip_amount=2.5, total_amount=18.8),
    trip("2022-04-02 18:00", 40, passenger_count=2.0, trip_distance=9.3, pu_location_id=41,
         do_location_id=74, fare_amount=30.0, tip_amount=5.0, total_amount=36.8),
]


def raw_frame(spark: SparkSession, kind: str, rows: list[dict]):
    """Trips under the kind's raw names; what the kind does not record is dropped."""
    fields = [f for f in CONTRACTS[kind].fields if any(f.name in row for row in rows)]
    schema = ", ".join(f"`{f.raw}` {f.type}" for f in fields)
    return spark.createDataFrame([tuple(row.get(f.name) for f in fields) for row in rows], schema)


def as_dicts(frame) -> list[dict]:
    return [row.asDict() for row in frame.collect()]


def as_set(frame, digits: int = 9) -> set[tuple]:
    """Rows without order, doubles rounded, columns by name."""
    names = sorted(frame.columns)

    def plain(value):
        return round(value, digits) if isinstance(value, float) else value

    rows = [tuple(plain(row[name]) for name in names) for row in frame.collect()]
    assert len(rows) == len(set(rows)), "rows are expected to be distinct"
    return set(rows)
