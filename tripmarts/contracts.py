"""One declarative contract per trip kind.

A contract says which raw columns a kind delivers, what they are called and typed from
Bronze on, which of them a trip cannot do without, and which quality rules apply. Everything
that differs between kinds is stated here, so the operators hold no per-kind branches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw column, column from Bronze on, type.
_YELLOW = """
VendorID                vendor_id               int
tpep_pickup_datetime    pickup_datetime         timestamp
tpep_dropoff_datetime   dropoff_datetime        timestamp
passenger_count         passenger_count         double
trip_distance           trip_distance           double
RatecodeID              rate_code_id            double
store_and_fwd_flag      store_and_fwd_flag      string
PULocationID            pu_location_id          int
DOLocationID            do_location_id          int
payment_type            payment_type            bigint
fare_amount             fare_amount             double
extra                   extra                   double
mta_tax                 mta_tax                 double
tip_amount              tip_amount              double
tolls_amount            tolls_amount            double
improvement_surcharge   improvement_surcharge   double
total_amount            total_amount            double
congestion_surcharge    congestion_surcharge    double
airport_fee             airport_fee             double
"""

_GREEN = """
VendorID                vendor_id               int
lpep_pickup_datetime    pickup_datetime         timestamp
lpep_dropoff_datetime   dropoff_datetime        timestamp
store_and_fwd_flag      store_and_fwd_flag      string
RatecodeID              rate_code_id            double
PULocationID            pu_location_id          int
DOLocationID            do_location_id          int
passenger_count         passenger_count         double
trip_distance           trip_distance           double
fare_amount             fare_amount             double
extra                   extra                   double
mta_tax                 mta_tax                 double
tip_amount              tip_amount              double
tolls_amount            tolls_amount            double
ehail_fee               ehail_fee               double
improvement_surcharge   improvement_surcharge   double
total_amount            total_amount            double
payment_type            payment_type            bigint
trip_type               trip_type               double
congestion_surcharge    congestion_surcharge    double
"""

_FHV = """
dispatching_base_num    dispatching_base_num    string
pickup_datetime         pickup_datetime         timestamp
dropOff_datetime        dropoff_datetime        timestamp
PUlocationID            pu_location_id          int
DOlocationID            do_location_id          int
SR_Flag                 sr_flag                 int
Affiliated_base_number  affiliated_base_number  string
"""

_FHVHV = """
hvfhs_license_num       hvfhs_license_num       string
dispatching_base_num    dispatching_base_num    string
originating_base_num    originating_base_num    string
request_datetime        request_datetime        timestamp
on_scene_datetime       on_scene_datetime       timestamp
pickup_datetime         pickup_datetime         timestamp
dropoff_datetime        dropoff_datetime        timestamp
PULocationID            pu_location_id          int
DOLocationID            do_location_id          int
trip_miles              trip_distance           double
trip_time               trip_time               bigint
base_passenger_fare     fare_amount             double
tolls                   tolls                   double
bcf                     bcf                     double
sales_tax               sales_tax               double
congestion_surcharge    congestion_surcharge    double
airport_fee             airport_fee             double
tips                    tip_amount              double
driver_pay              driver_pay              double
shared_request_flag     shared_request_flag     string
shared_match_flag       shared_match_flag       string
access_a_ride_flag      access_a_ride_flag      string
wav_request_flag        wav_request_flag        string
wav_match_flag          wav_match_flag          string
"""


class BrokenContract(ValueError):
    """A file that lacks a required column, or delivers a column as another kind of value."""


# What a column of a type may be delivered as; strings may come from anything.
_FAMILIES = {
    "int": T.NumericType,
    "bigint": T.NumericType,
    "double": T.NumericType,
    "timestamp": (T.TimestampType, T.TimestampNTZType),
}


@dataclass(frozen=True)
class Field:
    raw: str
    name: str
    type: str

    def accepts(self, delivered: T.DataType) -> bool:
        """A column that is null throughout may have no type of its own."""
        family = _FAMILIES.get(self.type)
        return family is None or isinstance(delivered, (T.NullType, *(family if isinstance(family, tuple) else (family,))))


    def holds(self, delivered: T.DataType) -> bool:
        """Whether every value of that type has one in this type."""
        whole = {"int": (T.ByteType, T.ShortType, T.IntegerType), "bigint": (T.ByteType, T.ShortType, T.IntegerType, T.LongType)}
        return self.type not in whole or isinstance(delivered, (T.NullType, *whole[self.type]))


@dataclass(frozen=True)
class Contract:
    kind: str
    fields: tuple[Field, ...]
    required: tuple[str, ...]
    rules: tuple[str, ...]

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields)

    @property
    def has_payments(self) -> bool:
        return "payment_type" in self.columns

    def enforce(self, raw: DataFrame, renamed: bool = False) -> list[str]:
        """Select expressions for the contract's columns in its types.

        Refuses files that lack a required column or deliver a column as another kind of value
        (a text for a number). An optional column that the file lacks is a typed null, and so is
        a single number out of range, which should not fail a whole month: `altered` counts those.
        """
        delivered = self.delivered(raw)
        projection = []
        for f in self.fields:
            found = delivered.get(f.raw)
            source = f"`{found}`" if found else "NULL"
            name = f.name if renamed else f.raw
            projection.append(f"try_cast({source} AS {f.type}) AS `{name}`")
        return projection

    def delivered(self, raw: DataFrame) -> dict[str, str]:
        """The file's name of each column it has, whatever its letters' case."""
        names = {field.name.lower(): field for field in raw.schema.fields}
        found = {f.raw: names[f.raw.lower()] for f in self.fields if f.raw.lower() in names}
        lacking = [f.raw for f in self.fields if f.name in self.required and f.raw not in found]
        wrong = [
            f"{f.raw} is {found[f.raw].dataType.simpleString()}, not {f.type}"
            for f in self.fields
            if f.raw in found and not f.accepts(found[f.raw].dataType)
        ]
        if lacking or wrong:
            said = [f"no column {name}" for name in lacking] + wrong
            raise BrokenContract(f"{self.kind} trips: {'; '.join(said)}")
        return {raw_name: field.name for raw_name, field in found.items()}

    def names_delivered(self, raw: DataFrame) -> list[str]:
        found = self.delivered(raw)
        return [f.name for f in self.fields if f.raw in found]

    def altered(self, raw: DataFrame) -> list[Column]:
        """For each column whose type may not hold a delivered value: how many become null, and how many lose a fraction."""
        delivered = self.delivered(raw)
        counts = []
        for f in self.fields:
            name = delivered.get(f.raw)
            if name is None or f.holds(raw.schema[name].dataType):
                continue
            value, cast = F.col(f"`{name}`"), F.expr(f"try_cast(`{name}` AS {f.type})")
            counts.append(
                F.struct(F.count_if(value.isNotNull() & cast.isNull()).alias("nulled"), F.count_if(cast != value).alias("cut"))
                .alias(f.name)
            )
        return counts


def _contract(kind: str, table: str, required: str, rules: str) -> Contract:
    fields = tuple(Field(*line.split()) for line in table.strip().splitlines())
    return Contract(kind, fields, tuple(required.split()), tuple(rules.split()))


_TIMES = "pickup_datetime dropoff_datetime"
_METERED = f"{_TIMES} pu_location_id do_location_id fare_amount trip_distance"

CONTRACTS: dict[str, Contract] = {
    c.kind: c
    for c in (
        _contract("yellow", _YELLOW, _METERED, "distance fare duration passengers"),
        _contract("green", _GREEN, _METERED, "distance fare duration passengers"),
        _contract("fhv", _FHV, _TIMES, ""),
        _contract("fhvhv", _FHVHV, _TIMES, "distance fare duration"),
    )
}

KINDS = tuple(CONTRACTS)


def contract_for(kind: str) -> Contract:
    try:
        return CONTRACTS[kind]
    except KeyError:
        raise ValueError(f"unknown trip kind {kind!r}; choose from {', '.join(KINDS)}") from None
