"""Group-by over trips, or over an additive pre-aggregate ("grain") of them.

Counts, sums and means can be built up in two steps. A *grain* holds, per combination of
some keys, the number of trips and the sum and count of each measured column. Any roll-up to
fewer keys gives the same answer from the grain as from the trips, so a stage that needs
many roll-ups scans the trips once and serves the rest from a small table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRIPS = "_trips"


def _sum_name(column: str) -> str:
    return f"_sum_{column}"


def _count_name(column: str) -> str:
    return f"_n_{column}"


@dataclass(frozen=True)
class Measure:
    """A named aggregate; without a column it counts rows."""

    name: str
    column: str | None = None
    mean: bool = False
    scale: int = 1

    def exists_in(self, rows: DataFrame, grain: bool) -> bool:
        if self.column is None:
            return True
        return (_sum_name(self.column) if grain else self.column) in rows.columns

    def of_trips(self) -> Column:
        if self.column is None:
            return F.count("*")
        return self._scaled(F.avg(self.column) if self.mean else F.sum(self.column))

    def of_grain(self) -> Column:
        if self.column is None:
            return F.sum(TRIPS)
        total = F.sum(_sum_name(self.column))
        if self.mean:
            total = F.try_divide(total, F.sum(_count_name(self.column)))
        return self._scaled(total)

    def _scaled(self, value: Column) -> Column:
        return value if self.scale == 1 else value * self.scale


def trips_as(name: str) -> Measure:
    return Measure(name)


def total(name: str, column: str) -> Measure:
    return Measure(name, column)


def mean(name: str, column: str, scale: int = 1) -> Measure:
    return Measure(name, column, mean=True, scale=scale)


def is_grain(rows: DataFrame) -> bool:
    return TRIPS in rows.columns


def aggregates(rows: DataFrame, measures: Iterable[Measure]) -> list[Column]:
    """Columns for `agg`. A measure of a column this kind of trip lacks is left out."""
    grain = is_grain(rows)
    usable = [m for m in measures if m.exists_in(rows, grain)]
    return [(m.of_grain() if grain else m.of_trips()).alias(m.name) for m in usable]


def rollup(rows: DataFrame, keys: Sequence[str], measures: Iterable[Measure]) -> DataFrame:
    return rows.groupBy(*keys).agg(*aggregates(rows, measures))


def partials(rows: DataFrame, columns: Iterable[str]) -> list[Column]:
    """Additive state of trips: how many, and sum and count of each column they have."""
    state = [F.count("*").alias(TRIPS)]
    for column in sorted(set(columns) & set(rows.columns)):
        state.append(F.sum(column).alias(_sum_name(column)))
        state.append(F.count(column).alias(_count_name(column)))
    return state


def grain(trips: DataFrame, keys: Sequence[str], columns: Iterable[str]) -> DataFrame:
    """Pre-aggregate trips; keys this kind of trip lacks are left out."""
    held = [key for key in keys if key in trips.columns]
    return trips.groupBy(*held).agg(*partials(trips, columns))
