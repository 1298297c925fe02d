"""Values a deployment may want to change, gathered in small dataclasses."""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone trips are reported in, and the airport location ids.
LOCAL_ZONE = "America/New_York"
AIRPORT_IDS = (1, 132, 138)


@dataclass(frozen=True)
class Quality:
    """Inclusive limits a trip must meet to enter Silver."""

    # Fixed values.
    distance: tuple[float, float] = (0.01, 200.0)
    fare: tuple[float, float] = (0.0, 500.0)
    duration_secs: tuple[int, int] = (60, 43_200)
    passengers_above: int = 0


@dataclass(frozen=True)
class Refinement:
    """Everything Silver depends on besides the data."""

    quality: Quality = field(default_factory=Quality)
    local_zone: str = LOCAL_ZONE
    airport_ids: tuple[int, ...] = AIRPORT_IDS


@dataclass(frozen=True)
class MonthRange:
    """Calendar months from start to end, both included."""

    start_year: int
    start_month: int
    end_year: int
    end_month: int

    def __post_init__(self) -> None:
        for month in (self.start_month, self.end_month):
            if not 1 <= month <= 12:
                raise ValueError(f"month must be 1..12, got {month}")
        if self._first > self._last:
            raise ValueError(f"empty month range: {self}")

    @property
    def _first(self) -> int:
        return self.start_year * 12 + self.start_month - 1

    @property
    def _last(self) -> int:
        return self.end_year * 12 + self.end_month - 1

    def __iter__(self) -> Iterator[tuple[int, int]]:
        for ordinal in range(self._first, self._last + 1):
            yield ordinal // 12, ordinal % 12 + 1

    def widened(self, months: int = 1) -> MonthRange:
        first, last = self._first - months, self._last + months
        return MonthRange(first // 12, first % 12 + 1, last // 12, last % 12 + 1)

    def covers(self, year: str, month: str) -> Column:
        """Plain comparisons on the two columns, so that file listings prune on them."""
        y, m = F.col(year), F.col(month)
        not_before = (y > self.start_year) | ((y == self.start_year) & (m >= self.start_month))
        not_after = (y < self.end_year) | ((y == self.end_year) & (m <= self.end_month))
        return not_before & not_after


def default_months() -> MonthRange:
    env = os.environ.get
    return MonthRange(
        int(env("START_YEAR", "2022")),
        int(env("START_MONTH", "1")),
        int(env("END_YEAR", "2023")),
        int(env("END_MONTH", "12")),
    )
