"""Windows over summaries.

None of these windows is partitioned, so its input passes through one task. That is sound
only because the rows are calendar slots or areas of an aggregate (hours, days, months,
boroughs): their number depends on the calendar and the map, never on the trips.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def everything() -> WindowSpec:
    return Window.partitionBy()


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole) * 100, 2)


def share_of_total(value: str) -> Column:
    return percent(F.col(value), F.sum(value).over(everything()))


def rows_back(value: str, rows: int, *order: str) -> Column:
    """The value `rows` rows earlier: a row offset, not a calendar offset."""
    return F.lag(value, rows).over(everything().orderBy(*order))


def change_since(value: str, earlier: Column) -> Column:
    return percent(F.col(value) - earlier, earlier)


def rolling_mean(value: str, rows: int, *order: str) -> Column:
    """Mean over this row and the `rows - 1` rows before it."""
    return F.avg(value).over(everything().orderBy(*order).rowsBetween(1 - rows, Window.currentRow))
