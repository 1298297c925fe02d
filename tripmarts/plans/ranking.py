"""Top-k with a defined order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top(groups: DataFrame, count: int, by: str, keys: Sequence[str]) -> DataFrame:
    """The `count` largest groups; equal ones in order of their keys, unknown keys last."""
    ties = [F.asc_nulls_last(key) for key in keys]
    return groups.orderBy(F.desc_nulls_last(by), *ties).limit(count)
