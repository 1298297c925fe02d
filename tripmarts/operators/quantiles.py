"""Discrete quantiles, exact for any values, by a range partition.

Merging quantile sketches sends one sketch per map task and group to a single reducer, which
on a very large input is slow exactly where a group is large, and gives an approximation. Here
trips are first counted per group and value, which combines on the map side and spreads even one
huge group over all reducers. One range shuffle puts the counts in order of group and value, and
each row is kept with the number of its partition. Partitions hold consecutive rows, so the trips of
the partitions before tell in which of them a wanted rank lies; only there are rows read again, and
counted up one by one. A group may span any number of partitions: no task holds more than one of them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmarts.operators.rollup import TRIPS, Measure, aggregates, grain, is_grain, partials, rollup
from tripmarts.sources.kept import kept

PART = "_part"
# Sub-groups in which the sketches of a group meet first.
SPREAD = 32
# What is asked of a group: a name, and the share as a fraction.
POINT = ("_point", "_whole", "_part_of_whole")


def in_order(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Counted rows in consecutive partitions by keys and value, with the number of the partition.

    To be kept before it is used: partition numbers mean something only for rows that are partitioned once.
    """
    rows = counts.sparkSession.conf
    partitions = int(rows.get("spark.sql.shuffle.partitions"))
    ranged = counts.repartitionByRange(partitions, *keys, value)
    return ranged.withColumn(PART, F.spark_partition_id())


def rollup_with_quantiles(
    trips: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Measure],
    value: str,
    points: Mapping[str, str],
    accuracy: int | None = None,
) -> DataFrame:
    """Measures and quantiles of `value` per group.

    `points` maps an output column to a share such as "0.95". The trips, or a grain of them that has the
    value among its keys, are read once: counts per value carry the partial sums of the measures. With
    `accuracy` the quantiles come from sketches whose ranks are off by 1 / accuracy at most, but for
    one case in a hundred. Nulls have no rank; a group of nulls alone has null quantiles.
    """
    if accuracy is not None:
        if is_grain(trips):
            raise ValueError("a sketch needs the trips themselves, not counts of them")
        return _by_sketches(trips, keys, measures, value, points, accuracy)

    ordered = kept(in_order(counted(trips, keys, value, measures), keys, value))
    found = quantiles_in_order(ordered, keys, value, points)
    if not keys and not measures:
        return found
    return _beside(rollup(ordered, keys, measures or (Measure(TRIPS),)), keys, found, drop=not measures)


def sketch_size(accuracy: int) -> int:
    """The size of a KLL sketch with a rank error of 1 / accuracy: fixed values of its published error curve."""
    return max(8, min(65_535, math.ceil((2.296 * accuracy) ** (1 / 0.9021))))


def sketches(trips: DataFrame, keys: Sequence[str], value: str, accuracy: int, measures: Sequence[Measure] = ()) -> DataFrame:
    """A mergeable sketch of the values per group (`_sketch`, null without values), beside partial sums of the measures.

    Map tasks make one sketch for each group. These meet in `SPREAD` sub-groups first, so no
    reducer merges those of all tasks, whatever the size of a group.
    """
    columns = {m.column for m in measures if m.column is not None}
    known = F.when(~F.isnan(value), F.col(value))
    sketch = F.kll_sketch_agg_double(known, F.lit(sketch_size(accuracy))).alias("_sketch")
    seen = F.count(known).alias("_known")
    part = F.pmod(F.spark_partition_id(), F.lit(SPREAD)).alias("_sub")
    first = trips.select("*", part).groupBy(*keys, "_sub").agg(sketch, seen, *partials(trips, columns))
    return merged_sketches(first, keys)


def merged_sketches(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of several parts of the trips, such as months, added up to those of fewer keys."""
    additive = [F.sum(c).alias(c) for c in parts.columns if c == TRIPS or c.startswith(("_sum_", "_n_", "_known"))]
    whole = F.kll_merge_agg_double("_sketch").alias("_sketch")
    return parts.groupBy(*keys).agg(whole, *additive)


def quantiles_of_sketches(merged: DataFrame, keys: Sequence[str], measures: Sequence[Measure], points: Mapping[str, str]) -> DataFrame:
    """Measures and approximate quantiles per group from merged sketches."""
    shares = [
        F.when(F.col("_known") > 0, F.kll_sketch_get_quantile_double("_sketch", F.lit(float(Fraction(share))))).alias(name)
        for name, share in points.items()
    ]
    named = [F.first(F.col(name)).alias(name) for name in points]
    return merged.select("*", *shares).groupBy(*keys).agg(*aggregates(merged, measures), *named)


def _by_sketches(trips, keys, measures, value, points, accuracy: int) -> DataFrame:
    return quantiles_of_sketches(sketches(trips, keys, value, accuracy, measures), keys, measures, points)


def counted(trips: DataFrame, keys: Sequence[str], value: str, measures: Sequence[Measure]) -> DataFrame:
    """Trips per group and value, with the partial sums of the measures."""
    columns = {m.column for m in measures if m.column is not None}
    if not is_grain(trips):
        return grain(trips, (*keys, value), columns)
    additive = [F.sum(c).alias(c) for c in trips.columns if c == TRIPS or c.startswith(("_sum_", "_n_"))]
    return trips.groupBy(*keys, value).agg(*additive)


def quantiles_in_order(
    ordered: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, str]
) -> DataFrame:
    """Quantiles per group of rows as `in_order` returns them; further columns may tell equal values apart.

    A group of nulls alone has no row. Without keys there is always one row.
    """
    known = ordered.filter(F.col(value).isNotNull())
    group = Window.partitionBy(*keys)
    before = group.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        known.groupBy(*keys, PART).agg(F.sum(TRIPS).alias("_n"))
        .withColumns({"_before": F.coalesce(F.sum("_n").over(before), F.lit(0)), "_size": F.sum("_n").over(group)})
    )
    # In whole numbers, so no rank is rounded: rank / size >= part / whole.
    wanted = (
        parts.select("*", F.explode(F.array(*[_point(n, share) for n, share in points.items()])).alias("_p"))
        .select(*keys, PART, "_n", "_before", "_p.*", (F.col("_size") * F.col("_p._part_of_whole")).alias("_needed"))
        .filter("(_before + _n) * _whole >= _needed AND _before * _whole < _needed")
        .select(
            *[F.col(k).alias(f"_of_{k}") for k in keys], F.col(PART).alias("_in"), "_point", "_whole",
            (F.col("_needed") - F.col("_before") * F.col("_whole")).alias("_left"),
        )
    )
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    near = known.select(*keys, PART, value, TRIPS).join(
        wanted, reduce(Column.__and__, same, F.col(PART) == F.col("_in"))
    )
    upwards = Window.partitionBy(*keys, PART, "_point").orderBy(value)
    running = F.sum(TRIPS).over(upwards.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    reached = near.withColumn("_upto", running).filter(
        f"_upto * _whole >= _left AND (_upto - {TRIPS}) * _whole < _left"
    )
    answers = [F.min(F.when(F.col("_point") == name, F.col(value))).alias(name) for name in points]
    return reached.groupBy(*keys).agg(*answers)


def _point(name: str, share: str) -> Column:
    part = Fraction(share)
    if not 0 < part <= 1:
        raise ValueError(f"a share must be above 0 and at most 1, not {share}")
    return F.struct(
        *[
            F.lit(value).cast(kind).alias(column)
            for value, kind, column in zip((name, part.denominator, part.numerator), ("string", "long", "long"), POINT)
        ]
    )


def _beside(measured: DataFrame, keys: Sequence[str], found: DataFrame, drop: bool) -> DataFrame:
    """Measures with the quantiles of their group, null for a group without values."""
    if drop:
        measured = measured.drop(TRIPS)
    if not keys:
        return measured.join(found, F.lit(True), "left")
    named = found.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return measured.join(named, reduce(Column.__and__, same), "left").drop(*[f"_of_{k}" for k in keys])
