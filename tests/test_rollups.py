"""Grains and quantiles against direct and brute-force results."""

from __future__ import annotations

import bisect
import math
import random
from fractions import Fraction

import pytest
from conftest import as_set
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmarts.operators import quantiles
from tripmarts.operators.quantiles import (
    in_order,
    merged_sketches,
    quantiles_in_order,
    quantiles_of_sketches,
    rollup_with_quantiles,
    sketches,
)
from tripmarts.operators.rollup import grain, mean, rollup, total, trips_as
from tripmarts.sources import kept as kept_rows
from tripmarts.sources.kept import keeping
from tripmarts.sources.kept import kept as held

MEASURES = (trips_as("n"), total("s", "x"), mean("m", "x"), mean("pct", "y", scale=100))


def random_rows(spark, count=400, seed=1):
    pick = random.Random(seed)
    rows = [
        (
            pick.choice(["a", "b", None]),
            pick.choice([1, 2]),
            pick.choice([None, 0.25, 1.5, -2.0]),
            None if pick.random() < 0.5 else pick.randrange(8) / 4,
        )
        for _ in range(count)
    ]
    return spark.createDataFrame(rows, "k string, h int, x double, y double")


@pytest.mark.parametrize("keys", [("k",), ("h",), ("k", "h"), ()])
def test_a_grain_answers_like_the_rows(spark, keys):
    rows = random_rows(spark)
    pre = grain(rows, ("k", "h"), ("x", "y"))
    assert as_set(rollup(pre, keys, MEASURES)) == as_set(rollup(rows, keys, MEASURES))


def test_a_group_without_values_has_no_mean(spark):
    rows = spark.createDataFrame([("a", None), ("b", 2.0)], "k string, x double")
    measures = trips_as("n"), total("s", "x"), mean("m", "x")
    expected = {(None, "a", 1, None), (2.0, "b", 1, 2.0)}
    found = rollup(grain(rows, ("k",), ("x",)), ("k",), measures)
    assert {(r.m, r.k, r.n, r.s) for r in found.collect()} == expected
    assert as_set(found) == as_set(rollup(rows, ("k",), measures))


def test_measures_of_absent_columns_are_left_out(spark):
    rows = random_rows(spark)
    asked = (trips_as("n"), mean("tip", "tip_amount"))
    assert rollup(rows, ("k",), asked).columns == ["k", "n"]
    assert rollup(grain(rows, ("k", "zone"), ("tip_amount",)), ("k",), asked).columns == ["k", "n"]


def discrete(values, share):
    """The smallest value that at least this share of the values does not exceed."""
    known = sorted(v for v in values if v is not None)
    if not known:
        return None
    return known[max(1, math.ceil(len(known) * Fraction(share))) - 1]


POINTS = {"low": "0.25", "mid": "0.5", "high": "0.95"}


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]),
        st.one_of(st.none(), st.integers(-500, 5000).map(lambda cents: cents / 100)),
    ),
    min_size=1,
    max_size=60,
))
def test_quantiles_equal_brute_force(spark, rows):
    frame = spark.createDataFrame(rows, "k string, v double")
    found = rollup_with_quantiles(frame, ("k",), (trips_as("n"),), "v", POINTS)
    expected = {}
    for key in {k for k, _ in rows}:
        values = [v for k, v in rows if k == key]
        expected[key] = (len(values), *(discrete(values, p) for p in POINTS.values()))
    assert {r["k"]: (r["n"], r["low"], r["mid"], r["high"]) for r in found.collect()} == expected


def test_ranks_are_exact_at_whole_positions(spark):
    frame = spark.createDataFrame([(float(v),) for v in range(1, 21)], "v double")
    row = rollup_with_quantiles(frame, (), (), "v", POINTS).first()
    assert (row["low"], row["mid"], row["high"]) == (5.0, 10.0, 19.0)


def test_measures_are_those_of_a_plain_rollup(spark):
    frame = random_rows(spark)
    found = rollup_with_quantiles(frame, ("k",), MEASURES, "x", POINTS).drop(*POINTS)
    assert as_set(found) == as_set(rollup(frame, ("k",), MEASURES))


def test_no_value_of_a_fine_grid_is_missed(spark):
    """Every thousandth from 0 to 200, each of them once the answer."""
    grid = [i / 1000 for i in range(200_001)]
    frame = spark.createDataFrame([(v,) for v in grid], "v double")
    points = {f"q{i}": f"{i}/997" for i in range(1, 998, 7)}
    row = rollup_with_quantiles(frame, (), (), "v", points).first()
    assert all(row[name] == discrete(grid, share) for name, share in points.items())


def test_any_doubles_are_exact(spark):
    pick = random.Random(3)
    values = [pick.choice([-1, 1]) * pick.random() * 10.0 ** pick.randint(-300, 300) for _ in range(3000)]
    values += [0.0, -0.0, 5e-324, -5e-324, 1.7e308, math.inf, -math.inf, 2.0**-1022] + [pick.random() for _ in range(2000)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    points = {f"q{i}": f"{i}/200" for i in range(1, 201)}
    row = rollup_with_quantiles(frame, (), (), "v", points).first()
    assert [row[name] for name in points] == [discrete(values, share) for share in points.values()]


def test_no_task_holds_a_whole_group(spark, monkeypatch):
    """One group of different values only: partitions share it, and few rows are read again."""
    monkeypatch.setattr(quantiles, "kept", lambda rows: seen.append(held(rows)) or seen[-1])
    seen = []
    frame = spark.createDataFrame([("a", i * 1.7) for i in range(4000)] + [("b", 1.0)], "k string, v double")
    found = rollup_with_quantiles(frame, ("k",), (), "v", {"mid": "0.5"}).collect()
    assert {(r.k, r.mid) for r in found} == {("a", 1999 * 1.7), ("b", 1.0)}
    sizes = [r["count"] for r in seen[0].groupBy(quantiles.PART).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000
    ends = seen[0].filter("k = 'a'").groupBy(quantiles.PART).agg(F.min("v").alias("a"), F.max("v").alias("b"))
    edges = [x for r in ends.orderBy(quantiles.PART).collect() for x in (r.a, r.b)]
    assert edges == sorted(edges), "partitions hold consecutive values"


@pytest.mark.parametrize("where", ["cached", "stored"])
def test_counts_are_kept_once_and_released(spark, tmp_path, monkeypatch, where):
    frame = random_rows(spark)
    monkeypatch.setattr(kept_rows, "shared_folder", lambda spark: str(tmp_path) if where == "stored" else None)
    with keeping():
        found = rollup_with_quantiles(frame, ("k",), MEASURES, "x", POINTS)
        stored = len(list(tmp_path.glob("held-*")))
        rows = as_set(found)
        plan = found._jdf.queryExecution().executedPlan().toString()
    assert stored == (where == "stored") and not list(tmp_path.glob("held-*")), "removed at the end of the block"
    assert rows == as_set(rollup_with_quantiles(frame, ("k",), MEASURES, "x", POINTS))
    assert ("InMemoryTableScan" in plan) == (where == "cached")


def test_quantiles_of_a_grain_equal_those_of_the_rows(spark):
    rows = random_rows(spark)
    pre = grain(rows, ("k", "h", "x"), ("x", "y"))
    args = ("k",), MEASURES, "x", POINTS
    assert as_set(rollup_with_quantiles(pre, *args)) == as_set(rollup_with_quantiles(rows, *args))
    with pytest.raises(ValueError, match="sketch"):
        rollup_with_quantiles(pre, *args, accuracy=100)


def test_quantiles_of_counted_values(spark):
    """Equal values in several rows, as of several months; nulls have no rank."""
    rows = [(1.0, 3, 1), (2.0, 1, 1), (9.0, 2, 1), (9.0, 4, 2), (None, 50, 1)]
    counts = spark.createDataFrame(rows, "v double, _trips bigint, month int")
    row = quantiles_in_order(held(in_order(counts, (), "v")), (), "v", POINTS).first()
    assert (row["low"], row["mid"], row["high"]) == (1.0, 9.0, 9.0)
    nothing = quantiles_in_order(held(in_order(counts.limit(0), (), "v")), (), "v", POINTS).first()
    assert (nothing["low"], nothing["mid"], nothing["high"]) == (None, None, None)


@pytest.mark.parametrize("accuracy", [50, 1000])
def test_sketches_on_request_are_as_accurate_as_asked(spark, accuracy):
    pick = random.Random(accuracy)
    rows = [(k, pick.choice([pick.random(), float(pick.randrange(9)), -pick.random() ** 9 * 1e6])) for k in "ab" for _ in range(9000)]
    rows += [("c", None), ("a", None), ("b", math.nan), ("d", 4.0)]
    frame = spark.createDataFrame(rows, "k string, v double").repartition(9)
    found = rollup_with_quantiles(frame, ("k",), (trips_as("n"), mean("m", "v")), "v", POINTS, accuracy=accuracy).collect()
    assert {(r.k, r.n) for r in found} == {("a", 9001), ("b", 9001), ("c", 1), ("d", 1)}
    for row in found:
        known = sorted(v for k, v in rows if k == row.k and v is not None and not math.isnan(v))
        for name, share in POINTS.items():
            if not known:
                assert row[name] is None
                continue
            first, last = bisect.bisect_left(known, row[name]), bisect.bisect_right(known, row[name])
            assert row[name] in known
            assert first / len(known) - 1 / accuracy <= float(share) <= last / len(known) + 1 / accuracy


def test_sketches_of_months_add_up_and_meet_in_steps(spark):
    frame = random_rows(spark, 3000).repartition(11).withColumn("month", F.col("h"))
    measures = trips_as("n"), mean("m", "x")
    months = sketches(frame, ("k", "month"), "x", 500, measures)
    merged = quantiles_of_sketches(merged_sketches(months, ("k",)), ("k",), measures, POINTS)
    whole = rollup_with_quantiles(frame, ("k",), measures, "x", POINTS, accuracy=500)
    assert as_set(merged) == as_set(whole) == as_set(rollup_with_quantiles(frame, ("k",), measures, "x", POINTS))
    plan = whole._jdf.queryExecution().toString()
    assert "kll_merge_agg" in plan.lower()
    assert "_sub" in plan and "percentile" not in plan
