"""Stages, layers and command line on files in a temporary folder."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from conftest import ZONE_ROWS, as_set, raw_frame, trip
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tripmarts import cli, session
from tripmarts.contracts import KINDS, BrokenContract
from tripmarts.operators import marts
from tripmarts.plans import stages
from tripmarts.plans.grains import GRAINS
from tripmarts.plans.registry import SUMMARIES
from tripmarts.settings import MonthRange
from tripmarts.sources import lake as lake_source
from tripmarts.sources.kept import remove
from tripmarts.sources.lake import Lake
from tripmarts.sources.raw import month_path, scan_groups

FIRST_QUARTER = MonthRange(2022, 1, 2022, 3)


def month_of_trips(year, month, count=40):
    pick = random.Random(year * 100 + month)
    places = [row[0] for row in ZONE_ROWS] + [900]
    start = date(year, month, 1)
    rows = [
        trip(
            f"{start + timedelta(days=pick.randrange(28))} {pick.randrange(24):02d}:30",
            pick.choice([5, 20, 60]),
            trip_distance=pick.choice([1.0, 4.0, 8.0, 15.0, 30.0]),
            pu_location_id=pick.choice(places),
            do_location_id=pick.choice(places),
            payment_type=pick.choice([1, 2, 3]),
            fare_amount=pick.choice([6.0, 15.0, 33.0]),
            tip_amount=pick.choice([0.0, 1.0, 4.0]),
        )
        for _ in range(count)
    ]
    # A trip of the local month before, a misdated one, and one that is cleaned away.
    rows.append(trip(f"{start} 02:00", 10))
    rows.append(trip("2021-06-15 12:00", 10))
    rows.append(trip(f"{start} 12:00", 10, fare_amount=-1.0))
    return rows


class Scene:
    def __init__(self, spark, folder):
        self.spark = spark
        self.raw = str(folder / "raw")
        self.lake = Lake(spark, str(folder / "lake"))
        lookup = folder / "zones.csv"
        lines = ["LocationID,Borough,Zone,service_zone"]
        lines += [",".join(map(str, row)) for row in ZONE_ROWS]
        lookup.write_text("\n".join(lines))
        self.lookup = str(lookup)

    def store(self, kind, year, month, rows=None):
        frame = raw_frame(self.spark, kind, rows or month_of_trips(year, month))
        frame.coalesce(1).write.mode("overwrite").parquet(month_path(self.raw, kind, year, month))

    def ingest(self, months=FIRST_QUARTER, kind="yellow", **options):
        return stages.ingest(self.lake, self.raw, kind, months, **options)

    def transform(self, months=None, kind="yellow", **options):
        stages.transform(self.lake, self.lookup, kind, months, **options)

    def counts(self, kind="yellow"):
        days = self.lake.read_mart("trips_by_date", kind)
        return (
            self.lake.read_bronze(kind).count(),
            self.lake.read_silver(kind).count(),
            days.agg(F.sum("trip_count")).first()[0],
        )


@pytest.fixture()
def scene(spark, tmp_path):
    made = Scene(spark, tmp_path)
    for month in (1, 2, 3):
        made.store("yellow", 2022, month)
    return made


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    """One complete run, for tests that only look at its results."""
    made = Scene(spark, tmp_path_factory.mktemp("finished"))
    for month in (1, 2, 3):
        made.store("yellow", 2022, month)
    made.ingest()
    made.transform()
    stages.analyse(made.lake, "yellow", top_corridors={"top_n": 4})
    return made


def test_a_second_run_changes_nothing(scene):
    for _ in range(2):
        assert scene.ingest() == [(2022, 1), (2022, 2), (2022, 3)]
        scene.transform()
        assert scene.counts() == (129, 126, 126)


def test_layers_are_partitioned_by_raw_and_by_local_month(finished):
    bronze = finished.lake.read_bronze("yellow")
    assert "source_month" not in bronze.columns
    raw_months = {(r.year, r.month) for r in bronze.select("year", "month").distinct().collect()}
    assert raw_months == {(2021, 6), (2022, 1), (2022, 2), (2022, 3)}
    silver = finished.lake.read_silver("yellow")
    local = silver.select("pickup_year", "pickup_month").distinct().collect()
    assert {tuple(r) for r in local} == {(2021, 6), (2021, 12), (2022, 1), (2022, 2), (2022, 3)}
    shifted = silver.filter("pickup_year = 2021 AND pickup_month = 12")
    assert shifted.count() >= 1
    assert {(r.year, r.month) for r in shifted.collect()} == {(2022, 1)}


def test_replacing_one_file_keeps_the_others(scene):
    scene.ingest()
    scene.store("yellow", 2022, 2, [trip("2022-02-10 12:00")])
    scene.ingest(MonthRange(2022, 2, 2022, 2))
    assert scene.lake.read_bronze("yellow").count() == 43 + 1 + 43
    misdated = scene.lake.read_bronze("yellow").filter("year = 2021")
    assert misdated.count() == 2, "the other files' stray rows stay, the replaced file's go"


def test_transforming_some_months_equals_transforming_all(scene):
    scene.ingest()
    scene.transform()
    before = {m: as_set(scene.lake.read_mart(m, "yellow")) for m in marts.SLOT_MARTS}
    silver_rows = scene.lake.read_silver("yellow").count()
    scene.transform(MonthRange(2022, 2, 2022, 2))
    assert scene.lake.read_silver("yellow").count() == silver_rows
    for mart, rows in before.items():
        assert as_set(scene.lake.read_mart(mart, "yellow")) == rows


def test_a_new_month_is_picked_up_alone(scene):
    scene.ingest(MonthRange(2022, 1, 2022, 2))
    scene.transform()
    scene.ingest(MonthRange(2022, 3, 2022, 3))
    # March reaches back into the last local hours of February.
    scene.transform(MonthRange(2022, 2, 2022, 3))
    partial = as_set(scene.lake.read_mart("trips_by_hour", "yellow").filter("pickup_year = 2022"))
    scene.transform()
    whole = as_set(scene.lake.read_mart("trips_by_hour", "yellow").filter("pickup_year = 2022"))
    assert partial == whole


def test_months_that_lost_their_trips_are_removed(scene):
    scene.ingest()
    scene.transform()
    scene.store("yellow", 2022, 2, [trip("2022-02-10 12:00", fare_amount=-1.0)])
    scene.ingest(MonthRange(2022, 2, 2022, 2))
    scene.transform(MonthRange(2022, 2, 2022, 2))
    silver = scene.lake.read_silver("yellow")
    # What is left of February came with the file of March: its first hours.
    files = {r._source_file for r in silver.filter("pickup_month = 2").collect()}
    assert len(files) == 1 and "tripdata_2022-03" in files.pop()
    scene.store("yellow", 2022, 3, [trip("2022-03-10 12:00", fare_amount=-1.0)])
    scene.ingest(MonthRange(2022, 3, 2022, 3))
    scene.transform(MonthRange(2022, 2, 2022, 3))
    gone = "pickup_year = 2022 AND pickup_month IN (2, 3)"
    assert scene.lake.read_silver("yellow").filter(gone).count() == 0
    for mart in ("trips_by_date", "fare_summary"):
        assert scene.lake.read_mart(mart, "yellow").filter(gone).count() == 0
        assert scene.lake.read_mart(mart, "yellow").filter("pickup_year = 2022 AND pickup_month = 1").count() > 0
    scene.store("yellow", 2022, 1, [trip("2022-01-10 12:00")])
    scene.ingest(MonthRange(2022, 1, 2022, 1))
    scene.transform()
    assert scene.lake.months_of(scene.lake.read_silver("yellow")) == {(2022, 1)}


def test_append_adds_and_unknown_modes_are_refused(scene):
    scene.ingest()
    scene.ingest(mode="append")
    assert scene.lake.read_bronze("yellow").count() == 2 * 129
    with pytest.raises(ValueError, match="upsert"):
        scene.ingest(mode="upsert")


def test_rebalanced_layers_hold_the_same_rows_in_fewer_files(scene):
    def files_and_rows():
        rows = scene.lake.read_silver("yellow")
        audit = ("_ingested_at", "_source_file")
        return len(rows.inputFiles()), sorted(map(str, rows.drop(*audit).collect()))

    scene.store("yellow", 2022, 1, month_of_trips(2022, 1) + month_of_trips(2022, 2))
    scene.ingest()
    scene.transform()
    plain_files, plain_rows = files_and_rows()
    scene.ingest(rebalance=True)
    scene.transform(rebalance=True)
    files, rows = files_and_rows()
    assert rows == plain_rows
    assert files == 5 < plain_files, "one file for each of the five local months"


def test_a_failed_write_is_reported(spark):
    done = []

    def fail():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        stages.side_by_side(spark, [fail, lambda: done.append(1), lambda: done.append(2)])
    assert sorted(done) == [1, 2]


def test_skip_gold(scene):
    scene.ingest()
    scene.transform(skip_gold=True)
    assert scene.lake.read_silver("yellow").count() == 126
    with pytest.raises(AnalysisException):
        scene.lake.read_mart("trips_by_date", "yellow")


def test_nothing_is_written_if_a_file_is_missing(scene):
    with pytest.raises(AnalysisException):
        scene.ingest(MonthRange(2022, 3, 2022, 4))
    with pytest.raises(AnalysisException):
        scene.lake.read_bronze("yellow")
    assert scene.ingest(MonthRange(2022, 3, 2022, 4), skip_missing=True) == [(2022, 3)]


def test_a_broken_file_stops_before_anything_is_written(scene):
    path = month_path(scene.raw, "yellow", 2022, 2)
    rows = scene.spark.read.parquet(month_path(scene.raw, "yellow", 2022, 1))
    rows.withColumnRenamed("fare_amount", "fare").coalesce(1).write.mode("overwrite").parquet(path)
    with pytest.raises(BrokenContract, match="no column fare_amount"):
        scene.ingest()
    with pytest.raises(AnalysisException):
        scene.lake.read_bronze("yellow")


def test_values_made_null_are_counted_per_file(scene, caplog):
    rows = scene.spark.read.parquet(month_path(scene.raw, "yellow", 2022, 1))
    far = rows.withColumn("PULocationID", F.when(F.col("fare_amount") > 20, F.lit(1e12)).otherwise(7.0))
    far.coalesce(1).write.mode("overwrite").parquet(month_path(scene.raw, "yellow", 2022, 2))
    expected = rows.filter("fare_amount > 20").count()
    with caplog.at_level("WARNING"):
        scene.ingest(MonthRange(2022, 1, 2022, 4), skip_missing=True)
    audit = scene.lake.read_audit("yellow").filter("nulled > 0").collect()
    assert [tuple(r) for r in audit] == [("pu_location_id", expected, 0, 202202)]
    every = {(r.source_month, r.column_name) for r in scene.lake.read_audit("yellow").collect()}
    assert {m for m, _ in every} == {202201, 202202, 202203} and (202201, "fare_amount") in every
    assert "pu_location_id" in caplog.text and "2022-04" in caplog.text


def test_months_that_deliver_the_same_are_one_scan(scene):
    drifted = raw_frame(scene.spark, "yellow", month_of_trips(2022, 4))
    drifted = drifted.withColumn("PULocationID", F.col("PULocationID") + F.when(F.col("fare_amount") > 20, 0.5).otherwise(0.0))
    for month in (4, 5):
        drifted.coalesce(1).write.mode("overwrite").parquet(month_path(scene.raw, "yellow", 2022, month))
    half = MonthRange(2022, 1, 2022, 5)
    groups = scan_groups(scene.spark, scene.raw, "yellow", half)
    assert sorted(g.months for g in groups) == [((2022, 1), (2022, 2), (2022, 3)), ((2022, 4), (2022, 5))]
    assert scene.ingest(half) == list(half)
    bronze = scene.spark.read.parquet(scene.lake.bronze_path("yellow"))
    assert bronze.groupBy("source_month").count().count() == 5
    named = F.regexp_replace(F.regexp_extract("_source_file", "tripdata_(.{7})", 1), "-", "").cast("int")
    assert bronze.filter(named != F.col("source_month")).count() == 0
    cut = drifted.filter("PULocationID <> floor(PULocationID)").count()
    audit = scene.lake.read_audit("yellow").filter("cut > 0").orderBy("source_month").collect()
    assert [tuple(r) for r in audit] == [("pu_location_id", 0, cut, 202204), ("pu_location_id", 0, cut, 202205)] and cut


def test_a_failed_write_leaves_what_was_there(scene, monkeypatch):
    scene.ingest()
    scene.transform()
    stages.analyse(scene.lake, "yellow", "time_series")
    bronze = as_set(scene.lake.read_bronze("yellow").groupBy("_source_file", "year", "month").count())
    summary = as_set(scene.lake.read_summary("time_series", "monthly_volume_trend", "yellow"))
    broken = F.when(F.rand() < 2, F.raise_error(F.lit("disk full"))).cast("int")
    with pytest.raises(Exception, match="disk full"):
        scene.lake.write_bronze(scene.lake.read_bronze("yellow").withColumns({"source_month": F.lit(202201), "vendor_id": broken}), "yellow", [(2022, 1)])
    with pytest.raises(Exception, match="disk full"):
        scene.lake.write_summary(scene.spark.range(9).withColumn("x", broken), "time_series", "monthly_volume_trend", "yellow")
    assert as_set(scene.lake.read_bronze("yellow").groupBy("_source_file", "year", "month").count()) == bronze
    assert as_set(scene.lake.read_summary("time_series", "monthly_volume_trend", "yellow")) == summary


def test_every_kind_runs_to_the_end(scene):
    expected = {"green": 22, "fhv": 14, "fhvhv": 19}
    assert set(expected) | {"yellow"} == set(KINDS)
    for kind in expected:
        scene.store(kind, 2022, 1)
        scene.ingest(MonthRange(2022, 1, 2022, 1), kind)
        scene.transform(kind=kind)
        written = stages.analyse(scene.lake, kind)
        assert len(written) == expected[kind], kind
        for name in written:
            summary = SUMMARIES[name]
            found = scene.lake.read_summary(summary.domain, summary.output_name(), kind)
            assert found.count() > 0, (kind, name)
            assert not any(kind_ == "void" for _, kind_ in found.dtypes)


def test_written_summaries_equal_direct_ones_and_are_one_sorted_file(finished):
    silver = finished.lake.read_silver("yellow")
    for name, summary in SUMMARIES.items():
        arguments = {"top_n": 4} if name == "top_corridors" else summary.params
        source = silver if summary.source in GRAINS else getattr(marts, summary.source)(silver)
        expected = summary.build(source, **arguments)
        path = finished.lake.summary_path(summary.domain, summary.output_name(**arguments), "yellow")
        found = finished.spark.read.parquet(path)
        assert as_set(found, 7) == as_set(expected, 7), name
        assert len(found.inputFiles()) == 1, name
        stored, sorted_again = found.collect(), summary.ordered(found).collect()
        keys = [key.lstrip("-") for key in summary.order]
        assert [[r[k] for k in keys] for r in stored] == [[r[k] for k in keys] for r in sorted_again], name
    assert finished.lake.read_summary("trip_patterns", "top_4_corridors", "yellow").count() == 4


def test_a_rerun_of_one_month_reads_that_month_of_silver(scene, monkeypatch):
    scene.ingest()
    scene.transform()
    rows = month_of_trips(2022, 2)
    scene.store("yellow", 2022, 2, rows[:25] + rows[-3:])
    scene.ingest(MonthRange(2022, 2, 2022, 2))
    february = MonthRange(2022, 2, 2022, 2)
    asked = []
    original = Lake.read_silver
    monkeypatch.setattr(Lake, "read_silver", lambda self, kind, months=None: asked.append(months) or original(self, kind, months))
    scene.transform(february)
    stages.analyse(scene.lake, "yellow")
    assert asked == [february]
    monkeypatch.undo()
    found = {name: as_set(read_back(scene, s), 7) for name, s in SUMMARIES.items()}
    grains = {name: as_set(scene.lake.read_grain(name, "yellow")) for name in GRAINS}
    for name in GRAINS:
        remove(scene.spark, scene.lake.grain_path(name, "yellow"))
    stages.analyse(scene.lake, "yellow")
    assert found == {name: as_set(read_back(scene, s), 7) for name, s in SUMMARIES.items()}, "without stored grains"
    scene.transform()
    assert grains == {name: as_set(scene.lake.read_grain(name, "yellow")) for name in GRAINS}
    silver = scene.lake.read_silver("yellow")
    assert found == {
        name: as_set(s.build(silver if s.source in GRAINS else getattr(marts, s.source)(silver), **s.params), 7)
        for name, s in SUMMARIES.items()
    }


def read_back(scene, summary):
    return scene.lake.read_summary(summary.domain, summary.output_name(**summary.params), "yellow")


def test_silver_is_written_by_one_scan_of_bronze(scene, monkeypatch):
    scene.ingest()
    reads = []
    scan = Lake.read_bronze
    monkeypatch.setattr(Lake, "read_bronze", lambda self, *a: reads.append(a) or scan(self, *a))
    asked = []
    months_of = Lake.months_of
    monkeypatch.setattr(Lake, "months_of", lambda self, rows: asked.append(rows.inputFiles()) or months_of(self, rows))
    scene.transform()
    assert len(reads) == 1
    assert asked and not any("/bronze/" in name for files in asked for name in files)


def test_one_domain_only(scene):
    scene.ingest()
    scene.transform()
    assert len(stages.analyse(scene.lake, "yellow", "geo")) == 4
    with pytest.raises(AnalysisException):
        scene.lake.read_summary("demand", "mom_trip_volume", "yellow")


def test_kinds_do_not_overwrite_each_other(scene):
    scene.store("green", 2022, 1)
    for kind in ("yellow", "green"):
        scene.ingest(MonthRange(2022, 1, 2022, 1), kind)
        scene.transform(kind=kind)
        stages.analyse(scene.lake, kind, "demand")
    both = scene.spark.read.parquet(f"{scene.lake.root}/analytics/demand/mom_trip_volume")
    assert {r["trip_type"] for r in both.collect()} == {"yellow", "green"}


def test_reading_months_prunes_partitions(finished):
    rows = finished.lake.read_silver("yellow", MonthRange(2022, 2, 2022, 2))
    plan = rows.select("fare_amount")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "pickup_year" in filters and "pickup_month" in filters


def test_registered_tables(finished):
    lake = finished.lake
    silver = lake.register("trips", "silver_yellow", lake.silver_path("yellow"))
    assert finished.spark.table(silver).count() == 126
    days = lake.register("trips", "by_date", lake.mart_path("trips_by_date", "yellow"))
    total = finished.spark.sql(f"SELECT sum(trip_count) FROM {days} WHERE pickup_year = 2022")
    assert total.first()[0] == 126 - lake.read_silver("yellow").filter("pickup_year < 2022").count()


def test_held_rows_survive_with_a_checkpoint_folder(spark, tmp_path, monkeypatch):
    rows = spark.range(100).selectExpr("id % 3 AS k").groupBy("k").count()
    context = spark.sparkContext
    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    try:
        with stages.held(rows) as kept:
            assert all("shared" in name for name in kept.inputFiles())
            assert as_set(kept) == as_set(rows)
        assert not list((tmp_path / "shared").rglob("held-*")), "removed after use"
    finally:
        unset = context._jvm.scala.Option.apply(None)
        context._jsc.sc().checkpointDir_eq = unset


def run_cli(scene, *words):
    args = cli.build_parser().parse_args(
        [*words, "--lake", scene.lake.root, "--raw-root", scene.raw, "--zone-lookup", scene.lookup]
        if words[0] != "analytics"
        else [*words, "--lake", scene.lake.root]
    )
    cli.execute(args, scene.lake)


SPAN = ["--start-year", "2022", "--end-year", "2022", "--start-month", "1", "--end-month", "3"]


def test_command_line_stage_by_stage(scene):
    run_cli(scene, "ingest", "--trip-type", "yellow", *SPAN)
    run_cli(scene, "transform", "--mode", "overwrite", "--catalog", "lake_tables")
    run_cli(scene, "analytics", "--module", "time_series", "--catalog", "lake_tables")
    assert scene.counts() == (129, 126, 126)
    found = scene.spark.table("lake_tables.seasonal_index_yellow")
    assert as_set(found) == as_set(scene.lake.read_summary("time_series", "seasonal_index", "yellow"))
    assert scene.spark.table("lake_tables.silver_yellow").count() == 126
    assert scene.spark.table("lake_tables.fare_summary_yellow").count() > 0
    assert scene.lake.read_summary("time_series", "seasonal_index", "yellow").count() > 0


def test_command_line_all_at_once(scene):
    run_cli(scene, "run", *SPAN, "--stage", "all", "--accuracy", "10000")
    assert scene.counts() == (129, 126, 126)
    assert scene.lake.read_summary("fare", "fare_anomaly_by_month", "yellow").count() > 0


def test_command_line_refuses_unknown_words():
    for words in (["fly"], ["ingest", "--trip-type", "tram"], ["run", "--stage", "half"]):
        with pytest.raises(SystemExit):
            cli.build_parser().parse_args(words)


def test_layers_are_written_without_sorting_all_rows_of_a_task(scene, monkeypatch):
    """Bronze and Silver have no order of their own; marts have one, which open files would break."""
    asked = {}

    def watched(rows, path, *rest, **more):
        layer = path.removeprefix(scene.lake.root).split("/")[1]
        asked.setdefault(layer, set()).add(scene.spark.conf.get(session.WRITERS))
        return original(rows, path, *rest, **more)

    original = lake_source._save
    monkeypatch.setattr(lake_source, "_save", watched)
    before = scene.spark.conf.get(session.WRITERS)
    scene.ingest()
    scene.transform()
    many = str(session.OPEN_FILES)
    assert asked.pop("bronze") == asked.pop("silver") == {many}
    assert {"gold", "grains"} <= set(asked) and all(found == {before} for found in asked.values())
    assert scene.spark.conf.get(session.WRITERS) == before != many
    assert scene.counts() == (129, 126, 126)


def test_a_task_with_more_months_than_open_files_loses_no_row(scene, monkeypatch):
    monkeypatch.setattr(session, "OPEN_FILES", 1)
    scene.ingest()
    scene.transform()
    assert scene.counts() == (129, 126, 126)
    months = scene.lake.read_bronze("yellow").filter("year <> year(pickup_datetime) OR month <> month(pickup_datetime)")
    assert months.count() == 0
