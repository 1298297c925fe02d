"""The three stages of a run: ingest, transform, analyse."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmarts.contracts import contract_for
from tripmarts.operators.bronze import to_bronze
from tripmarts.operators.marts import mart_builders, slot_grain
from tripmarts.operators.silver import to_silver
from tripmarts.plans.grains import DURATIONS, FARES, GRAINS
from tripmarts.plans.registry import MARTS, SUMMARIES, Summary
from tripmarts.session import files_side_by_side, pin_session_zone
from tripmarts.settings import MonthRange, Refinement
from tripmarts.sources.kept import held, keeping, kept
from tripmarts.sources.lake import LOCAL_PARTITIONS, Lake
from tripmarts.sources.raw import MonthGroup, scan_groups
from tripmarts.sources.zones import load_zone_lookup

log = logging.getLogger(__name__)

JOBS_AT_ONCE = 4


def side_by_side(spark: SparkSession, jobs: Iterable[Callable[[], None]]) -> None:
    """Run independent writes a few at a time, so that the last tasks of one job do not leave
    the other executors idle. The first failure is raised once all have ended."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        running = [pool.submit(inherit(partial(copy_context().run, job))) for job in jobs]
    for job in running:
        job.result()


def one_then_others(spark: SparkSession, jobs: Iterable[Callable[[], None]]) -> None:
    """For jobs over held rows: the first fills them, the others find them."""
    first, *others = jobs
    first()
    side_by_side(spark, others)


def ingest(
    lake: Lake,
    raw_root: str,
    kind: str,
    months: MonthRange,
    mode: str = "overwrite",
    skip_missing: bool = False,
    rebalance: bool = False,
) -> list[tuple[int, int]]:
    """Raw files to Bronze; returns the months stored.

    All files are looked up and held against the contract before the first is written. Files that
    deliver the same columns and types are one scan and one map-only job, however many months they are, and
    replace what is stored only when the job is done, so a run that stops half-way can simply be
    repeated. Values that the contract's types turned into null or cut are counted per file, logged
    and kept in the lake (`read_audit`). Months without a file are logged; they are those of the
    range that are not returned.
    """
    pin_session_zone(lake.spark)
    groups = scan_groups(lake.spark, raw_root, kind, months, skip_missing)
    if not groups:
        raise FileNotFoundError(f"no {kind} file under {raw_root} for {months}")
    log.info("bronze: %s, %d files in %d scans", kind, sum(len(g.months) for g in groups), len(groups))
    altered: dict = {}

    def write(group: MonthGroup) -> None:
        lake.write_bronze(to_bronze(group.rows(), kind), kind, group.months, mode, rebalance)

    def count(group: MonthGroup) -> None:
        altered.update(group.altered())

    with files_side_by_side(lake.spark):
        side_by_side(lake.spark, [partial(job, group) for group in groups for job in (write, count)])
    for month in sorted(altered):
        lost = {name: counts for name, counts in altered[month].items() if any(counts)}
        if lost:
            log.warning("bronze: %s %d-%02d, values made null and cut: %s", kind, *month, lost)
    lake.write_audit(kind, altered)
    return sorted(altered)


def transform(
    lake: Lake,
    zone_lookup: str,
    kind: str,
    months: MonthRange | None = None,
    mode: str = "overwrite",
    skip_gold: bool = False,
    refinement: Refinement = Refinement(),
    accuracy: int | None = None,
    rebalance: bool = False,
) -> None:
    """Bronze to Silver to Gold: everything, or only the given *local* months.

    A local month reaches into the neighbouring month of the raw clock, so the Bronze range
    is one month wider on both sides. Layers are replaced month by month, so a run that stops
    leaves each month old or new; then months that have no trips any more are removed. Which months
    have trips is observed by the write itself, so Bronze is read once. Grains and marts are
    always replaced, never added to: their rows are right only if they cover their whole month.
    """
    contract_for(kind)
    pin_session_zone(lake.spark)
    zones = load_zone_lookup(lake.spark, zone_lookup)
    bronze = lake.read_bronze(kind, months.widened() if months else None)
    silver = to_silver(bronze, zones, kind, refinement)
    if months:
        silver = silver.filter(months.covers(*LOCAL_PARTITIONS))
    log.info("silver: %s", kind)
    watch = Observation()
    with files_side_by_side(lake.spark):
        lake.write_silver(silver.observe(watch, months_seen(*LOCAL_PARTITIONS)), kind, mode, rebalance)
    left = {divmod(number, 100) for number in watch.get[SEEN]}

    def tidy(path: str) -> None:
        """Months that have no trips any more."""
        if mode == "overwrite":
            lake.drop_months(path, months, left)

    tidy(lake.silver_path(kind))

    stored = lake.read_silver(kind, months)
    grains = [name for name, grain in GRAINS.items() if grain.supports(kind)]
    log.info("grains: %s", kind)

    def write_grain(name: str) -> None:
        lake.write_grain(GRAINS[name].build(stored), name, kind)
        tidy(lake.grain_path(name, kind))

    side_by_side(lake.spark, [partial(write_grain, name) for name in grains])

    if not skip_gold:
        counts = {name: lake.read_grain(name, kind, months) for name in grains}
        with held(slot_grain(stored)) as slots:
            log.info("gold: %s", kind)
            marts = mart_builders(stored, kind, slots, counts[DURATIONS], counts.get(FARES), accuracy)

            def write_mart(mart: str) -> None:
                with keeping():
                    lake.write_mart(marts[mart](), mart, kind)
                tidy(lake.mart_path(mart, kind))

            one_then_others(lake.spark, [partial(write_mart, mart) for mart in marts])


def analyse(
    lake: Lake, kind: str, domain: str | None = None, **params: dict[str, int]
) -> list[str]:
    """Write the summaries of one domain, or of all, that the kind supports.

    All come from marts and from the grains that `transform` stores month by month, so Silver is
    not read, whichever months changed; a lake without a grain has it built from all of Silver.
    `params` gives arguments per summary, e.g. `top_corridors={"top_n": 10}`.
    """
    contract_for(kind)
    pin_session_zone(lake.spark)
    chosen = [s for s in SUMMARIES.values() if domain in (None, s.domain)]
    wanted = [s for s in chosen if s.supports(kind)]
    for summary in chosen:
        if summary not in wanted:
            log.info("left out, %s trips lack its columns: %s", kind, summary.name)

    def write(summary: Summary, source: DataFrame) -> None:
        arguments = {**summary.params, **params.get(summary.name, {})}
        log.info("%s: %s", summary.domain, summary.name)
        with keeping():
            lake.write_summary(
                summary.build(source, **arguments),
                summary.domain,
                summary.output_name(**arguments),
                kind,
                summary.sort_columns(),
            )

    def source_of(name: str) -> DataFrame:
        if name in MARTS:
            return lake.read_mart(name, kind)
        if lake.exists(lake.grain_path(name, kind)):
            return lake.read_grain(name, kind)
        log.warning("no stored %s of %s trips, built from all of Silver", name, kind)
        return kept(GRAINS[name].build(lake.read_silver(kind)))

    with keeping():
        sources = {name: source_of(name) for name in sorted({s.source for s in wanted})}
        side_by_side(lake.spark, [partial(write, s, sources[s.source]) for s in wanted])
    return [s.name for s in wanted]


SEEN = "months"


def months_seen(year: str, month: str) -> Column:
    """The months among the observed rows, as numbers YYYYMM: a bounded set."""
    return F.collect_set(F.col(year) * 100 + F.col(month)).alias(SEEN)
