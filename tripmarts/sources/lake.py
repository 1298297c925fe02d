"""The layers on storage: where they are, how they are read, replaced and registered."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmarts.settings import MonthRange
from tripmarts.sources.kept import remove
from tripmarts.sources.raw import SOURCE_MONTH

BRONZE_PARTITIONS = ("year", "month")
LOCAL_PARTITIONS = ("pickup_year", "pickup_month")
MODES = ("overwrite", "append")


@dataclass(frozen=True)
class Lake:
    """Parquet datasets below one root.

        bronze/<kind>/source_month=YYYYMM/year=Y/month=M
        silver/<kind>/pickup_year=Y/pickup_month=M
        grains/<name>/<kind>/pickup_year=Y/pickup_month=M
        gold/<mart>/<kind>/pickup_year=Y/pickup_month=M
        analytics/<domain>/<name>/trip_type=<kind>
        audit/<kind>/source_month=YYYYMM
    """

    spark: SparkSession
    root: str

    def _path(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    def bronze_path(self, kind: str) -> str:
        return self._path("bronze", kind)

    def silver_path(self, kind: str) -> str:
        return self._path("silver", kind)

    def mart_path(self, mart: str, kind: str) -> str:
        return self._path("gold", mart, kind)

    def grain_path(self, name: str, kind: str) -> str:
        return self._path("grains", name, kind)

    def summary_path(self, domain: str, name: str, kind: str) -> str:
        return self._path("analytics", domain, name, f"trip_type={kind}")

    def exists(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    # -- reading ---------------------------------------------------------------------------

    def _read(
        self, path: str, partitions: tuple[str, str], months: MonthRange | None
    ) -> DataFrame:
        rows = self.spark.read.parquet(path)
        return rows if months is None else rows.filter(months.covers(*partitions))

    def read_bronze(self, kind: str, months: MonthRange | None = None) -> DataFrame:
        rows = self._read(self.bronze_path(kind), BRONZE_PARTITIONS, months)
        return rows.drop(SOURCE_MONTH)

    def read_silver(self, kind: str, months: MonthRange | None = None) -> DataFrame:
        return self._read(self.silver_path(kind), LOCAL_PARTITIONS, months)

    def read_mart(self, mart: str, kind: str, months: MonthRange | None = None) -> DataFrame:
        return self._read(self.mart_path(mart, kind), LOCAL_PARTITIONS, months)

    def read_grain(self, name: str, kind: str, months: MonthRange | None = None) -> DataFrame:
        return self._read(self.grain_path(name, kind), LOCAL_PARTITIONS, months)

    def read_summary(self, domain: str, name: str, kind: str) -> DataFrame:
        return self.spark.read.parquet(self.summary_path(domain, name, kind))

    # -- writing ---------------------------------------------------------------------------

    def write_bronze(
        self,
        rows: DataFrame,
        kind: str,
        source_months: Iterable[tuple[int, int]],
        mode: str = "overwrite",
        rebalance: bool = False,
    ) -> None:
        """Store the rows of the files of these months, in one job.

        A file holds a few rows of other months (late or misdated trips), so replacing
        (year, month) partitions would let one file erase another's rows. Each file owns a
        subtree instead, which a re-run replaces as a whole: all are written beside the old ones, and
        put in their place when the job is done. A file without rows leaves none.
        """
        partitions = (SOURCE_MONTH, *BRONZE_PARTITIONS)
        if mode == "append":
            _save(rows, self.bronze_path(kind), partitions, mode, dynamic=False, rebalance=rebalance)
            return
        with self._beside(self.bronze_path(kind)) as place:
            _save(rows, place, partitions, mode, dynamic=False, rebalance=rebalance)
            for year, month in source_months:
                own = f"{SOURCE_MONTH}={year}{month:02d}"
                self._swap(f"{place}/{own}", f"{self.bronze_path(kind)}/{own}")

    def write_audit(self, kind: str, altered: Mapping[tuple[int, int], Mapping[str, tuple[int, int]]]) -> None:
        """How many values of each column of each source file became null or lost a fraction: one small job."""
        rows = [
            (year * 100 + month, column, *counts)
            for (year, month), columns in altered.items() for column, counts in columns.items()
        ]
        frame = self.spark.createDataFrame(rows, f"{SOURCE_MONTH} int, column_name string, nulled bigint, cut bigint")
        _save(frame.coalesce(1), self._path("audit", kind), (SOURCE_MONTH,), "overwrite", dynamic=True)

    # -- replacing whole folders -------------------------------------------------------------

    @contextmanager
    def _beside(self, path: str) -> Iterator[str]:
        """A folder beside or below this one that readers pass over, and that is gone afterwards."""
        place = f"{path}/_new-{uuid.uuid4().hex}"
        try:
            yield place
        finally:
            remove(self.spark, place)

    def _swap(self, new: str, old: str) -> None:
        """Put the new folder, if there is one, in the place of the old."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(old).getFileSystem(self.spark._jsc.hadoopConfiguration())
        files.delete(path(old), True)
        if files.exists(path(new)):
            files.mkdirs(path(old).getParent())
            if not files.rename(path(new), path(old)):
                raise OSError(f"cannot move {new} to {old}")

    def read_audit(self, kind: str) -> DataFrame:
        return self.spark.read.parquet(self._path("audit", kind))

    def write_silver(
        self,
        rows: DataFrame,
        kind: str,
        mode: str = "overwrite",
        rebalance: bool = False,
    ) -> None:
        """Map-only: a task's rows come from one Bronze split, so from one or two months.

        Replaces the months that `rows` contain and keeps the others.
        """
        _save(rows, self.silver_path(kind), LOCAL_PARTITIONS, mode, True, rebalance)

    def write_mart(
        self,
        rows: DataFrame,
        mart: str,
        kind: str,
        mode: str = "overwrite",
    ) -> None:
        """Months one by one, each in order: range partitions, so files follow one another."""
        order = [*map(F.asc_nulls_first, LOCAL_PARTITIONS), *_mart_order(rows, mart)]
        in_order = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        path = self.mart_path(mart, kind)
        _save(in_order, path, LOCAL_PARTITIONS, mode, dynamic=True)

    def write_grain(self, rows: DataFrame, name: str, kind: str) -> None:
        """Partial sums per month; replaces the months that `rows` contain, in few files each."""
        _save(rows, self.grain_path(name, kind), LOCAL_PARTITIONS, "overwrite", dynamic=True, rebalance=True)

    # -- months without trips --------------------------------------------------------------

    def months_of(self, rows: DataFrame) -> set[tuple[int, int]]:
        """The local months of some trips: a row for each comes back."""
        return {tuple(row) for row in rows.select(*LOCAL_PARTITIONS).distinct().collect()}

    def drop_months(
        self, path: str, months: MonthRange | None, left: set[tuple[int, int]]
    ) -> list[tuple[int, int]]:
        """Remove the stored months, of the range or of all, that are not among those `left`."""
        stored = self.months_of(self._read(path, LOCAL_PARTITIONS, months))
        gone = sorted(stored - left)
        for year, month in gone:
            remove(self.spark, f"{path}/{LOCAL_PARTITIONS[0]}={year}/{LOCAL_PARTITIONS[1]}={month}")
        return gone

    def write_summary(
        self, rows: DataFrame, domain: str, name: str, kind: str, order: tuple[Column, ...] = ()
    ) -> None:
        """One sorted file, put in the place of the old one when it is complete.

        `repartition(1)` rather than `coalesce(1)`: the latter would pull the final aggregation,
        with the partial results of every task, into one task."""
        single = rows.repartition(1)
        if order:
            single = single.sortWithinPartitions(*order)
        with self._beside(self._path("analytics", domain, name)) as place:
            _save(single, place, (), "overwrite", dynamic=False)
            self._swap(place, self.summary_path(domain, name, kind))

    # -- catalog ---------------------------------------------------------------------------

    def register(self, namespace: str, table: str, path: str) -> str:
        """Expose a dataset as an external table of the session's catalog."""
        name = f"{namespace}.{table}"
        self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.catalog.createTable(name, path=path, source="parquet")
        if any(column.isPartition for column in self.spark.catalog.listColumns(name)):
            self.spark.catalog.recoverPartitions(name)
        return name


def _mart_order(rows: DataFrame, mart: str) -> list[Column]:
    """Within a month: boroughs by trips downwards, other marts by their keys."""
    keys = ("pickup_date", "pickup_hour", "pickup_borough", "payment_label")
    first = [F.desc("trip_count")] if mart == "trips_by_borough" else []
    return first + [F.asc_nulls_first(key) for key in keys if key in rows.columns]


def _save(
    rows: DataFrame,
    path: str,
    partitions: tuple[str, ...],
    mode: str,
    dynamic: bool,
    rebalance: bool = False,
) -> None:
    """Write Parquet. `rebalance` shuffles rows into evenly sized files per partition (a large
    partition is split, small ones share a task); it pays off if each task would otherwise
    hold rows of many months and leave as many small files."""
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}; choose from {', '.join(MODES)}")
    present = [name for name in partitions if name in rows.columns]
    if rebalance and present:
        rows = rows.hint("rebalance", *present)
    writer = rows.write.mode(mode)
    writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if present:
        writer = writer.partitionBy(*present)
    writer.parquet(path)
