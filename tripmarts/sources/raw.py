"""Raw monthly Parquet files."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmarts.contracts import contract_for
from tripmarts.settings import MonthRange

log = logging.getLogger(__name__)

SOURCE_FILE = "_source_file"
SOURCE_MONTH = "source_month"
# Footers read at a time; each is a small job of its own.
FOOTERS_AT_ONCE = 16


def month_path(raw_root: str, kind: str, year: int, month: int) -> str:
    return f"{raw_root.rstrip('/')}/{kind}/{kind}_tripdata_{year}-{month:02d}.parquet"


def month_paths(raw_root: str, kind: str, months: MonthRange) -> list[str]:
    return [month_path(raw_root, kind, year, month) for year, month in months]


@dataclass(frozen=True)
class MonthGroup:
    """Files of one kind that deliver the same columns in the same types, scanned as one."""

    kind: str
    months: tuple[tuple[int, int], ...]
    raw: DataFrame

    def month_number(self) -> str:
        """SQL for the month that the path of a row's file names, as YYYYMM.

        `month_path` puts it behind the last such folder and prefix. Cut out by place: this is evaluated per row,
        where a regular expression costs more than the rest of the scan.
        """
        named = f"substring_index(_metadata.file_path, '/{self.kind}/{self.kind}_tripdata_', -1)"
        return f"CAST(concat(substring({named}, 1, 4), substring({named}, 6, 2)) AS INT)"

    def rows(self) -> DataFrame:
        """The rows under the kind's contract, with the file and the month each came from.

        The files keep their own physical types and the contract is applied as a projection:
        published months disagree on types (a count is an integer in one month and a double in
        the next), which a schema imposed on the scan itself cannot read. The casts are columns
        of the same scan, so pruning still reaches it.
        """
        casts = contract_for(self.kind).enforce(self.raw)
        return self.raw.selectExpr(
            *casts, f"_metadata.file_path AS {SOURCE_FILE}", f"{self.month_number()} AS {SOURCE_MONTH}"
        )

    def altered(self) -> dict[tuple[int, int], dict[str, tuple[int, int]]]:
        """Per month and column, how many values the contract's type made null, and how many it cut.

        Only columns whose delivered type the contract's type may not hold are read; the others are
        zero by their types. A row for each month of the group comes back.
        """
        contract = contract_for(self.kind)
        found = {month: dict.fromkeys(contract.names_delivered(self.raw), (0, 0)) for month in self.months}
        asked = contract.altered(self.raw)
        if asked:
            counts = self.raw.withColumn(SOURCE_MONTH, F.expr(self.month_number())).groupBy(SOURCE_MONTH).agg(*asked)
            for row in counts.collect():
                values = row.asDict()
                found[divmod(values.pop(SOURCE_MONTH), 100)] |= {name: tuple(pair) for name, pair in values.items()}
        return found


def scan_groups(
    spark: SparkSession, raw_root: str, kind: str, months: MonthRange, skip_missing: bool = False
) -> list[MonthGroup]:
    """The files of the range, grouped by what they deliver. Footers are read side by side.

    A missing file is an error unless told otherwise; then its month is logged, and in no group.
    Each group is held against the contract.
    """
    contract = contract_for(kind)

    def delivered(month: tuple[int, int]) -> T.StructType | None:
        path = month_path(raw_root, kind, *month)
        try:
            return _read(spark, [path]).schema
        except AnalysisException as error:
            if not (skip_missing and error.getCondition() == "PATH_NOT_FOUND"):
                raise
            log.warning("skipped, no such file: %s", path)
            return None

    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        schemas = list(pool.map(inherit(delivered), months))
    alike: dict[str, tuple[T.StructType, list]] = {}
    for month, schema in zip(months, schemas):
        if schema is not None:
            alike.setdefault(schema.simpleString(), (schema, []))[1].append(month)
    groups = []
    for schema, members in alike.values():
        raw = _read(spark, [month_path(raw_root, kind, *month) for month in members], schema)
        contract.enforce(raw)
        groups.append(MonthGroup(kind, tuple(members), raw))
    return groups


def _read(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("mergeSchema", "false").option("pathGlobFilter", "*.parquet")
    return (reader if schema is None else reader.schema(schema)).parquet(*paths)


def read_trip_data(
    spark: SparkSession,
    raw_root: str,
    kind: str,
    months: MonthRange,
    skip_missing: bool = False,
) -> DataFrame:
    """All rows of a month range as one DataFrame."""
    groups = scan_groups(spark, raw_root, kind, months, skip_missing)
    if not groups:
        raise FileNotFoundError(f"no {kind} file under {raw_root} for {months}")
    return reduce(DataFrame.unionByName, [group.rows() for group in groups]).drop(SOURCE_MONTH)
