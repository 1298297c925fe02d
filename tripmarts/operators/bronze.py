"""Raw rows to Bronze rows: names, audit columns, partition columns. No row is dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmarts.contracts import contract_for
from tripmarts.sources.raw import SOURCE_FILE, SOURCE_MONTH


def to_bronze(raw: DataFrame, kind: str) -> DataFrame:
    kept = [name for name in raw.columns if name in (SOURCE_FILE, SOURCE_MONTH)]
    named = raw.selectExpr(*contract_for(kind).enforce(raw, renamed=True), *kept)
    return named.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_trip_type": F.lit(kind),
            "year": F.year("pickup_datetime"),
            "month": F.month("pickup_datetime"),
        }
    )
