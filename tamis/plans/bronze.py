"""Source table to today's Bronze snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession

from ..sources.jdbc import parse_dates, read_table
from ..sources.lake import snapshot_path, write_bronze


@dataclass(frozen=True)
class BronzeResult:
    path: str
    n_rows: int

    @property
    def written(self) -> bool:
        return self.n_rows > 0


def ingest(
    df: DataFrame,
    bronze_root: str,
    table: str,
    *,
    day: date | None = None,
    layout: str = "ingest_date",
    date_columns: Sequence[str] = ("date",),
    versioned: bool = False,
) -> BronzeResult:
    """Store `df` as the snapshot of `day`, whatever Spark source it comes from."""
    day = day or datetime.now(UTC).date()
    path = snapshot_path(table, day, layout)
    return BronzeResult(path, write_bronze(parse_dates(df, date_columns), bronze_root, table, day, layout, versioned=versioned))


def extract(
    spark: SparkSession,
    url: str,
    table: str,
    bronze_root: str,
    *,
    day: date | None = None,
    layout: str = "ingest_date",
    date_columns: Sequence[str] = ("date",),
    versioned: bool = False,
    **read_options,
) -> BronzeResult:
    """Scan a database table in parallel and store it as the snapshot of `day`."""
    rows = read_table(spark, url, table, date_columns=(), **read_options)
    return ingest(rows, bronze_root, table, day=day, layout=layout, date_columns=date_columns, versioned=versioned)
