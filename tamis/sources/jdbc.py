"""Relational source: a partitioned scan of one table over JDBC."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import SourceDBConnectionError, SourceDBQueryError
from ..spec import present


def quoted(url: str, identifier: str, what: str = "table") -> str:
    """`identifier` as the database at `url` takes it; anything but a plain identifier is refused."""
    if not identifier.isidentifier():
        raise ValueError(f"Invalid {what} name: '{identifier}'.")
    return f"`{identifier}`" if url.startswith(("jdbc:mysql:", "jdbc:mariadb:")) else identifier


def bounds_query(url: str, table_name: str, column: str) -> str:
    """Range of the partition column, answered by the database from its index."""
    column = quoted(url, column, "column")
    return f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {quoted(url, table_name)}"


def even_cuts(low, high, num_partitions: int) -> list:
    """Where [low, high] of a number or date column is cut into even ranges."""
    if isinstance(low, date):
        return sorted({low + (high - low) * k / num_partitions for k in range(1, num_partitions)} - {low})
    low, span = int(low), int(high) - int(low) + 1
    return sorted({low + span * k // num_partitions for k in range(1, num_partitions)} - {low})


def histogram_query(url: str, table_name: str, column: str, low: int, high: int, buckets: int) -> str:
    """Rows in each of `buckets` even parts of [low, high], counted by the database from its index."""
    column = quoted(url, column, "column")
    width = -(-(high - low + 1) // buckets)
    bucket = f"FLOOR(({column} - {low}) / {width})"
    return f"SELECT {bucket} AS bucket, COUNT(*) AS n FROM {quoted(url, table_name)} WHERE {column} >= {low} AND {column} <= {high} GROUP BY {bucket}"


def equi_depth_cuts(histogram: Callable[[int, int, int], Mapping[int, int]], low: int, high: int, num_partitions: int, buckets: int = 1024) -> list[int]:
    """Where [low, high] of a whole-number column is cut so that no range holds over twice the mean number of rows.

    `histogram(low, high, buckets)` counts the rows of even parts. A part with more than the
    mean is asked for again by itself, until it is small enough or a single value, so a
    skewed key takes a few more queries, of `buckets` rows each, whatever the table's size.
    """
    counts, total = [], None  # (first value, last value, rows), ascending
    todo = [(low, high)]
    while todo:
        a, b = todo.pop()
        width = -(-(b - a + 1) // buckets)
        found = histogram(a, b, buckets)
        if total is None:
            total = sum(found.values())
        for k in sorted(found, reverse=True):
            first, last = a + k * width, min(b, a + (k + 1) * width - 1)
            if found[k] * num_partitions > total and last > first:
                todo.append((first, last))
            else:
                counts.append((first, found[k]))
    cuts, held = [], 0
    for first, n in sorted(counts):
        # a range is closed before a part that would take it beyond twice the mean, or once it holds the mean
        if held and (held + n) * num_partitions > 2 * total or held * num_partitions >= total:
            cuts.append(first)
            held = 0
        held += n
    return cuts


def range_predicates(column: str, low, high, num_partitions: int, cuts: Sequence | None = None, high_water: bool = False) -> list[str]:
    """Conditions that split a number or date column over queries, and one for NULL; NULL only if there are no bounds.

    Ranges are even, or begin at `cuts`. The outer ranges are open, so rows written since the
    bounds were read are not lost. With `high_water` all of them end at `high` and
    rows without a value are left out: each query then sees the same rows of
    a table that only grows, whenever it runs.
    """
    nulls = f"{column} IS NULL"
    if low is None:
        return ["1 = 0"] if high_water else [nulls]
    text = lambda value: f"'{value}'" if isinstance(value, date) else str(value)
    cuts = [text(c) for c in (even_cuts(low, high, num_partitions) if cuts is None else cuts)]
    edges = [None, *cuts, None]
    ranges = []
    if high_water:
        top = text(high if isinstance(high, date) else int(high))
        starts = [f"{column} >= {a}" for a in cuts]
        ends = [f"{column} < {a}" for a in cuts]
        inner = [" AND ".join(x) for x in zip(starts, ends[1:], strict=False)]
        return [*ends[:1], *inner, f"{starts[-1]} AND {column} <= {top}"] if cuts else [f"{column} <= {top}"]
    for a, b in zip(edges, edges[1:], strict=False):
        parts = [f"{column} >= {a}"] * (a is not None) + [f"{column} < {b}"] * (b is not None)
        ranges.append(" AND ".join(parts) or f"{column} IS NOT NULL")
    return [*ranges, nulls]


def read_table(
    spark: SparkSession,
    url: str,
    table_name: str,
    *,
    partition_column: str | None = "id",
    num_partitions: int = 16,
    predicates: Sequence[str] = (),
    split: str = "even",
    high_water: bool = False,
    fetch_size: int = 10_000,
    date_columns: Sequence[str] = ("date",),
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan a whole table in `num_partitions` parallel range queries.

    The ranges split [min, max] of `partition_column` evenly, which suits a
    primary key; rows where it is NULL are a query of their own. Where whole numbers
    crowd, `split="equi_depth"` counts them first and cuts so that no range holds over
    twice the mean. Or pass `predicates`: disjoint WHERE conditions that cover the
    table, one per task. `partition_column=None` reads in a single query.

    With `high_water` all queries stop at the highest key that there was when the scan began,
    so that they see one instant of a table to which rows with rising keys are added.
    Rows changed or deleted meanwhile are not covered by that, only by a single query.

    MySQL streams rows only with `useCursorFetch=true` in the URL; without it
    the driver buffers each range whole whatever `fetch_size` says.
    """
    if split not in ("even", "equi_depth"):
        raise ValueError(f"Unknown split '{split}'; one of ['equi_depth', 'even'].")
    table = quoted(url, table_name)
    options = {"fetchsize": str(fetch_size), **(properties or {})}
    reader = spark.read.options(url=url, **options)
    try:
        if predicates:
            df = spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
        elif partition_column:
            bounds = bounds_query(url, table_name, partition_column)
            low, high = spark.read.options(url=url, query=bounds, **options).format("jdbc").load().first()
            cuts = None
            if split == "equi_depth" and low is not None and not isinstance(low, date):

                def histogram(a: int, b: int, buckets: int) -> dict[int, int]:
                    counted = histogram_query(url, table_name, partition_column, a, b, buckets)
                    found = spark.read.options(url=url, query=counted, **options).format("jdbc").load()
                    return {int(bucket): int(n) for bucket, n in found.collect()}

                cuts = equi_depth_cuts(histogram, int(low), int(high), num_partitions)
            ranges = range_predicates(quoted(url, partition_column, "column"), low, high, num_partitions, cuts, high_water)
            df = spark.read.jdbc(url, table, predicates=ranges, properties=options)
        else:
            df = reader.options(dbtable=table).format("jdbc").load()
    except (PySparkException, Py4JJavaError) as e:
        unreachable = _sql_state(spark, e).startswith("08")
        error = SourceDBConnectionError if unreachable else SourceDBQueryError
        raise error({table_name: e}) from e
    return parse_dates(df, date_columns)


def _sql_state(spark: SparkSession, error: Exception) -> str:
    """SQLSTATE of the database error behind `error`; class 08 is "connection exception"."""
    cause = getattr(error, "java_exception", None)
    while cause is not None:
        if is_instance_of(spark.sparkContext._gateway, cause, "java.sql.SQLException"):
            return cause.getSQLState() or ""
        cause = cause.getCause()
    return ""


def parse_dates(df: DataFrame, columns: Sequence[str] = ("date",)) -> DataFrame:
    """Cast the given columns to timestamps; what is no date becomes NULL."""
    dates = {c: F.col(c).try_cast("timestamp") for c in present(df, columns)}
    return df.withColumns(dates) if dates else df
