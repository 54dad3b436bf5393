"""Quality reports and gates.

A report is a DataFrame; a gate raises a typed error naming every offender and
otherwise returns nothing. Each report, and each gate, measures all of its
columns in one aggregation, so the table is read once however wide it is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import errors
from ..functions.numeric import out_of_range
from ..spec import TableSpec, column, present, require_frame


def _profile(df: DataFrame, tests: Mapping[str, Column], value: str) -> DataFrame:
    """One row per tested column: `column_name, n_rows, <value>`, the rows for which the test holds."""
    if not tests:
        return df.sparkSession.createDataFrame([], f"column_name string, n_rows bigint, {value} bigint")
    # Figures go by place, so a column may have any name.
    places = {f"c{k}": name for k, name in enumerate(tests)}
    figures = [F.count_if(test).alias(place) for place, test in zip(places, tests.values(), strict=True)]
    report = df.agg(F.count("*").alias("n_rows"), *figures).unpivot("n_rows", list(places), "place", value)
    names = F.create_map(*[F.lit(x) for pair in places.items() for x in pair])
    return report.select("n_rows", names[F.col("place")].alias("column_name"), value)


def _measured(report: DataFrame, value: str) -> dict[str, int]:
    """The few rows of a report as a dict, one entry per column of the table."""
    return {row["column_name"]: row[value] for row in report.collect()}


# --- required columns and schema: metadata only, no job ---------------------


def missing_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    return sorted(set(spec.columns) - set(df.columns))


def validate_required_columns(df: DataFrame, spec: TableSpec) -> None:
    require_frame(df, "validate_required_columns")
    missing = missing_columns(df, spec)
    if missing:
        raise errors.MissingRequiredColumnError(dict.fromkeys(missing))


def schema_differences(df: DataFrame, spec: TableSpec) -> list[tuple[str, str, str]]:
    """`(column, expected, actual)` type classes that differ; absent columns are not judged."""
    actual = {f.name: type(f.dataType) for f in df.schema}
    return [
        (c, type(expected).__name__, actual[c].__name__)
        for c, expected in spec.columns.items()
        if c in actual and actual[c] is not type(expected)
    ]


def validate_schema(df: DataFrame, spec: TableSpec) -> None:
    require_frame(df, "validate_schema")
    differences = schema_differences(df, spec)
    if differences:
        # Fixed value: the wording of expected and actual type.
        raise errors.InvalidSchemaError({c: f"attendu={e} | actuel={a}" for c, e, a in differences})


# --- NULL ratio --------------------------------------------------------------


def null_tests(df: DataFrame, spec: TableSpec) -> dict[str, Column]:
    return {c: column(c).isNull() for c in df.columns if c not in spec.null_exempt}


def null_profile(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Report `(column_name, n_rows, null_count, null_ratio)` over all but the exempt columns."""
    report = _profile(df, null_tests(df, spec), "null_count")
    ratio = F.when(F.col("n_rows") > 0, F.col("null_count") / F.col("n_rows"))
    return report.withColumn("null_ratio", ratio)


def check_null_ratio(n_rows: int, counts: Mapping[str, int], spec: TableSpec) -> None:
    """Fail where the share of NULLs is strictly above the limit; an empty table passes."""
    if n_rows == 0:
        return
    found = {
        c: f"{n} of {n_rows} values are NULL ({n / n_rows:.2%}, allowed {spec.max_null_ratio:.0%})"
        for c, n in counts.items()
        if n / n_rows > spec.max_null_ratio
    }
    if found:
        raise errors.HighNullRatioError(found)


def validate_null_ratio(df: DataFrame, spec: TableSpec) -> None:
    require_frame(df, "validate_null_ratio")
    rows = null_profile(df, spec).collect()
    check_null_ratio(rows[0]["n_rows"] if rows else 0, {r["column_name"]: r["null_count"] for r in rows}, spec)


# --- numeric ranges ----------------------------------------------------------


def range_tests(df: DataFrame, spec: TableSpec) -> dict[str, Column]:
    return {c: out_of_range(column(c), *spec.ranges[c]) for c in present(df, spec.ranges)}


def range_profile(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Report `(column_name, n_rows, invalid_count)` over the measurements."""
    return _profile(df, range_tests(df, spec), "invalid_count")


def check_ranges(counts: Mapping[str, int], spec: TableSpec) -> None:
    found = {c: f"{n} values outside {list(spec.ranges[c])}" for c, n in counts.items() if n > 0}
    if found:
        raise errors.InvalidNumericRangeError(found)


def validate_numeric_ranges(df: DataFrame, spec: TableSpec) -> None:
    require_frame(df, "validate_numeric_ranges")
    check_ranges(_measured(range_profile(df, spec), "invalid_count"), spec)


# --- keys, dates, flags, lengths ---------------------------------------------


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Report `(key…, n_rows)` of key values found on several rows; NULL is not a key value."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def validate_unique_primary_key(df: DataFrame, spec: TableSpec) -> None:
    require_frame(df, "validate_unique_primary_key")
    found = duplicate_keys(df, spec.key).agg(F.count("*").alias("keys"), F.sum("n_rows").alias("rows")).first()
    if found["keys"]:
        raise errors.DuplicateKeyError({spec.key: f"{found['keys']} values on {found['rows']} rows"})


def future_dates(df: DataFrame, spec: TableSpec, as_of: datetime) -> DataFrame:
    """Report `(column_name, n_rows, future_count)` of timestamps after `as_of`."""
    columns = present(df, spec.calendar.values())
    return _profile(df, {c: F.col(c) > F.lit(as_of) for c in columns}, "future_count")


def validate_future_dates(df: DataFrame, spec: TableSpec, as_of: datetime) -> None:
    require_frame(df, "validate_future_dates")
    found = {c: n for c, n in _measured(future_dates(df, spec, as_of), "future_count").items() if n}
    if found:
        raise errors.FutureDateError({c: f"{n} after {as_of}" for c, n in found.items()})


def flag_domain(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Report `(column_name, n_rows, invalid_count)` of flags other than 0, 1 and NULL."""
    return _profile(df, {c: ~F.col(c).isin(0, 1) for c in present(df, spec.flags)}, "invalid_count")


def validate_binary_values(df: DataFrame, spec: TableSpec) -> None:
    require_frame(df, "validate_binary_values")
    found = {c: n for c, n in _measured(flag_domain(df, spec), "invalid_count").items() if n}
    if found:
        raise errors.InvalidFlagError({c: f"{n} values other than 0 and 1" for c, n in found.items()})


def text_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Report `(column_name, n_rows, too_long_count)` of texts longer than their limit, in characters."""
    return _profile(df, {c: F.char_length(column(c)) > limits[c] for c in present(df, limits)}, "too_long_count")


def validate_string_length(df: DataFrame, limits: Mapping[str, int]) -> None:
    require_frame(df, "validate_string_length")
    found = {c: n for c, n in _measured(text_length(df, limits), "too_long_count").items() if n}
    if found:
        raise errors.TextTooLongError({c: f"{n} texts longer than {limits[c]}" for c, n in found.items()})
