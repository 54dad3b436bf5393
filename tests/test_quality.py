import math
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tamis import errors
from tamis.operators import quality
from tamis.spec import INSPECTION
from tests.test_operators import inspection


def with_nulls(spark, column, nulls, total):
    return inspection(spark, *[{"id": i, column: None if i < nulls else 1.0} for i in range(total)])


def test_required_columns(spark):
    quality.validate_required_columns(inspection(spark, {}), INSPECTION)
    with pytest.raises(errors.MissingRequiredColumnError, match="ar_h, zone"):
        quality.validate_required_columns(inspection(spark, {}).drop("zone", "ar_h"), INSPECTION)


def test_schema(spark, inspections):
    df = inspection(spark, {})
    quality.validate_schema(df, INSPECTION)
    quality.validate_schema(df.drop("cable").withColumn("more", F.lit(1)), INSPECTION)
    wrong = df.withColumn("id", F.col("id").cast("bigint")).withColumn("date", F.col("date").cast("timestamp_ntz"))
    with pytest.raises(errors.InvalidSchemaError) as e:
        quality.validate_schema(wrong, INSPECTION)
    assert str(e.value).splitlines()[1:] == [
        "id : attendu=IntegerType | actuel=LongType",
        "date : attendu=TimestampType | actuel=TimestampNTZType",
    ]


def test_null_ratio_at_and_above_the_limit(spark):
    quality.validate_null_ratio(with_nulls(spark, "t_av", 3, 10), INSPECTION)
    with pytest.raises(errors.HighNullRatioError, match="t_av: 4 of 10"):
        quality.validate_null_ratio(with_nulls(spark, "t_av", 4, 10), INSPECTION)


def test_null_ratio_spares_exempt_columns_and_empty_tables(spark):
    df = inspection(spark, {"observation": None, "action": None})
    quality.validate_null_ratio(df, INSPECTION)
    quality.validate_null_ratio(with_nulls(spark, "t_av", 1, 1).limit(0), INSPECTION)


def test_null_ratio_judges_columns_the_spec_does_not_know(spark):
    with pytest.raises(errors.HighNullRatioError, match="more"):
        quality.validate_null_ratio(inspection(spark, {}).withColumn("more", F.lit(None).cast("int")), INSPECTION)


def test_all_bad_columns_are_reported_together(spark):
    df = inspection(spark, {"t_av": None, "ar_v": None})
    with pytest.raises(errors.HighNullRatioError) as e:
        quality.validate_null_ratio(df, INSPECTION)
    assert len(e.value.offenders) == 2


@pytest.mark.parametrize("value", [0.0, 120.0, None])
def test_range_bounds_belong_to_the_range(spark, value):
    quality.validate_numeric_ranges(inspection(spark, {"t_av": value}), INSPECTION)


@pytest.mark.parametrize(
    "column, value", [("t_av", -0.5), ("t_ar", 120.5), ("t_av", math.nan), ("ar_v", 50.5), ("av_h", -1.0)]
)
def test_values_out_of_range(spark, column, value):
    with pytest.raises(errors.InvalidNumericRangeError, match=f"{column}: 1 "):
        quality.validate_numeric_ranges(inspection(spark, {column: value}), INSPECTION)


def test_ranges_of_absent_columns_are_not_judged(spark):
    df = inspection(spark, {"t_av": -1.0}).drop(*INSPECTION.ranges)
    quality.validate_numeric_ranges(df, INSPECTION)


def test_profiles_have_one_row_per_column(spark, inspections):
    nulls = quality.null_profile(inspections, INSPECTION)
    assert nulls.columns == ["n_rows", "column_name", "null_count", "null_ratio"]
    assert nulls.count() == len(INSPECTION.columns) - 2
    assert quality.range_profile(inspections, INSPECTION).count() == len(INSPECTION.ranges)
    empty = quality.null_profile(inspections.limit(0), INSPECTION).collect()
    assert {(r["n_rows"], r["null_count"], r["null_ratio"]) for r in empty} == {(0, 0, None)}


def test_unique_key(spark):
    quality.validate_unique_primary_key(inspection(spark, {"id": 1}, {"id": 2}, {"id": None}, {"id": None}), INSPECTION)
    with pytest.raises(errors.DuplicateKeyError, match="1 values on 2 rows"):
        quality.validate_unique_primary_key(inspection(spark, {"id": 1}, {"id": 1, "zone": "y"}), INSPECTION)


def test_future_dates(spark):
    now = datetime(2026, 7, 29, 8, 30)
    quality.validate_future_dates(inspection(spark, {}), INSPECTION, now)
    with pytest.raises(errors.FutureDateError, match="date: 1 after"):
        quality.validate_future_dates(inspection(spark, {}), INSPECTION, now.replace(hour=7))


def test_flags(spark):
    quality.validate_binary_values(inspection(spark, {"cable": 0}, {"cable": None}), INSPECTION)
    with pytest.raises(errors.InvalidFlagError, match="cable: 1 "):
        quality.validate_binary_values(inspection(spark, {"cable": 2}), INSPECTION)


def test_text_length(spark):
    df = inspection(spark, {"zone": "éééé"}, {"zone": None})
    quality.validate_string_length(df, {"zone": 4})
    with pytest.raises(errors.TextTooLongError, match="zone: 1 "):
        quality.validate_string_length(df, {"zone": 3})


@pytest.mark.parametrize(
    "gate",
    [
        quality.validate_required_columns,
        quality.validate_schema,
        quality.validate_null_ratio,
        quality.validate_numeric_ranges,
        quality.validate_unique_primary_key,
        quality.validate_binary_values,
    ],
)
def test_no_frame_is_refused(gate):
    with pytest.raises(ValueError, match="None"):
        gate(None, INSPECTION)


def test_errors_carry_message_and_details():
    error = errors.InvalidSchemaError({"a": "attendu=x | actuel=y"})
    assert error.offenders == {"a": "attendu=x | actuel=y"} and str(error).endswith("\na : attendu=x | actuel=y")
    assert str(errors.MissingRequiredColumnError({"a": None, "b": None})).endswith(": a, b")
    assert issubclass(errors.NoPartitionFoundError, errors.TamisError)


def test_limits_come_from_the_spec(spark):
    strict = replace(INSPECTION, max_null_ratio=0.0, ranges={"t_av": (5, 6)})
    with pytest.raises(errors.HighNullRatioError):
        quality.validate_null_ratio(with_nulls(spark, "t_av", 1, 10), strict)
    with pytest.raises(errors.InvalidNumericRangeError, match=r"\[5, 6\]"):
        quality.validate_numeric_ranges(inspection(spark, {}), strict)


def test_profiles_of_any_column_name(spark):
    spec = replace(INSPECTION, null_exempt=(), ranges={"a.b": (0, 1), "n_rows": (0, 1)})
    df = spark.createDataFrame([(None, 2, 1), (1, 0, 5)], "n_rows int, `a.b` int, `x``y` int")
    nulls = {r["column_name"]: (r["n_rows"], r["null_count"]) for r in quality.null_profile(df, spec).collect()}
    assert nulls == {"n_rows": (2, 1), "a.b": (2, 0), "x`y": (2, 0)}
    assert {r["column_name"]: r["invalid_count"] for r in quality.range_profile(df, spec).collect()} == {"a.b": 1, "n_rows": 0}
