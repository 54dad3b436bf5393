import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamis.functions.numeric import lenient_cast
from tamis.operators import clean, dedup, features, standardize
from tamis.spec import INSPECTION, TableSpec

DAY = datetime(2026, 7, 29, 8, 30)
NUMBERS = {c: 1.0 for c in INSPECTION.ranges}


def inspection(spark, *rows):
    """Inspection rows with sound values wherever a row says nothing."""
    sound = {"id": 1, "date": DAY, "zone": "z", "instal": "i", "observation": "o", "action": "a", "utilisateur": "u"}
    full = [sound | dict.fromkeys(INSPECTION.flags, 1) | NUMBERS | row for row in rows]
    schema = T.StructType([T.StructField(c, t) for c, t in INSPECTION.columns.items()])
    return spark.createDataFrame([tuple(r[c] for c in INSPECTION.columns) for r in full], schema)


# --- clean -------------------------------------------------------------------


def test_clean_compares_raw_rows_then_trims(spark):
    df = inspection(spark, {"id": 1}, {"id": 1}, {"id": 1, "zone": " z"}, {"id": None}, {"id": 2, "date": None})
    rows = clean.clean(df, INSPECTION).collect()
    assert [(r["id"], r["zone"]) for r in rows] == [(1, "z"), (1, "z")]


def test_duplicates_treat_null_nan_and_zero_signs_as_equal(spark):
    rows = [{"t_av": None}, {"t_av": None}, {"t_av": math.nan}, {"t_av": math.nan}, {"t_av": 0.0}, {"t_av": -0.0}]
    df = inspection(spark, *rows)
    assert clean.clean(df, INSPECTION).count() == 3
    assert sorted(r["_copies"] for r in dedup.count_copies(df).collect()) == [2, 2, 2]


def test_missing_critical_rows_go_and_gaps_are_filled(spark):
    gaps = dict.fromkeys((*INSPECTION.flags, "observation", "action", "utilisateur", "t_av"))
    df = inspection(spark, {"id": 1, **gaps}, {"id": 2, "zone": "  "}, {"id": 3, "instal": None})
    (row,) = clean.clean_missing_values(clean.clean(df, INSPECTION), INSPECTION).collect()
    assert row["id"] == 1
    assert [row[c] for c in INSPECTION.flags] == [0] * 7
    assert (row["observation"], row["action"], row["utilisateur"]) == (
        "non renseignee",
        "aucune action renseignee",
        "inconnu",
    )
    assert row["t_av"] is None


def test_fills_leave_columns_of_another_type_alone(spark):
    df = spark.createDataFrame([(None, None)], "cable string, observation int")
    assert clean.fill_defaults(df, INSPECTION).first() == (None, None)


def test_row_loss_counts_each_row_once_under_its_first_reason(spark):
    df = inspection(
        spark,
        {"id": 1},
        {"id": 1},
        {"id": 1},
        {"id": None, "date": None},
        {"id": None, "zone": ""},
        {"id": 2, "date": None, "instal": " "},
        {"id": 3, "zone": " "},
        {"id": 4},
    )
    loss = {r["reason"]: r["n_rows"] for r in clean.row_loss(df, INSPECTION).collect()}
    assert loss == {
        "input": 8,
        "duplicates": 2,
        "missing_id": 2,
        "missing_date": 1,
        "missing_critical": 1,
        "kept": 2,
    }


def test_row_loss_of_nothing_is_zero(spark):
    df = inspection(spark, {"id": 1}).limit(0)
    assert {r["n_rows"] for r in clean.row_loss(df, INSPECTION).collect()} == {0}


def test_row_loss_matches_the_steps(spark, inspections):
    loss = {r["reason"]: r["n_rows"] for r in clean.row_loss(inspections, INSPECTION).collect()}
    cleaned = clean.clean(inspections, INSPECTION)
    assert loss["input"] == inspections.count()
    assert loss["input"] - loss["duplicates"] == inspections.distinct().count()
    assert cleaned.count() == loss["kept"] + loss["missing_critical"]
    assert clean.clean_missing_values(cleaned, INSPECTION).count() == loss["kept"]
    assert loss["input"] == sum(n for reason, n in loss.items() if reason != "input")


def test_nan_key_is_lost_as_critical(spark):
    spec = TableSpec("t", {"id": T.DoubleType()}, key="id", mandatory=("id",), critical=("id",))
    df = spark.createDataFrame([(1.0,), (math.nan,), (None,)], "id double")
    loss = {r["reason"]: r["n_rows"] for r in clean.row_loss(df, spec).collect()}
    assert loss == {"input": 3, "duplicates": 0, "missing_id": 1, "missing_critical": 1, "kept": 1}
    assert clean.clean_missing_values(clean.clean(df, spec), spec).count() == 1


# --- standardise -------------------------------------------------------------


def test_names_that_cannot_be_told_apart_are_refused(spark):
    with pytest.raises(ValueError, match="a_b"):
        standardize.standardize_column_names(spark.range(1).selectExpr("id AS `A B`", "id AS a_b"))
    with pytest.raises(ValueError):
        standardize.standardize_column_names(spark.range(1).selectExpr("id AS `é`"))


def test_names_with_dots_and_backticks(spark):
    df = spark.range(1).selectExpr("id AS `a.b`", "id AS `c``d`", "id AS ` ID `")
    assert standardize.standardize_column_names(df).columns == ["a_b", "c_d", "id"]


def test_text_values(spark):
    df = spark.createDataFrame([("conv-Ã©", "a  b\tc ", None)], "instal string, zone string, action string")
    assert standardize.standardize_text_values(df, INSPECTION).first() == ("CONV-É", "a  b\tc ", None)
    collapsed = standardize.standardize_text_values(df, INSPECTION, collapse_spaces=True).first()
    assert collapsed == ("CONV-É", "a b c", None)


@pytest.mark.parametrize(
    "values, source, target, expected",
    [
        (["1", " 2 ", "1.75", "-2.", ".5", "+3", "abc", "", "1e3", None], "string", "int",
         [1, 2, 1, -2, 0, 3, None, None, None, None]),
        (["3000000000", "-2147483648"], "string", "int", [None, -2147483648]),
        ([1.7, -1.7, 4e10, math.nan, None], "double", "int", [1, -1, None, None, None]),
        ([3_000_000_000, 7], "bigint", "int", [None, 7]),
        ([True, False], "boolean", "int", [1, 0]),
        (["1.5", "x", " 2 "], "string", "double", [1.5, None, 2.0]),
        ([1, None], "int", "string", ["1", None]),
    ],
)
def test_lenient_cast(spark, values, source, target, expected):
    df = spark.createDataFrame([(v,) for v in values], f"v {source}").coalesce(1)
    kind = T._parse_datatype_string(target)
    assert [r[0] for r in df.select(lenient_cast(F.col("v"), df.schema["v"].dataType, kind)).collect()] == expected


def test_types_reach_the_declared_schema(spark, inspections):
    typed = standardize.standardize_data_types(inspections, INSPECTION)
    assert {f.name: f.dataType for f in typed.schema} == dict(INSPECTION.columns)


def test_dates_that_are_none_become_null_after_the_row_filters(spark):
    df = inspection(spark, {"id": 1}).withColumn("date", F.lit("pas une date"))
    kept = clean.clean_missing_values(clean.clean(df, INSPECTION), INSPECTION)
    assert standardize.standardize_data_types(kept, INSPECTION).first()["date"] is None


# --- features ----------------------------------------------------------------


def test_maxima_skip_null_and_means_do_not(spark):
    df = inspection(spark, {"t_av": None, "t_ar": 3.0, "av_h": None, "ar_ax": 4.0})
    row = features.enrich(df, INSPECTION).first()
    assert (row["temperature_max"], row["temperature_mean"], row["temperature_difference"]) == (3.0, None, None)
    assert (row["vibration_av_max"], row["vibration_av_mean"]) == (1.0, None)
    assert (row["vibration_ar_max"], row["vibration_ar_mean"]) == (4.0, 2.0)
    assert (row["vibration_max"], row["vibration_mean"], row["vibration_side_difference"]) == (4.0, None, None)
    assert (row["inspection_year"], row["inspection_month"], row["inspection_day"]) == (2026, 7, 29)


def test_feature_values_and_order(spark):
    values = {"t_av": 10.0, "t_ar": 25.0, "av_ax": 1.0, "av_h": 2.0, "av_v": 6.0, "ar_ax": 0.5, "ar_h": 0.5, "ar_v": 5.0}
    df = features.enrich(inspection(spark, values), INSPECTION)
    assert df.columns[len(INSPECTION.columns):] == [
        "temperature_max", "temperature_mean", "temperature_difference",
        "vibration_av_max", "vibration_ar_max", "vibration_max",
        "vibration_av_mean", "vibration_ar_mean", "vibration_mean", "vibration_side_difference",
        "inspection_year", "inspection_month", "inspection_day",
    ]
    assert df.first()[len(INSPECTION.columns):] == (25.0, 17.5, 15.0, 6.0, 5.0, 6.0, 3.0, 2.0, 2.5, 1.0, 2026, 7, 29)


@pytest.mark.parametrize(
    "step, column",
    [
        (features.enrich_temperature_features, "t_ar"),
        (features.enrich_vibration_features, "av_h"),
        (features.enrich_temporal_features, "date"),
        (features.enrich, "ar_v"),
    ],
)
def test_missing_feature_inputs_are_named(spark, step, column):
    with pytest.raises(ValueError, match=column):
        step(inspection(spark, {}).drop(column), INSPECTION)


@pytest.mark.parametrize(
    "step",
    [
        clean.clean,
        clean.clean_missing_values,
        clean.label_losses,
        standardize.standardize_text_values,
        standardize.standardize_data_types,
        features.enrich,
        features.enrich_temperature_features,
        features.enrich_vibration_features,
        features.enrich_temporal_features,
    ],
)
def test_no_frame_is_refused(step):
    with pytest.raises(ValueError, match="None"):
        step(None, INSPECTION)
