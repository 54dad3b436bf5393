import os
import re
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

import inspection_fixtures as fixtures
from tamis import INSPECTION, build_silver, ingest, silver_rows, transform
from tamis.errors import (
    DataLakeWriteError,
    HighNullRatioError,
    InvalidNumericRangeError,
    MissingRequiredColumnError,
    NoPartitionFoundError,
)
from tamis.operators import clean, dedup
from tests.conftest import SF_DIR
from tests.test_operators import inspection


@pytest.fixture(scope="module")
def bronze(spark, inspections, tmp_path_factory):
    """The inspections as Parquet, so that plans start at a plain scan."""
    path = str(tmp_path_factory.mktemp("bronze") / "inspection")
    inspections.write.parquet(path)
    return spark.read.parquet(path)


def same_rows(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def staged(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    return [d for d in os.listdir(root) if d.startswith("silver-")]


def beside(path):
    """What a run has left next to its target."""
    return [d for d in os.listdir(os.path.dirname(path)) if d.startswith("_")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- results -----------------------------------------------------------------


@pytest.mark.parametrize("layout", ["ymd", "ingest_date"])
def test_transform_publishes_the_latest_snapshot(spark, bronze, tmp_path, layout):
    lake = f"{tmp_path}/bronze"
    older = bronze.withColumn("zone", F.lit("older"))
    ingest(bronze, lake, "inspection", day=date(2026, 7, 29), layout=layout)
    ingest(older, lake, "inspection", day=date(2025, 12, 31), layout=layout)
    result = transform(spark, lake, f"{tmp_path}/silver", layout=layout)
    assert result.path.endswith(("inspection/2026/07/29", "inspection/ingest_date=2026-07-29"))
    published = spark.read.parquet(result.path)
    assert same_rows(published, silver_rows(bronze))
    assert result.n_rows == published.count()
    assert staged(spark) == []


def test_figures_match_the_reports(spark, bronze, tmp_path):
    result = build_silver(bronze, str(tmp_path / "silver"))
    loss = {r["reason"]: r["n_rows"] for r in clean.row_loss(bronze, INSPECTION).collect()}
    assert result.losses == loss
    filled = clean.clean_missing_values(clean.clean(bronze, INSPECTION), INSPECTION)
    assert result.nulls["t_av"] == filled.filter("t_av IS NULL").count() > 0
    assert set(result.nulls) == set(INSPECTION.columns) - {"observation", "action"}
    assert result.ranges == dict.fromkeys(INSPECTION.ranges, 0)


def test_raw_names_and_extra_columns(spark, tmp_path):
    raw = inspection(spark, {}).withColumn("Numéro Série", F.lit(7))
    raw = raw.withColumnRenamed("t_av", " T-AV ").withColumnRenamed("date", "DATE")
    build_silver(raw, str(tmp_path / "silver"))
    row = spark.read.parquet(str(tmp_path / "silver")).first()
    assert (row["t_av"], row["num_ro_s_rie"]) == (1.0, 7)


def test_empty_snapshot_passes(spark, bronze, tmp_path):
    result = build_silver(bronze.limit(0), str(tmp_path / "silver"))
    assert result.n_rows == 0
    assert len(spark.read.parquet(str(tmp_path / "silver")).columns) == 35


def test_no_snapshot(spark, tmp_path):
    with pytest.raises(NoPartitionFoundError):
        transform(spark, str(tmp_path), str(tmp_path))


# --- gates -------------------------------------------------------------------


def fails(spark, df, path, error, match):
    silver_rows(inspection(spark, {"id": 99})).write.mode("overwrite").parquet(path)
    with pytest.raises(error, match=match):
        build_silver(df, path)
    assert [r["id"] for r in spark.read.parquet(path).collect()] == [99]
    assert staged(spark) == [] and beside(path) == []


def test_failing_gates_leave_the_target_and_no_staged_rows(spark, tmp_path):
    path = str(tmp_path / "silver")
    fails(spark, inspection(spark, {"t_av": 121.0}), path, InvalidNumericRangeError, "t_av: 1 ")
    fails(spark, inspection(spark, {"ar_v": None}), path, HighNullRatioError, "ar_v: 1 of 1")
    fails(spark, inspection(spark, {}).drop("cable"), path, MissingRequiredColumnError, "cable")


def test_null_gate_comes_before_the_range_gate(spark, tmp_path):
    df = inspection(spark, {"t_av": None, "t_ar": -1.0})
    fails(spark, df, str(tmp_path / "silver"), HighNullRatioError, "t_av")


def test_gates_judge_only_the_rows_that_stay(spark, tmp_path):
    df = inspection(spark, {"id": 1}, {"id": None, "t_av": 999.0}, {"id": 2, "zone": " ", "t_av": None, "av_h": -1.0})
    assert build_silver(df, str(tmp_path / "silver")).n_rows == 1


def test_null_gate_sees_values_before_the_casts(spark, tmp_path):
    df = inspection(spark, {}).withColumn("t_av", F.lit("chaud"))
    result = build_silver(df, str(tmp_path / "silver"))
    assert result.nulls["t_av"] == 0
    assert spark.read.parquet(str(tmp_path / "silver")).first()["t_av"] is None


def test_a_run_may_replace_only_its_months(spark, bronze, tmp_path):
    path, months = str(tmp_path / "silver"), ("inspection_year", "inspection_month")
    earlier = bronze.withColumn("date", F.expr("date - INTERVAL 31 DAYS"))
    for part in (bronze, earlier, bronze):
        build_silver(part, path, partition_by=months, replace_partitions=True)
    both = silver_rows(bronze).union(silver_rows(earlier))
    assert same_rows(spark.read.parquet(path).select(both.columns), both)


def test_a_day_is_replaced_whole(spark, bronze, tmp_path):
    path, months = str(tmp_path / "silver"), ("inspection_year", "inspection_month")
    earlier = bronze.withColumn("date", F.expr("date - INTERVAL 31 DAYS"))
    for part in (bronze, earlier):
        build_silver(part, path, partition_by=months)
    again = silver_rows(earlier)
    assert same_rows(spark.read.parquet(path).select(again.columns), again)


def test_modes(spark, tmp_path):
    path, one, two = str(tmp_path / "silver"), inspection(spark, {"id": 1}), inspection(spark, {"id": 2})
    ids = lambda: sorted(r["id"] for r in spark.read.parquet(path).collect())
    assert build_silver(one, path, mode="error").written and ids() == [1]
    with pytest.raises(DataLakeWriteError, match="exists"):
        build_silver(two, path, mode="error")
    ignored = build_silver(two, path, mode="ignore")
    assert (ignored.written, ignored.n_rows, ids()) == (False, 0, [1])
    assert build_silver(two, path, mode="append").n_rows == 1 and ids() == [1, 2]
    assert build_silver(two, path, mode="overwrite").n_rows == 1 and ids() == [2]
    other = str(tmp_path / "new")
    assert all(build_silver(one, f"{other}-{mode}", mode=mode).written for mode in ("append", "ignore", "overwrite"))


@pytest.mark.parametrize("step", ["write_parquet", "swap_in"])
def test_a_failed_publish_leaves_the_old_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "silver")
    build_silver(inspection(spark, {"id": 1}), path)

    def fail(*args, **kwargs):
        raise DataLakeWriteError({path: "no space"})

    monkeypatch.setattr(f"tamis.sources.lake.{step}", fail)
    with pytest.raises(DataLakeWriteError, match="no space"):
        build_silver(inspection(spark, {"id": 2}), path)
    assert [r["id"] for r in spark.read.parquet(path).collect()] == [1]
    assert os.listdir(tmp_path) == ["silver"]


def test_a_swap_that_fails_moves_the_old_table_back(spark, tmp_path):
    from tamis.sources.lake import swap_in

    path = str(tmp_path / "silver")
    build_silver(inspection(spark, {"id": 1}), path)
    with pytest.raises(DataLakeWriteError):
        swap_in(spark, str(tmp_path / "absent"), path)
    assert [r["id"] for r in spark.read.parquet(path).collect()] == [1]


def test_figures_observed_twice_are_counted_anew(spark, bronze, tmp_path, monkeypatch):
    expected = build_silver(bronze, str(tmp_path / "one"))

    class Twice:
        def __init__(self):
            from pyspark.sql import Observation

            self.inner = Observation()

        @property
        def get(self):
            return {name: 2 * n for name, n in self.inner.get.items()}

    real = type(bronze).observe
    monkeypatch.setattr("tamis.plans.silver.Observation", Twice)
    monkeypatch.setattr(type(bronze), "observe", lambda self, seen, *figures: real(self, seen.inner, *figures))
    again = build_silver(bronze, str(tmp_path / "two"))
    assert (again.losses, again.nulls, again.ranges) == (expected.losses, expected.nulls, expected.ranges)


def test_wrong_mode_is_refused_before_any_work(spark, bronze, tmp_path):
    with pytest.raises(ValueError, match="upsert"):
        build_silver(bronze, str(tmp_path / "silver"), mode="upsert")


def test_another_table_spec(spark, tmp_path):
    """The same plan over `part`, described by its own spec."""
    part = fixtures.table(spark, SF_DIR, "part")
    spec = replace(
        INSPECTION,
        name="part",
        columns={f.name: f.dataType for f in part.schema},
        key="p_partkey",
        mandatory=("p_partkey",),
        critical=("p_partkey", "p_name"),
        text=("p_name", "p_brand"),
        upper=("p_brand",),
        flags=(),
        text_defaults={"p_brand": "none"},
        ranges={"p_retailprice": (0, 1e6)},
        pairs={},
        sides={},
        calendar={},
    )
    result = build_silver(part.union(part), str(tmp_path / "part"), spec)
    assert result.n_rows == result.losses["duplicates"] == part.count()
    assert spark.read.parquet(str(tmp_path / "part")).first()["p_brand"].startswith("BRAND#")


# --- plans -------------------------------------------------------------------


def test_silver_plan_has_one_shuffle_and_no_python(bronze):
    text = plan(silver_rows(bronze))
    assert text.count("Exchange") == 1
    assert "Python" not in text
    assert re.search(r"PushedFilters: \[.*IsNotNull\(id\).*IsNotNull\(date\)", text)


def test_copies_are_combined_before_the_shuffle(bronze):
    text = plan(clean.label_losses(dedup.count_copies(bronze), INSPECTION))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
    assert text.count("partial_count(1)") == 1


def test_collated_and_map_columns_pass_through(spark, bronze, tmp_path):
    """Rows that differ by case in a collated column are one; the lazy and the published rows agree."""
    rows = bronze.dropDuplicates()
    kept = silver_rows(rows).count()
    for name, one, two in (
        ("lcase", "'A' COLLATE UTF8_LCASE", "'a' COLLATE UTF8_LCASE"),
        ("trim", "'A' COLLATE UTF8_BINARY_RTRIM", "'A ' COLLATE UTF8_BINARY_RTRIM"),
        ("pairs", "map('x', 1, 'y', 2)", "map('y', 2, 'x', 1)"),
    ):
        both = rows.withColumn("extra", F.expr(one)).union(rows.withColumn("extra", F.expr(two)))
        result = build_silver(both, str(tmp_path / name))
        assert result.losses["duplicates"] == rows.count()
        assert result.n_rows == silver_rows(both).count() == kept


def test_collated_texts_are_cleaned(spark, tmp_path):
    df = inspection(spark, {"instal": " "}, {"instal": "x"}).withColumn("instal", F.expr("instal COLLATE UTF8_LCASE"))
    assert silver_rows(df).count() == build_silver(df, str(tmp_path / "silver")).n_rows == 1


def test_a_row_making_up_a_third_of_the_table(spark, bronze, tmp_path):
    distinct = bronze.dropDuplicates().filter("id IS NOT NULL")
    n = distinct.count()
    copies = inspection(spark, {"id": -1}).withColumn("date", F.col("date").cast("timestamp_ntz"))
    for c in INSPECTION.flags:
        copies = copies.withColumn(c, F.col(c).cast("bigint"))
    hot = distinct.unionByName(copies.select(F.explode(F.sequence(F.lit(1), F.lit(n // 2))), "*").drop("col"))
    result = build_silver(hot, str(tmp_path / "silver"))
    assert result.losses["duplicates"] == n // 2 - 1
    assert spark.read.parquet(str(tmp_path / "silver")).filter("id = -1").count() == 1


def test_features_read_only_their_columns(bronze):
    from tamis.operators.features import enrich_temperature_features

    text = plan(enrich_temperature_features(bronze, INSPECTION).select("temperature_mean"))
    assert "ReadSchema: struct<t_av:double,t_ar:double>" in text


def test_profiles_read_the_table_once(bronze):
    from tamis.operators import quality

    assert plan(quality.null_profile(bronze, INSPECTION)).count("Scan parquet") == 1
    text = plan(quality.range_profile(bronze, INSPECTION))
    assert text.count("Scan parquet") == 1 and "zone" not in text


def test_silver_run_takes_few_jobs(spark, bronze, tmp_path):
    group = "silver-run"
    spark.sparkContext.setJobGroup(group, "counted")
    build_silver(bronze, str(tmp_path / "silver"))
    spark.sparkContext.setJobGroup("", "")
    # Shuffle and write, count by footers.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= 4
