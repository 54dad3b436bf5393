"""Registered queries and the SQL each must agree with.

Every query reads the whole test tables. Those that exercise the lake write
their snapshots below the session's shared checkpoint folder first.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import inspection_fixtures as fixtures  # noqa: E402
from tamis.functions.text import repair_encoding  # noqa: E402
from tamis.operators import alerts, clean, features, indicators, quality, standardize  # noqa: E402
from tamis.plans.bronze import ingest  # noqa: E402
from tamis.operators.dedup import count_copies  # noqa: E402
from tamis.plans.silver import build_silver, rejected_rows, silver_rows, transform  # noqa: E402
from tamis.session import staging_path  # noqa: E402
from tamis.sources import versions  # noqa: E402
from tamis.sources.lake import (  # noqa: E402
    DATE_COLUMN,
    latest_snapshot,
    read_bronze_parquet,
    snapshot_days,
    write_parquet,
    write_silver_parquet,
)
from tamis.spec import INSPECTION  # noqa: E402

# The pipeline operators may be taken out as a whole; the rest works without them.
try:
    import corpus_pipeline  # noqa: E402
    from tamis.llm.queries import ORACLE_SQL as LLM_ORACLE_SQL  # noqa: E402
    from tamis.llm.queries import QUERIES as LLM_QUERIES  # noqa: E402

    LLM_QUERIES = LLM_QUERIES | {"pipeline": corpus_pipeline.run}
    LLM_ORACLE_SQL = LLM_ORACLE_SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tamis.llm", "tamis.llm.queries"):
        raise
    LLM_QUERIES, LLM_ORACLE_SQL = {}, {}

SMOKE_DIR = "/root/testdata/sf0.001"

# Bounds tight enough for the test data to violate them.
TIGHT = replace(
    INSPECTION,
    ranges={c: (0, 60) if c in ("t_av", "t_ar") else (0, 4) for c in INSPECTION.ranges},
)
ALARMS = {"temperature": 60.0, "vibration": 4.0}
AS_OF = datetime(2024, 1, 20, 12)
TEXT_LIMITS = {"zone": 8, "instal": 7, "observation": 8, "action": 6, "utilisateur": 6}
OLD_DAY, DAY = date(2025, 12, 31), date(2026, 7, 29)

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """The Silver rows of the inspections derived from the smallest test tables."""
    return silver(spark, SMOKE_DIR)


# --- queries -----------------------------------------------------------------


def dedup_exact(spark, sf_dir):
    return fixtures.inspection(spark, sf_dir).dropDuplicates()


def dedup_copies(spark, sf_dir):
    """Each distinct row with the number of its copies."""
    return count_copies(fixtures.inspection(spark, sf_dir))


def clean_rows(spark, sf_dir):
    return clean.clean(fixtures.inspection(spark, sf_dir), INSPECTION)


def fill_missing(spark, sf_dir):
    return clean.clean_missing_values(clean_rows(spark, sf_dir), INSPECTION)


def row_loss(spark, sf_dir):
    return clean.row_loss(fixtures.inspection(spark, sf_dir), INSPECTION)


def fix_encoding(spark, sf_dir):
    garbled = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return fixtures.table(spark, sf_dir, "documents").select("doc_id", repair_encoding(garbled).alias("text"))


def upper_ref(spark, sf_dir):
    return standardize.standardize_text_values(fixtures.inspection(spark, sf_dir), INSPECTION)


def cast_types(spark, sf_dir):
    loose = fixtures.projected(spark, sf_dir, fixtures.LOOSE_SQL)
    return standardize.standardize_data_types(loose, INSPECTION)


def rename_columns(spark, sf_dir):
    part = fixtures.table(spark, sf_dir, "part")
    return standardize.standardize_column_names(
        part.toDF(" P-PartKey ", "Nom (pièce)", "P__Brand", "_p.type_", "P SIZE", "Prix/€ 2024")
    )


def null_profile(spark, sf_dir):
    return quality.null_profile(fill_missing(spark, sf_dir), INSPECTION)


def range_profile(spark, sf_dir):
    return quality.range_profile(fill_missing(spark, sf_dir), TIGHT)


def gate_report(spark, sf_dir):
    """Per column of a loosely typed source, what the presence, schema and NULL gates find."""
    loose = fixtures.projected(spark, sf_dir, fixtures.LOOSE_SQL).drop("ar_v", "cable")
    wrong_type = [c for c, _, _ in quality.schema_differences(loose, INSPECTION)]
    nulls = quality.null_profile(standardize.standardize_data_types(loose, INSPECTION), INSPECTION)
    return nulls.select(
        "column_name",
        "n_rows",
        "null_count",
        (F.col("null_ratio") > INSPECTION.max_null_ratio).alias("null_ratio_fails"),
        F.col("column_name").isin(wrong_type).alias("type_differs"),
        F.lit(",".join(quality.missing_columns(loose, INSPECTION))).alias("absent_columns"),
    )


def temperature_features(spark, sf_dir):
    df = features.enrich_temperature_features(fixtures.inspection(spark, sf_dir), INSPECTION)
    return df.select("id", "t_av", "t_ar", "temperature_max", "temperature_mean", "temperature_difference")


def vibration_features(spark, sf_dir):
    df = features.enrich_vibration_features(fixtures.inspection(spark, sf_dir), INSPECTION)
    return df.select("id", *[c for c in df.columns if c.startswith(("av_", "ar_", "vibration_"))])


def temporal_features(spark, sf_dir):
    df = features.enrich_temporal_features(fixtures.inspection(spark, sf_dir), INSPECTION)
    return df.select("id", "date", "inspection_year", "inspection_month", "inspection_day")


def silver(spark, sf_dir):
    return silver_rows(fixtures.inspection(spark, sf_dir))


def _month_earlier(bronze):
    return bronze.withColumn("date", F.expr("date - INTERVAL 31 DAYS"))


def silver_published(spark, sf_dir):
    """Two Bronze snapshots in, the later one found, gates passed, Silver table read back."""
    lake = staging_path(spark, "query-silver")
    bronze = fixtures.inspection(spark, sf_dir)
    ingest(bronze, f"{lake}/bronze", "inspection", day=DAY)
    ingest(_month_earlier(bronze), f"{lake}/bronze", "inspection", day=OLD_DAY)
    return spark.read.parquet(transform(spark, f"{lake}/bronze", f"{lake}/silver").path)


def silver_by_month(spark, sf_dir):
    """Silver partitioned by month; a repeated run replaces only the month it holds."""
    path = staging_path(spark, "query-silver-months")
    months = ("inspection_year", "inspection_month")
    bronze = fixtures.inspection(spark, sf_dir)
    for part in (bronze, _month_earlier(bronze), bronze):
        write_silver_parquet(silver_rows(part), path, partition_by=months, replace_partitions=True)
    rows = spark.read.parquet(path)
    return rows.groupBy(*months).agg(F.count("*").alias("n_rows"), F.sum("temperature_max").alias("temperatures"))


def silver_rerun(spark, sf_dir):
    """One day transformed twice, partitioned by month: only the rows of the corrected Bronze, a month earlier, remain."""
    lake = staging_path(spark, "query-rerun")
    bronze = fixtures.inspection(spark, sf_dir)
    for day_rows in (bronze, _month_earlier(bronze)):
        ingest(day_rows, f"{lake}/bronze", "inspection", day=DAY)
        result = transform(spark, f"{lake}/bronze", f"{lake}/silver", partition_by=("inspection_year", "inspection_month"))
    rows = spark.read.parquet(result.path)
    return rows.select(*silver_rows(bronze).columns)


def silver_raw(spark, sf_dir):
    """Published Silver of a raw table: awkward names, garbled texts, textual dates and numbers, near-equal rows."""
    raw = fixtures.projected(spark, sf_dir, fixtures.RAW_SQL)
    garbled = F.decode(F.encode("zone", "UTF-8"), "ISO-8859-1")
    raw = raw.withColumn("zone", F.when(F.col("mark") == 0, garbled).otherwise(F.col("zone"))).drop("mark")
    raw = raw.toDF(*fixtures.RAW_NAMES)
    return spark.read.parquet(build_silver(raw, f"{staging_path(spark, 'query-raw')}/inspection").path)


def bronze_roundtrip(spark, sf_dir):
    """A day stored twice holds what was stored last."""
    lake = staging_path(spark, "query-bronze")
    bronze = fixtures.inspection(spark, sf_dir)
    ingest(_month_earlier(bronze), lake, "inspection", day=DAY, layout="ymd")
    result = ingest(bronze, lake, "inspection", day=DAY, layout="ymd")
    return read_bronze_parquet(spark, f"{lake}/{result.path}")


def latest_partition(spark, sf_dir):
    """Events stored as one snapshot per day: the rows of the day found to be the latest."""
    lake = staging_path(spark, "query-latest")
    events = fixtures.table(spark, sf_dir, "events")
    write_silver_parquet(
        events.withColumn(DATE_COLUMN, F.to_date("ts")), f"{lake}/events", partition_by=[DATE_COLUMN]
    )
    newest = latest_snapshot(spark, lake, "events")
    rows = read_bronze_parquet(spark, newest.under(lake))
    return rows.withColumn("snapshot_path", F.lit(newest.path))


def latest_partition_ymd(spark, sf_dir):
    """The latest snapshot in a `YYYY/MM/DD` tree that also holds paths without a valid date."""
    lake = staging_path(spark, "query-ymd")
    orders = fixtures.table(spark, sf_dir, "orders")
    for path, status in (
        ("orders/2025/12/31", "O"),
        ("orders/2026/07/28", "F"),
        ("orders/2026/07/29", "P"),
        ("orders/2026/02/30", "O"),
        ("orders/junk/x/y", "F"),
    ):
        write_parquet(orders.filter(F.col("o_orderstatus") == status), f"{lake}/{path}")
    newest = latest_snapshot(spark, lake, "orders", "ymd")
    n_snapshots = len(snapshot_days(spark, lake, "orders", "ymd"))
    rows = read_bronze_parquet(spark, newest.under(lake))
    return rows.withColumns({"snapshot_path": F.lit(newest.path), "n_snapshots": F.lit(n_snapshots).cast("bigint")})


def silver_versions(spark, sf_dir):
    """A versioned Silver table that is built, replaced, added to and changed by month: what each of its versions holds."""
    lake, months = staging_path(spark, "query-versions"), ("inspection_year", "inspection_month")
    bronze, path = fixtures.inspection(spark, sf_dir), f"{lake}/inspection"
    earlier = _month_earlier(bronze)
    build_silver(earlier, path, partition_by=months, versioned=True)
    build_silver(bronze, path, partition_by=months)
    build_silver(earlier, path, mode="append", partition_by=months)
    build_silver(bronze.where("id % 2 = 0"), path, partition_by=months, replace_partitions=True)
    held = [versions.read_version(spark, path, n).select(F.lit(n).alias("version"), "inspection_month", "temperature_max") for n in (1, 2, 3, 4)]
    rows = held[0].union(held[1]).union(held[2]).union(held[3])
    return rows.groupBy("version", "inspection_month").agg(F.count("*").alias("n_rows"), F.sum("temperature_max").alias("temperatures"))


def rejected(spark, sf_dir):
    """What a versioned Silver run has rejected, and why."""
    path = f"{staging_path(spark, 'query-rejected')}/inspection"
    build_silver(fixtures.inspection(spark, sf_dir), path, versioned=True)
    return rejected_rows(spark, path).select("id", "date", "zone", "instal", "reason", "copies")


def maintenance_indicators(spark, sf_dir):
    return indicators.indicators(silver(spark, sf_dir), limits=ALARMS)


def equipment_alerts(spark, sf_dir):
    return alerts.alerts(silver(spark, sf_dir), limits=ALARMS)


def pk_duplicates(spark, sf_dir):
    return quality.duplicate_keys(fixtures.inspection(spark, sf_dir), INSPECTION.key)


def future_dates(spark, sf_dir):
    return quality.future_dates(fixtures.inspection(spark, sf_dir), INSPECTION, AS_OF)


def flag_domain(spark, sf_dir):
    loose = fixtures.projected(spark, sf_dir, fixtures.LOOSE_SQL)
    return quality.flag_domain(standardize.standardize_data_types(loose, INSPECTION), INSPECTION)


def text_length(spark, sf_dir):
    return quality.text_length(fixtures.inspection(spark, sf_dir), TEXT_LIMITS)


def queries() -> dict[str, Query]:
    return core_queries() | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    return core_oracle_sql() | LLM_ORACLE_SQL


def core_queries() -> dict[str, Query]:
    return {
        "dedup_exact": dedup_exact,
        "dedup_copies": dedup_copies,
        "clean": clean_rows,
        "fill_missing": fill_missing,
        "row_loss": row_loss,
        "fix_encoding": fix_encoding,
        "upper_ref": upper_ref,
        "cast_types": cast_types,
        "rename_columns": rename_columns,
        "null_profile": null_profile,
        "range_profile": range_profile,
        "gate_report": gate_report,
        "temperature_features": temperature_features,
        "vibration_features": vibration_features,
        "temporal_features": temporal_features,
        "silver": silver,
        "silver_published": silver_published,
        "silver_by_month": silver_by_month,
        "silver_rerun": silver_rerun,
        "silver_raw": silver_raw,
        "bronze_roundtrip": bronze_roundtrip,
        "latest_partition": latest_partition,
        "latest_partition_ymd": latest_partition_ymd,
        "silver_versions": silver_versions,
        "rejected": rejected,
        "maintenance_indicators": maintenance_indicators,
        "alerts": equipment_alerts,
        "pk_duplicates": pk_duplicates,
        "future_dates": future_dates,
        "flag_domain": flag_domain,
        "text_length": text_length,
    }


# --- the same in SQL ---------------------------------------------------------

_TEXT = INSPECTION.text
_FLAGS = INSPECTION.flags
_MEASURES = tuple(INSPECTION.ranges)

_RAW = fixtures.duckdb_sql(fixtures.INSPECTION_SQL)
_LOOSE = fixtures.duckdb_sql(fixtures.LOOSE_SQL)


def _columns(replaced: dict[str, str]) -> str:
    """Select list of all inspection columns, some of them replaced by an expression."""
    return ", ".join(f"{replaced[c]} AS {c}" if c in replaced else c for c in INSPECTION.columns)


def _trimmed() -> dict[str, str]:
    return {c: f"nullif(trim({c}, ' '), '')" for c in _TEXT}


_TRIMMED = f"SELECT {_columns(_trimmed())} FROM (SELECT DISTINCT * FROM ({_RAW}) raw) distinct_rows"
_CLEAN = f"SELECT * FROM ({_TRIMMED}) trimmed WHERE id IS NOT NULL AND date IS NOT NULL"
_FILLS = {c: f"coalesce({c}, 0)" for c in _FLAGS} | {
    c: f"coalesce({c}, '{default}')" for c, default in INSPECTION.text_defaults.items()
}
_FILLED = f"SELECT {_columns(_FILLS)} FROM ({_CLEAN}) cleaned WHERE zone IS NOT NULL AND instal IS NOT NULL"
_TYPED = (
    f"SELECT {_columns({'instal': 'upper(instal)'} | {c: f'CAST({c} AS INTEGER)' for c in _FLAGS})}"
    f" FROM ({_FILLED}) filled"
)

_TEMPERATURE = """greatest(t_av, t_ar) AS temperature_max, (t_av + t_ar) / 2.0 AS temperature_mean,
  abs(t_av - t_ar) AS temperature_difference"""
_VIBRATION = """greatest(av_ax, av_h, av_v) AS vibration_av_max, greatest(ar_ax, ar_h, ar_v) AS vibration_ar_max,
  greatest(av_ax, av_h, av_v, ar_ax, ar_h, ar_v) AS vibration_max,
  (av_ax + av_h + av_v) / 3.0 AS vibration_av_mean, (ar_ax + ar_h + ar_v) / 3.0 AS vibration_ar_mean,
  (av_ax + av_h + av_v + ar_ax + ar_h + ar_v) / 6.0 AS vibration_mean,
  abs((av_ax + av_h + av_v) / 3.0 - (ar_ax + ar_h + ar_v) / 3.0) AS vibration_side_difference"""
_CALENDAR = """CAST(year(date) AS INTEGER) AS inspection_year, CAST(month(date) AS INTEGER) AS inspection_month,
  CAST(day(date) AS INTEGER) AS inspection_day"""
_SILVER = f"SELECT *, {_TEMPERATURE}, {_VIBRATION}, {_CALENDAR} FROM ({_TYPED}) typed"


def _int(column: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({column} AS DOUBLE)) AS INTEGER)"


_CAST = (
    "SELECT "
    + _columns(
        {c: _int(c) for c in ("id", *_FLAGS)}
        | {"boulonneries": "CAST(boulonneries AS INTEGER)", "date": "TRY_CAST(date AS TIMESTAMP)"}
        | {c: f"TRY_CAST({c} AS DOUBLE)" for c in _MEASURES}
        | {c: f"CAST({c} AS VARCHAR)" for c in _TEXT}
    )
    + f" FROM ({_LOOSE}) loose"
)


_RAW_TEXT = fixtures.duckdb_sql(fixtures.RAW_SQL)
_RAW_KEPT = f"""
SELECT * FROM (
  SELECT {_columns(_trimmed())} FROM (SELECT DISTINCT * EXCLUDE (mark) FROM ({_RAW_TEXT}) raw) distinct_rows
) trimmed WHERE id IS NOT NULL AND date IS NOT NULL AND zone IS NOT NULL AND instal IS NOT NULL"""
_RAW_TYPED = (
    "SELECT "
    + _columns(
        {c: f"coalesce({c}, '{default}')" for c, default in INSPECTION.text_defaults.items()}
        | {"id": _int("id"), "date": "TRY_CAST(date AS TIMESTAMP)", "instal": "upper(instal)"}
        | {c: _int(c) for c in _FLAGS}
        | {c: f"TRY_CAST({c} AS DOUBLE)" for c in _MEASURES}
    )
    + f" FROM ({_RAW_KEPT}) kept"
)
_SILVER_RAW = f"SELECT *, {_TEMPERATURE}, {_VIBRATION}, {_CALENDAR} FROM ({_RAW_TYPED}) typed"


def _report(source: str, measured: dict[str, str]) -> str:
    """One row per column: its name, the row count and what is measured of it."""
    rows = [f"SELECT '{c}' AS column_name, count(*) AS n_rows, {sql} FROM source" for c, sql in measured.items()]
    return f"WITH source AS ({source}) " + " UNION ALL ".join(rows)


def _count(condition: str, name: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) AS {name}"


def _gate_rows() -> str:
    # The loose source's columns that already have their declared type.
    right_type = ("zone", "utilisateur", "graisseur", "ar_h")
    judged = [c for c in INSPECTION.columns if c not in ("observation", "action", "ar_v", "cable")]
    return _report(
        _CAST,
        {
            c: f"count(*) - count({c}) AS null_count, "
            f"CAST(count(*) - count({c}) AS DOUBLE) / count(*) > 0.3 AS null_ratio_fails, "
            f"{c not in right_type} AS type_differs, 'ar_v,cable' AS absent_columns"
            for c in judged
        },
    )


def _loss_rows() -> str:
    return f"""
WITH raw AS ({_RAW}), kept AS ({_TRIMMED}),
counts AS (
  SELECT (SELECT count(*) FROM raw) AS input, count(*) AS distinct_rows,
    count(*) FILTER (WHERE id IS NULL) AS missing_id,
    count(*) FILTER (WHERE id IS NOT NULL AND date IS NULL) AS missing_date,
    count(*) FILTER (WHERE id IS NOT NULL AND date IS NOT NULL AND (zone IS NULL OR instal IS NULL)) AS critical
  FROM kept
)
SELECT 'input' AS reason, input AS n_rows FROM counts
UNION ALL SELECT 'duplicates', input - distinct_rows FROM counts
UNION ALL SELECT 'missing_id', missing_id FROM counts
UNION ALL SELECT 'missing_date', missing_date FROM counts
UNION ALL SELECT 'missing_critical', critical FROM counts
UNION ALL SELECT 'kept', distinct_rows - missing_id - missing_date - critical FROM counts"""


def _moved(condition: str = "true", days: int = 0) -> str:
    """Silver rows of the inspections that meet a condition, dated some days earlier."""
    raw = f"(SELECT * REPLACE (date - INTERVAL {days} DAY AS date) FROM ({_RAW}) r WHERE {condition}) raw"
    return _SILVER.replace(f"({_RAW}) raw", raw)


_REJECTED = f"""
WITH judged AS (
  SELECT *, CASE WHEN id IS NULL THEN 'missing_id' WHEN date IS NULL THEN 'missing_date'
    WHEN zone IS NULL OR instal IS NULL THEN 'missing_critical' END AS reason
  FROM (SELECT {_columns(_trimmed())}, copies FROM (SELECT *, count(*) AS copies FROM ({_RAW}) raw GROUP BY ALL) counted) trimmed
)
SELECT id, date, zone, upper(instal) AS instal, reason, copies FROM judged WHERE reason IS NOT NULL"""

_HOT, _SHAKING = f"coalesce(temperature_max > {ALARMS['temperature']}, false)", f"coalesce(vibration_max > {ALARMS['vibration']}, false)"
_FLAGGED = f"({' OR '.join(f'{c} = 1' for c in _FLAGS)})"
_INDICATORS = f"""
WITH rows AS (SELECT *, instal AS equipment, CAST(date_trunc('month', date) AS DATE) AS month FROM ({_SILVER}) silver)
SELECT ['equipment_month', 'equipment', 'month', 'all'][1 + grouping(equipment, month)] AS level, equipment, month,
  count(*) AS n_inspections, count(*) FILTER (WHERE {_HOT}) AS n_hot, count(*) FILTER (WHERE {_SHAKING}) AS n_shaking,
  count(*) FILTER (WHERE {_FLAGGED}) AS n_flagged, count(*) FILTER (WHERE {_HOT} OR {_SHAKING} OR {_FLAGGED}) AS n_alarming,
  CAST(count(*) FILTER (WHERE {_HOT} OR {_SHAKING} OR {_FLAGGED}) AS DOUBLE) / count(*) AS alarm_ratio,
  min(date) AS first_seen, max(date) AS last_seen,
  CASE WHEN count(date) > 1 THEN CAST(epoch_us(max(date)) - epoch_us(min(date)) AS DOUBLE) / 3.6e9 / (count(date) - 1) END AS mean_gap_hours,
  max(temperature_max) AS temperature_peak, max(vibration_max) AS vibration_peak,
  sum(temperature_mean) / count(temperature_mean) AS temperature_mean
FROM rows GROUP BY GROUPING SETS ((equipment, month), (equipment), (month), ())"""

_ALERTS = f"""
WITH readings AS (
  SELECT instal AS equipment, date AS seen, id, temperature_max AS t, vibration_max AS v FROM ({_SILVER}) silver WHERE date IS NOT NULL
), marked AS (
  SELECT *, sum(CASE WHEN coalesce(t > {ALARMS['temperature']}, false) THEN 0 ELSE 1 END) OVER w AS t_quiet,
    sum(CASE WHEN coalesce(v > {ALARMS['vibration']}, false) THEN 0 ELSE 1 END) OVER w AS v_quiet
  FROM readings WINDOW w AS (PARTITION BY equipment ORDER BY seen, id NULLS FIRST, t NULLS FIRST, v NULLS FIRST ROWS UNBOUNDED PRECEDING)
), runs AS (
  SELECT equipment, 'temperature' AS feature, t_quiet AS quiet, seen, t AS value, {ALARMS['temperature']} AS bar FROM marked WHERE t > {ALARMS['temperature']}
  UNION ALL SELECT equipment, 'vibration', v_quiet, seen, v, {ALARMS['vibration']} FROM marked WHERE v > {ALARMS['vibration']}
)
SELECT equipment, feature, min(seen) AS started, max(seen) AS ended, count(*) AS n_inspections, max(value) AS peak,
  CASE WHEN max(value) >= max(bar) * CAST(1.1 AS DOUBLE) THEN 'critical' ELSE 'warning' END AS severity
FROM runs GROUP BY equipment, feature, quiet"""


def _versions_rows() -> str:
    """By version the rows of the table: the earlier month, the month, both, and both with half the month's rows."""
    held = [
        (1, _moved(days=31)),
        (2, _moved()),
        (3, f"SELECT * FROM ({_moved()}) a UNION ALL SELECT * FROM ({_moved(days=31)}) b"),
    ]
    half = _moved("id % 2 = 0")
    kept = f"SELECT * FROM ({held[2][1]}) whole WHERE (inspection_year, inspection_month) NOT IN (SELECT (inspection_year, inspection_month) FROM ({half}) h)"
    held.append((4, f"{kept} UNION ALL SELECT * FROM ({half}) changed"))
    rows = " UNION ALL ".join(f"SELECT {n} AS version, inspection_month, temperature_max FROM ({sql}) v{n}" for n, sql in held)
    return f"SELECT version, inspection_month, count(*) AS n_rows, sum(temperature_max) AS temperatures FROM ({rows}) held GROUP BY ALL"


def core_oracle_sql() -> dict[str, str]:
    profiled = [c for c in INSPECTION.columns if c not in INSPECTION.null_exempt]
    measures = ", ".join(c for c in _MEASURES if c not in ("t_av", "t_ar"))
    return {
        "dedup_exact": f"SELECT DISTINCT * FROM ({_RAW}) raw",
        "dedup_copies": f"SELECT *, count(*) AS _copies FROM ({_RAW}) raw GROUP BY ALL",
        "clean": _CLEAN,
        "fill_missing": _FILLED,
        "row_loss": _loss_rows(),
        "fix_encoding": "SELECT doc_id, text FROM documents",
        "upper_ref": f"SELECT {_columns({'instal': 'upper(instal)'})} FROM ({_RAW}) raw",
        "cast_types": _CAST,
        "rename_columns": "SELECT p_partkey, p_name AS nom_pi_ce, p_brand, p_type, p_size, "
        "p_retailprice AS prix_2024 FROM part",
        "null_profile": _report(
            _FILLED,
            {
                c: f"count(*) - count({c}) AS null_count, "
                f"CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS null_ratio"
                for c in profiled
            },
        ),
        "range_profile": _report(
            _FILLED,
            {c: _count(f"{c} < {low} OR {c} > {high}", "invalid_count") for c, (low, high) in TIGHT.ranges.items()},
        ),
        "gate_report": _gate_rows(),
        "temperature_features": f"SELECT id, t_av, t_ar, {_TEMPERATURE} FROM ({_RAW}) raw",
        "vibration_features": f"SELECT id, {measures}, {_VIBRATION} FROM ({_RAW}) raw",
        "temporal_features": f"SELECT id, date, {_CALENDAR} FROM ({_RAW}) raw",
        "silver": _SILVER,
        "silver_published": _SILVER,
        "silver_by_month": f"""
SELECT CAST(year(d) AS INTEGER) AS inspection_year, CAST(month(d) AS INTEGER) AS inspection_month,
  count(*) AS n_rows, sum(temperature_max) AS temperatures
FROM (
  SELECT date AS d, temperature_max FROM ({_SILVER}) s
  UNION ALL SELECT date - INTERVAL 31 DAY, temperature_max FROM ({_SILVER}) s
) both_runs GROUP BY ALL""",
        "silver_rerun": _SILVER.replace(
            f"({_RAW}) raw", f"(SELECT * REPLACE (date - INTERVAL 31 DAY AS date) FROM ({_RAW}) r) raw"
        ),
        "silver_raw": _SILVER_RAW,
        "bronze_roundtrip": _RAW,
        "latest_partition": "SELECT *, 'events/ingest_date=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS snapshot_path "
        "FROM events WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events)",
        "latest_partition_ymd": "SELECT *, CAST(3 AS BIGINT) AS n_snapshots, 'orders/2026/07/29' AS snapshot_path "
        "FROM orders WHERE o_orderstatus = 'P'",
        "silver_versions": _versions_rows(),
        "rejected": _REJECTED,
        "maintenance_indicators": _INDICATORS,
        "alerts": _ALERTS,
        "pk_duplicates": f"SELECT id, count(*) AS n_rows FROM ({_RAW}) raw "
        "WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1",
        "future_dates": _report(_RAW, {"date": _count(f"date > TIMESTAMP '{AS_OF}'", "future_count")}),
        "flag_domain": _report(_CAST, {c: _count(f"{c} NOT IN (0, 1)", "invalid_count") for c in _FLAGS}),
        "text_length": _report(
            _RAW, {c: _count(f"length({c}) > {limit}", "too_long_count") for c, limit in TEXT_LIMITS.items()}
        ),
    }
