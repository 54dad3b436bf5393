"""Bronze snapshot to Silver table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import LOSS, clean, clean_missing_values, fill_defaults, label_losses, loss_counts
from ..operators.dedup import COPIES, count_copies
from ..operators.features import enrich
from ..operators.quality import (
    check_null_ratio,
    check_ranges,
    null_tests,
    range_tests,
    validate_required_columns,
    validate_schema,
)
from ..operators.standardize import standardize_column_names, standardize_data_types, standardize_text_values
from ..sources import versions
from ..sources.lake import (
    check_target,
    delete_path,
    latest_snapshot,
    lease,
    may_write,
    publish_staged,
    read_bronze_parquet,
    stage_silver,
)
from ..spec import INSPECTION, TableSpec

_NULL, _RANGE = "_null_", "_range_"
# A mark is a bit of one of these columns; a long has room for so many.
_BITS, _WIDTH = "_bits_", 60
_REJECTED = "_rejected"


@dataclass(frozen=True)
class SilverResult:
    path: str
    n_rows: int
    losses: Mapping[str, int]
    """Input rows, rows lost per reason, rows kept (see `row_loss`)."""
    nulls: Mapping[str, int]
    """NULLs per gated column, before the casts."""
    ranges: Mapping[str, int]
    """Values out of range per measurement."""
    written: bool = True
    """False if mode `ignore` found a table; there are no figures then."""
    version: int | None = None
    """The version published, of a versioned table."""


def _checked_names(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    rows = standardize_column_names(bronze)
    validate_required_columns(rows, spec)
    return rows


def _standardize(filled: DataFrame, spec: TableSpec) -> DataFrame:
    typed = standardize_data_types(standardize_text_values(filled, spec), spec)
    validate_schema(typed, spec)
    return typed


def silver_rows(bronze: DataFrame, spec: TableSpec = INSPECTION) -> DataFrame:
    """The Silver rows of a Bronze frame, as one lazy plan without gates on values."""
    rows = _checked_names(bronze, spec)
    return enrich(_standardize(clean_missing_values(clean(rows, spec), spec), spec), spec)


def _marks(tests: Mapping[str, Column], prefix: str) -> dict[str, Column]:
    """True or NULL per test; standard names never start with `_`, so these cannot clash."""
    return {f"{prefix}{c}": F.when(test, F.lit(True)) for c, test in tests.items()}


def _figures(marked: DataFrame, spec: TableSpec) -> dict[str, Column]:
    """Aggregates over the marks: every figure of the gates and of the row account."""
    kept = F.col(LOSS).isNull()
    marks = [c for c in marked.columns if c.startswith((_NULL, _RANGE))]
    return loss_counts(spec) | {m: F.count_if(kept & F.col(m)) for m in marks}


def build_silver(
    bronze: DataFrame,
    silver_path: str,
    spec: TableSpec = INSPECTION,
    *,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    replace_partitions: bool = False,
    versioned: bool = False,
    n_input: int | None = None,
) -> SilverResult:
    """Transform a Bronze frame, pass the gates, publish at `silver_path`.

    A plain table, the default:

    1. Look at the target: `ignore` stops at one that exists, `error` raises.
    2. Deduplicate, standardise, enrich, and write the rows that stay, once, beside
       the target. All figures are observed in that pass: rows carry their copies,
       their reason to go, and marks for NULLs before the casts and for values out
       of range. Should a lost executor's task have been observed twice (then the
       files hold other than the observed number of rows, or more than `n_input` rows
       were read), they are counted anew.
    3. If the gates pass, swap the new table in.

    A versioned table (`versioned`, or one that is there already):

    2. Write all distinct rows, once, into a folder of the next version, those to be
       rejected with their reason, all with their marks as bits of a hidden column. The
       figures are counted from those columns of the files that tasks have committed,
       each task's once, however often it ran.
    3. If the gates pass, commit the version, with its figures. `rejected_rows` reads
       what was rejected, and why.

    A failing run leaves the target as it is. A table is replaced whole; with
    `replace_partitions` only the partitions that the rows fall into.
    """
    spark = bronze.sparkSession
    mode = check_target(silver_path, mode)
    rows = _checked_names(bronze, spec)
    if not may_write(spark, silver_path, mode):
        return SilverResult(silver_path, 0, {}, {}, {}, written=False)
    filled = fill_defaults(label_losses(count_copies(rows), spec), spec)
    nulls = {c: test for c, test in null_tests(filled, spec).items() if c not in (LOSS, COPIES)}
    typed = _standardize(filled.withColumns(_marks(nulls, _NULL)), spec)
    ranges = range_tests(typed, spec)
    marked = typed.withColumns(_marks(ranges, _RANGE))
    if versioned or versions.is_versioned(spark, silver_path):
        return _build_version(marked, silver_path, spec, list(nulls), list(ranges), mode, partition_by, replace_partitions)
    figures = [figure.alias(name) for name, figure in _figures(marked, spec).items()]

    seen = Observation()
    kept = marked.observe(seen, *figures).filter(F.col(LOSS).isNull())
    silver = enrich(kept.select([c for c in kept.columns if not c.startswith("_")]), spec)
    staged = stage_silver(silver, silver_path, partition_by)
    try:
        counts = seen.get
        n_kept = spark.read.schema(silver.schema).parquet(staged).count()
        if counts.get("kept") != n_kept or n_input not in (None, counts.get("input")):
            counts = marked.agg(*figures).first().asDict()
        result = _gated(counts, silver_path, spec, list(nulls), list(ranges))
        with lease(spark, silver_path):
            publish_staged(spark, staged, silver_path, mode, partition_by, replace_partitions)
    finally:
        delete_path(spark, staged)
    return result


def _gated(counts: Mapping[str, int], path: str, spec: TableSpec, nulls: Sequence[str], ranges: Sequence[str]) -> SilverResult:
    """The result with all its figures, if they pass the gates."""
    null_counts = {c: counts[_NULL + c] for c in nulls}
    range_counts = {c: counts[_RANGE + c] for c in ranges}
    check_null_ratio(counts["kept"], null_counts, spec)
    check_ranges(range_counts, spec)
    losses = {name: counts[name] for name in loss_counts(spec)}
    return SilverResult(path, losses["kept"], losses, null_counts, range_counts)


def _build_version(
    marked: DataFrame,
    path: str,
    spec: TableSpec,
    nulls: Sequence[str],
    ranges: Sequence[str],
    mode: str,
    partition_by: Sequence[str],
    replace_partitions: bool,
) -> SilverResult:
    spark = marked.sparkSession
    marks = [_NULL + c for c in nulls] + [_RANGE + c for c in ranges]
    words = [marks[a : a + _WIDTH] for a in range(0, len(marks), _WIDTH)]
    bits = {
        f"{_BITS}{n}": reduce(add, [F.when(F.col(m), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, m in enumerate(word)])
        for n, word in enumerate(words)
    }
    public = [c for c in marked.columns if not c.startswith("_")]
    rows = enrich(marked.withColumns(bits).select(*public, LOSS, COPIES, *bits), spec)
    hidden = [LOSS, COPIES, *bits]
    if partition_by:
        # rejected rows take no part in which partitions are replaced
        rows, hidden = rows.withColumn(_REJECTED, F.col(LOSS).isNotNull()), [*hidden, _REJECTED]
        partition_by = [_REJECTED, *partition_by]
    staged = versions.stage(rows, path, partition_by, shown=f"{LOSS} IS NULL", hidden=hidden)
    try:
        kept = F.col(LOSS).isNull()
        counted = {m: F.count_if(kept & (F.col(f"{_BITS}{n}").bitwiseAND(1 << k) != 0)) for n, word in enumerate(words) for k, m in enumerate(word)}
        figures = [figure.alias(name) for name, figure in (loss_counts(spec) | counted).items()]
        counts = versions.read_staged(spark, path, staged).agg(*figures).first().asDict()
        result = _gated(counts, path, spec, nulls, ranges)
        made = versions.commit(spark, path, staged, mode, partition_by, replace_partitions=replace_partitions, figures=result.losses)
    except Exception:
        versions.discard(spark, path, staged)
        raise
    return replace(result, version=made.number)


def rejected_rows(spark: SparkSession, silver_path: str, number: int | None = None) -> DataFrame:
    """Of a versioned Silver table the rows that were rejected, with `reason` and the number of `copies`."""
    found = versions.version(spark, silver_path, number)
    rows = versions.read_version(spark, silver_path, number, everything=True).where(f"{LOSS} IS NOT NULL")
    extra = [F.col(LOSS).alias("reason"), F.col(COPIES).alias("copies")]
    return rows.select(*[c for c in rows.columns if c not in found.hidden], *extra)


def transform(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    spec: TableSpec = INSPECTION,
    *,
    layout: str = "ingest_date",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    versioned: bool = False,
) -> SilverResult:
    """Build Silver from the latest Bronze snapshot, at the same path under `silver_root`."""
    snapshot = latest_snapshot(spark, bronze_root, spec.name, layout)
    bronze = read_bronze_parquet(spark, snapshot.under(bronze_root))
    target = snapshot.under(silver_root)
    versioned = versioned or versions.is_versioned(spark, target)
    # a snapshot's rows are counted from the files' footers
    n_input = None if versioned else bronze.count()
    return build_silver(bronze, target, spec, mode=mode, partition_by=partition_by, versioned=versioned, n_input=n_input)
