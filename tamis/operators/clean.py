"""Exact duplicates, unusable rows, blanks, fills, and the account of lost rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import is_missing
from ..functions.text import blank_to_null
from ..spec import TableSpec, present, require_frame
from .dedup import COPIES, count_copies

LOSS = "_loss"


def clean(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Distinct rows that have their mandatory columns, texts trimmed, blanks NULL.

    Rows are compared as they arrive, so two rows that differ only in outer
    spaces both stay. Catalyst moves the NULL filters below the distinct and
    into the scan.
    """
    require_frame(df, "clean")
    rows = count_copies(df).drop(COPIES)
    for c in spec.mandatory:
        rows = rows.filter(F.col(c).isNotNull())
    return trim_texts(rows, spec)


def trim_texts(df: DataFrame, spec: TableSpec) -> DataFrame:
    texts = present(df, spec.text)
    return df.withColumns({c: blank_to_null(F.col(c)) for c in texts}) if texts else df


def clean_missing_values(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Drop rows lacking a critical column, then fill flags and texts.

    Measurements are never imputed.
    """
    require_frame(df, "clean_missing_values")
    critical = present(df, spec.critical)
    return fill_defaults(df.dropna(subset=critical) if critical else df, spec)


def fill_defaults(df: DataFrame, spec: TableSpec) -> DataFrame:
    """NULL in numeric flags becomes 0, in text columns the default; other types are left alone."""
    types = {f.name: f.dataType for f in df.schema}
    flags = present(df, spec.flags)
    texts = {c: d for c, d in spec.text_defaults.items() if isinstance(types.get(c), T.StringType)}
    if flags:
        df = df.fillna(0, subset=flags)
    return df.fillna(texts) if texts else df


def label_losses(counted: DataFrame, spec: TableSpec) -> DataFrame:
    """Trim the texts of distinct rows (see `count_copies`) and say why a row goes.

    `_loss` is NULL for a row that `clean` and `clean_missing_values` keep,
    else the first reason that applies.
    """
    require_frame(counted, "label_losses")
    types = {f.name: f.dataType for f in counted.schema}
    reasons = [(f"missing_{c}", F.col(c).isNull()) for c in spec.mandatory]
    critical = [is_missing(F.col(c), types[c]) for c in present(counted, spec.critical)]
    if critical:
        reasons.append(("missing_critical", reduce(or_, critical)))
    reason = F.coalesce(*[F.when(hit, F.lit(name)) for name, hit in reasons])
    return trim_texts(counted, spec).withColumn(LOSS, reason)


def loss_counts(spec: TableSpec) -> dict[str, Column]:
    """Aggregates over `label_losses`: input rows, rows lost per reason, rows kept."""
    reasons = [f"missing_{c}" for c in spec.mandatory] + ["missing_critical"]
    return {
        "input": F.coalesce(F.sum(COPIES), F.lit(0)),
        "duplicates": F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)),
        **{r: F.count_if(F.col(LOSS) == r) for r in reasons},
        "kept": F.count_if(F.col(LOSS).isNull()),
    }


def row_loss(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Report `(reason, n_rows)`; each lost row counts once, under its first reason."""
    counts = loss_counts(spec)
    require_frame(df, "row_loss")
    totals = label_losses(count_copies(df), spec).agg(*[c.alias(name) for name, c in counts.items()])
    return totals.unpivot([], list(counts), "reason", "n_rows")
