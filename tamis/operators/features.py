"""Derived columns: comparisons of paired and two-sided measurements, calendar parts.

A maximum skips NULLs while a mean or difference is NULL if any input is.
Sums add in the listed order, so doubles come out the same everywhere.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import TableSpec, require_frame


def _mean(columns: Iterable[str]) -> Column:
    terms = [F.col(c) for c in columns]
    return reduce(add, terms) / F.lit(float(len(terms)))


def _require(df: DataFrame, columns: Iterable[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing {what} columns: {', '.join(missing)}.")


def pair_features(prefix: str, first: str, second: str) -> dict[str, Column]:
    a, b = F.col(first), F.col(second)
    return {
        f"{prefix}_max": F.greatest(a, b),
        f"{prefix}_mean": _mean([first, second]),
        f"{prefix}_difference": F.abs(a - b),
    }


def side_features(prefix: str, sides: Mapping[str, tuple[str, ...]]) -> dict[str, Column]:
    everything = [c for columns in sides.values() for c in columns]
    left, right = (_mean(columns) for columns in sides.values())
    return {
        **{f"{prefix}_{side}_max": F.greatest(*columns) for side, columns in sides.items()},
        f"{prefix}_max": F.greatest(*everything),
        **{f"{prefix}_{side}_mean": _mean(columns) for side, columns in sides.items()},
        f"{prefix}_mean": _mean(everything),
        f"{prefix}_side_difference": F.abs(left - right),
    }


def calendar_features(prefix: str, timestamp: str) -> dict[str, Column]:
    moment = F.col(timestamp)
    return {
        f"{prefix}_year": F.year(moment),
        f"{prefix}_month": F.month(moment),
        f"{prefix}_day": F.day(moment),
    }


def enrich_temperature_features(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Maximum, mean and absolute difference of each declared pair."""
    require_frame(df, "enrich_temperature_features")
    features = {}
    for prefix, (first, second) in spec.pairs.items():
        _require(df, (first, second), prefix)
        features |= pair_features(prefix, first, second)
    return df.withColumns(features)


def enrich_vibration_features(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Maxima and means per side and overall, and the difference of the side means."""
    require_frame(df, "enrich_vibration_features")
    features = {}
    for prefix, sides in spec.sides.items():
        _require(df, (c for columns in sides.values() for c in columns), prefix)
        features |= side_features(prefix, sides)
    return df.withColumns(features)


def enrich_temporal_features(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Year, month and day of month."""
    require_frame(df, "enrich_temporal_features")
    features = {}
    for prefix, timestamp in spec.calendar.items():
        _require(df, [timestamp], prefix)
        features |= calendar_features(prefix, timestamp)
    return df.withColumns(features)


def enrich(df: DataFrame, spec: TableSpec) -> DataFrame:
    """All features; the source columns stay as they are."""
    require_frame(df, "enrich")
    for step in (enrich_temperature_features, enrich_vibration_features, enrich_temporal_features):
        df = step(df, spec)
    return df
