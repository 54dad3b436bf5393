"""Declarative description of a table: what the operators need to know about it.

Operators take `(df, spec)` and work on the spec columns that `df` has, so the
same code serves any table; `INSPECTION` describes conveyor inspections.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: Mapping[str, T.DataType]
    """Required columns with the type each has once standardised."""
    key: str
    mandatory: tuple[str, ...] = ()
    """Checked for NULL on the raw value, in this order, before any trimming."""
    critical: tuple[str, ...] = ()
    """Checked for NULL after blank texts became NULL."""
    text: tuple[str, ...] = ()
    upper: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    text_defaults: Mapping[str, str] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    """Closed interval per measurement."""
    null_exempt: tuple[str, ...] = ()
    max_null_ratio: float = 0.3
    pairs: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    """Feature prefix -> two measurements to compare."""
    sides: Mapping[str, Mapping[str, tuple[str, ...]]] = field(default_factory=dict)
    """Feature prefix -> side name -> the measurements of that side (two sides)."""
    calendar: Mapping[str, str] = field(default_factory=dict)
    """Feature prefix -> timestamp column."""


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """Those of `columns` that `df` has, in the given order."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def column(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def require_frame(df: DataFrame | None, step: str) -> None:
    if df is None:
        raise ValueError(f"{step}: the DataFrame is None.")


# Fixed values, to the end of the file: names, types, defaults, ranges and the NULL limit of inspections.
_INT, _DOUBLE, _STRING, _TIMESTAMP = T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampType()

_FLAGS = ("p_produit", "huile_graisse", "ailette", "boulonneries", "cable", "plaque_a_borne", "graisseur")
_TEMPERATURES = ("t_av", "t_ar")
_FRONT = ("av_ax", "av_h", "av_v")
_REAR = ("ar_ax", "ar_h", "ar_v")

INSPECTION = TableSpec(
    name="inspection",
    columns={
        "id": _INT,
        "date": _TIMESTAMP,
        "zone": _STRING,
        "instal": _STRING,
        **dict.fromkeys(_FLAGS, _INT),
        **dict.fromkeys(_TEMPERATURES + _FRONT + _REAR, _DOUBLE),
        "observation": _STRING,
        "action": _STRING,
        "utilisateur": _STRING,
    },
    key="id",
    mandatory=("id", "date"),
    critical=("id", "date", "zone", "instal"),
    text=("zone", "instal", "observation", "action", "utilisateur"),
    upper=("instal",),
    flags=_FLAGS,
    text_defaults={
        "observation": "non renseignee",
        "action": "aucune action renseignee",
        "utilisateur": "inconnu",
    },
    ranges={**dict.fromkeys(_TEMPERATURES, (0, 120)), **dict.fromkeys(_FRONT + _REAR, (0, 50))},
    null_exempt=("observation", "action"),
    max_null_ratio=0.3,
    pairs={"temperature": _TEMPERATURES},
    sides={"vibration": {"av": _FRONT, "ar": _REAR}},
    calendar={"inspection": "date"},
)
