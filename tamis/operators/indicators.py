"""Maintenance indicators of equipment: how often it is inspected, and how often that finds something.

Definitions, all of them this library's own, over trusted (Silver) rows of one group:

    n_inspections      rows
    first_seen, last_seen
                       earliest and latest inspection
    mean_gap_hours     mean time between two inspections in a row; NULL with fewer than two dates
    n_hot              rows whose hottest measurement is above the limit of its feature
    n_shaking          rows whose strongest vibration is above its limit
    n_flagged          rows with a condition flag set
    n_alarming         rows with any of these three
    alarm_ratio        n_alarming / n_inspections
    temperature_peak, vibration_peak
                       highest values
    temperature_mean   mean of the rows' mean temperatures, where known

Groups are each equipment and month, each equipment, each month, and everything.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import INSPECTION, TableSpec, present, require_frame

#: Above these a reading alarms, by feature; a spec's ranges say what is a reading at all.
LIMITS: Mapping[str, float] = {"temperature": 80.0, "vibration": 4.5}

_COUNTS = ("n_inspections", "n_hot", "n_shaking", "n_flagged", "n_alarming", "n_dated", "n_measured")


def _alarms(df: DataFrame, spec: TableSpec, limits: Mapping[str, float]) -> dict[str, Column]:
    flags = [F.col(c) == 1 for c in present(df, spec.flags)]
    found = {
        "hot": F.col("temperature_max") > limits["temperature"],
        "shaking": F.col("vibration_max") > limits["vibration"],
        "flagged": reduce(or_, flags) if flags else F.lit(False),
    }
    return {name: F.coalesce(hit, F.lit(False)) for name, hit in found.items()}


def indicators(
    silver: DataFrame, spec: TableSpec = INSPECTION, *, limits: Mapping[str, float] = LIMITS, equipment: str = "instal", moment: str = "date"
) -> DataFrame:
    """One row for each group: `level` (equipment_month, equipment, month or all), equipment, `month` (its first day), and the figures.

    Rows are summed up by equipment and month within each task before they are
    shuffled, so equipment with a third of all rows sends one row per month and task;
    the wider groups are made from those sums. A row without equipment or date counts in a
    group of its own (NULL), told from the wider levels by `level`.
    """
    require_frame(silver, "indicators")
    alarms = _alarms(silver, spec, limits)
    rows = silver.select(
        F.col(equipment).alias("equipment"),
        F.trunc(F.col(moment).cast("date"), "month").alias("month"),
        F.col(moment).alias("at"),
        "temperature_max",
        "temperature_mean",
        "vibration_max",
        *[hit.alias(name) for name, hit in alarms.items()],
    )
    fine = rows.groupBy("equipment", "month").agg(
        F.count("*").alias("n_inspections"),
        F.count_if("hot").alias("n_hot"),
        F.count_if("shaking").alias("n_shaking"),
        F.count_if("flagged").alias("n_flagged"),
        F.count_if(F.col("hot") | F.col("shaking") | F.col("flagged")).alias("n_alarming"),
        F.count("at").alias("n_dated"),
        F.count("temperature_mean").alias("n_measured"),
        F.sum("temperature_mean").alias("temperature_sum"),
        F.min("at").alias("first_seen"),
        F.max("at").alias("last_seen"),
        F.max("temperature_max").alias("temperature_peak"),
        F.max("vibration_max").alias("vibration_peak"),
    )
    keys = [F.col("equipment"), F.col("month")]
    wide = fine.groupingSets([keys, keys[:1], keys[1:], []], *keys).agg(
        F.grouping_id("equipment", "month").alias("coarse"),
        *[F.sum(c).alias(c) for c in _COUNTS],
        F.sum("temperature_sum").alias("temperature_sum"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.max("temperature_peak").alias("temperature_peak"),
        F.max("vibration_peak").alias("vibration_peak"),
    )
    level = F.element_at(F.array(*[F.lit(x) for x in ("equipment_month", "equipment", "month", "all")]), (F.col("coarse") + 1).cast("int"))
    hours = (F.unix_micros(F.col("last_seen").cast("timestamp")) - F.unix_micros(F.col("first_seen").cast("timestamp"))) / F.lit(3.6e9)
    return wide.where("n_inspections IS NOT NULL").select(
        level.alias("level"),
        "equipment",
        "month",
        *_COUNTS[:5],
        (F.col("n_alarming") / F.col("n_inspections")).alias("alarm_ratio"),
        "first_seen",
        "last_seen",
        F.when(F.col("n_dated") > 1, hours / (F.col("n_dated") - 1)).alias("mean_gap_hours"),
        "temperature_peak",
        "vibration_peak",
        F.when(F.col("n_measured") > 0, F.col("temperature_sum") / F.col("n_measured")).alias("temperature_mean"),
    )
