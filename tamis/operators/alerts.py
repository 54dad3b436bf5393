"""Alerts: runs of consecutive inspections of one equipment whose reading is above its limit.

The inspections of an equipment are taken by date, then key, then their readings. A
reading above its limit opens an alert for its feature, further ones in a row
belong to it, the first that isn't above (or is unknown) closes it. The definition is
this library's own.

Equipment may hold any share of the rows, so no task takes one whole. Rows are dealt out by
ranges of (equipment, date, ...): a range holds a stretch of one equipment or of
several. Runs within a stretch are found by themselves and written, so that every later
step sees the same stretches; only runs that touch the end of a stretch, two at most
for each, are compared with the next one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import staging_path
from ..spec import INSPECTION, TableSpec, require_frame
from .indicators import LIMITS

#: An alert whose peak is this many times its limit is critical.
CRITICAL = 1.1

_EQUIPMENT = ("equipment", "stretch")


def _readings(silver: DataFrame, spec: TableSpec, features: Mapping[str, float], equipment: str, moment: str) -> DataFrame:
    values = [F.col(f"{name}_max").alias(name) for name in features]
    rows = silver.select(F.col(equipment).alias("equipment"), F.col(moment).alias("at"), F.col(spec.key).alias("key"), *values)
    return rows.where("at IS NOT NULL")


def _stretches(rows: DataFrame, features: Mapping[str, float]) -> DataFrame:
    """Each row with its stretch and place there, and by feature the number of quiet rows up to it and in the whole stretch."""
    order = [F.col(c).asc_nulls_first() for c in ("at", "key", *features)]
    # equal rows have the same effect in any order, so that they may be cut apart
    spread = F.xxhash64(F.monotonically_increasing_id())
    ranged = rows.withColumn("_spread", spread).repartitionByRange(F.col("equipment").asc_nulls_first(), *order, "_spread")
    ranged = ranged.withColumn("stretch", F.spark_partition_id())
    ordered = Window.partitionBy(*_EQUIPMENT).orderBy(*order, "_spread")
    whole = Window.partitionBy(*_EQUIPMENT)
    quiet: dict[str, Column] = {name: F.when(_above(name, limit), 0).otherwise(1).cast("long") for name, limit in features.items()}
    sums = {f"{name}_quiet": F.sum(q).over(ordered.rowsBetween(Window.unboundedPreceding, 0)) for name, q in quiet.items()}
    totals = {f"{name}_total": F.sum(q).over(whole) for name, q in quiet.items()}
    return ranged.withColumns(sums | totals | {"place": F.row_number().over(ordered)})


def _above(name: str, limit: float) -> Column:
    return F.coalesce(F.col(name) > limit, F.lit(False))


def alerts(
    silver: DataFrame,
    spec: TableSpec = INSPECTION,
    *,
    limits: Mapping[str, float] = LIMITS,
    critical: float = CRITICAL,
    equipment: str = "instal",
    moment: str = "date",
) -> DataFrame:
    """One row for each alert: equipment, `feature`, `started`, `ended`, `n_inspections`, `peak`, `severity`.

    `limits` names features (a `<feature>_max` column each) and what alarms above. `severity` is
    `critical` from `critical` times the limit on, else `warning`. Rows without a date
    take no part; those without equipment are one of their own (NULL). Repeated rows count
    one by one.
    """
    require_frame(silver, "alerts")
    rows = _stretches(_readings(silver, spec, limits, equipment, moment), limits)

    def noted(when: Column, feature: str | None, value: Column, quiet: Column, total: Column) -> Column:
        kinds = {"feature": (F.lit(feature), "string"), "value": (value, "double"), "quiet": (quiet, "long"), "total": (total, "long")}
        return F.when(when, F.struct(*[c.cast(t).alias(n) for n, (c, t) in kinds.items()]))

    nothing = F.lit(None)
    hits = [noted(_above(f, limit), f, F.col(f), F.col(f"{f}_quiet"), F.col(f"{f}_total")) for f, limit in limits.items()]
    # the first row of a stretch also tells that there is one
    hits.append(noted(F.col("place") == 1, None, nothing, nothing, nothing))
    hit = rows.select(*_EQUIPMENT, "at", F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("hit"))
    runs = hit.groupBy(*_EQUIPMENT, "hit.feature", "hit.quiet", "hit.total").agg(
        F.min("at").alias("started"), F.max("at").alias("ended"), F.count("*").alias("n_inspections"), F.max("hit.value").alias("peak")
    )
    path = staging_path(silver.sparkSession, "alert-runs")
    runs.write.parquet(path)
    runs = silver.sparkSession.read.schema(runs.schema).parquet(path)
    # a run with no quiet row before it may go on from the stretch before, one with all of them into the next
    opens, goes_on = F.col("quiet") == 0, F.col("quiet") == F.col("total")
    stretches = runs.where("feature IS NULL")
    runs = runs.where("feature IS NOT NULL").withColumns({"opens": opens, "goes_on": goes_on})
    columns = ["equipment", "feature", "started", "ended", "n_inspections", "peak"]
    done = runs.where("NOT opens AND NOT goes_on").select(*columns)

    numbered = stretches.withColumn("n", F.row_number().over(Window.partitionBy("equipment").orderBy("stretch")))
    numbered = numbered.select(F.col("equipment").alias("e"), F.col("stretch").alias("s"), "n")
    loose = runs.where("opens OR goes_on")
    loose = loose.join(numbered, F.col("equipment").eqNullSafe(F.col("e")) & (F.col("stretch") == F.col("s")))
    before = Window.partitionBy("equipment", "feature").orderBy("n", "quiet")
    joins = F.coalesce((F.lag("n").over(before) == F.col("n") - 1) & F.lag("goes_on").over(before) & F.col("opens"), F.lit(False))
    chained = loose.withColumn("fresh", F.when(joins, 0).otherwise(1))
    chained = chained.withColumn("chain", F.sum("fresh").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    joined = chained.groupBy("equipment", "feature", "chain").agg(
        F.min("started").alias("started"), F.max("ended").alias("ended"), F.sum("n_inspections").alias("n_inspections"), F.max("peak").alias("peak")
    )
    found = done.unionByName(joined.select(*columns))
    bar = F.coalesce(*[F.when(F.col("feature") == name, F.lit(float(limit) * critical)) for name, limit in limits.items()])
    return found.withColumn("severity", F.when(F.col("peak") >= bar, "critical").otherwise("warning"))
