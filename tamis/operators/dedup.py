"""Exact duplicates: one row per distinct value, with the number of its copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import column

COPIES = "_copies"


def count_copies(df: DataFrame) -> DataFrame:
    """Distinct rows and `_copies`, combined before the shuffle: many copies of one row cost one row per task.

    Rows are equal as Spark groups them: collated texts by their collation, maps
    whatever the order of their entries.
    """
    return df.groupBy(*[column(c) for c in df.columns]).agg(F.count("*").alias(COPIES))
