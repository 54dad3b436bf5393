"""Inspection analytics on Spark: Bronze snapshots to trusted, feature-ready Silver tables."""

from .plans.bronze import extract, ingest
from .plans.silver import build_silver, silver_rows, transform
from .session import get_spark_session
from .spec import INSPECTION, TableSpec

__all__ = [
    "INSPECTION",
    "TableSpec",
    "build_silver",
    "extract",
    "get_spark_session",
    "ingest",
    "silver_rows",
    "transform",
]
