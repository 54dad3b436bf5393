"""Written tables between the passes of an operator, in the folder that the cluster shares.

A result may read its tables long after an operator has returned, so operators
delete only what they no longer need themselves; who has written a result out
can `delete` the tables that were `recorded` while it was made.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tamis.session import staging_path

_local = threading.local()


@contextmanager
def recorded() -> Iterator[dict[str, str | None]]:
    """The tables that this thread writes meanwhile: by path, the name of those that the catalog knows."""
    stack = _local.__dict__.setdefault("stack", [])
    stack.append({})
    try:
        yield stack[-1]
    finally:
        stack.pop()


def _note(path: str, table: str | None = None) -> None:
    for tables in _local.__dict__.get("stack", ()):
        tables[path] = table


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written once and read back, so that what follows never computes them again."""
    path = staging_path(df.sparkSession, name)
    _note(path)
    df.write.option("compression", "zstd").parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._scratch = path
    return found


def written_by_key(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like `written`, in buckets by key, so that a join on it moves only the other side."""
    spark, path = df.sparkSession, staging_path(df.sparkSession, name)
    table = f"{name}_{uuid.uuid4().hex}"
    _note(path, table)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, key).option("compression", "zstd").option("path", path).saveAsTable(table)
    return spark.table(table)


def drop(df: DataFrame) -> None:
    """Delete a table from `written` that nothing reads any more."""
    delete(df.sparkSession, {df._scratch: None})


def delete(spark: SparkSession, tables: dict[str, str | None]) -> None:
    """Delete recorded tables; those that are gone are passed over."""
    for path, table in tables.items():
        if table:
            spark.sql(f"DROP TABLE IF EXISTS `{table}`")
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
