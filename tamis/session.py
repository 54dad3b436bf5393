"""Session construction, and the folder for intermediate tables."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

from .errors import DataLakeConfigurationError

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # HotSpot never compiles a method beyond 8000 bytes; wider stages then run operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def session_settings(
    *,
    s3_endpoint: str | None = None,
    s3_access_key: str | None = None,
    s3_secret_key: str | None = None,
    options: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Spark settings: UTC, adaptive, dynamic partition overwrite, an S3A store if given.

    Without keys, S3A's own credential chain applies. `options` win.
    """
    settings = dict(_DEFAULTS)
    if s3_endpoint:
        settings |= {
            "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
            "spark.hadoop.fs.s3a.endpoint": s3_endpoint,
            "spark.hadoop.fs.s3a.path.style.access": "true",
            "spark.hadoop.fs.s3a.connection.ssl.enabled": str(s3_endpoint.startswith("https:")).lower(),
        }
    if s3_access_key and s3_secret_key:
        settings |= {
            "spark.hadoop.fs.s3a.access.key": s3_access_key,
            "spark.hadoop.fs.s3a.secret.key": s3_secret_key,
        }
    return settings | dict(options or {})


def get_spark_session(app_name: str, *, hive: bool = False, **settings) -> SparkSession:
    """Create or fetch the session with `session_settings`; `hive` turns on the Hive catalog."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in session_settings(**settings).items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tamis-")


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder the cluster shares (`spark.checkpoint.dir`).

    Only a local-mode session may do without that setting, or give it a `file:`
    path: on a cluster other executors could not see those files.
    """
    root = spark.conf.get(_CHECKPOINT_DIR, None)
    if (not root or root.startswith("file:")) and not spark.sparkContext.master.startswith("local"):
        raise DataLakeConfigurationError({_CHECKPOINT_DIR: f"{root or 'unset'}; it must be a folder all executors share"})
    root = root or _local_folder()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
