import os

import pytest

from tamis.errors import DataLakeConfigurationError
from tamis.session import session_settings, staging_path


def test_session_settings():
    store = {"s3_endpoint": "http://store:9000", "s3_access_key": "k", "s3_secret_key": "s"}
    settings = session_settings(**store, options={"a": "b"})
    assert settings["spark.sql.session.timeZone"] == "UTC"
    assert settings["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert settings["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert (settings["spark.hadoop.fs.s3a.access.key"], settings["a"]) == ("k", "b")
    assert not any("s3a" in key for key in session_settings())


def test_staging_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(DataLakeConfigurationError):
        staging_path(Session, "x")
    Conf.get = staticmethod(lambda key, default=None: "file:///tmp/x")
    with pytest.raises(DataLakeConfigurationError, match="file:///tmp/x"):
        staging_path(Session, "x")
    Conf.get = staticmethod(lambda key, default=None: "hdfs://host/x")
    assert staging_path(Session, "x").startswith("hdfs://host/x/x-")
    Conf.get = staticmethod(lambda key, default=None: default)
    assert staging_path(spark, "x") != staging_path(spark, "x")
    Context.master = "local[2]"
    assert os.path.isdir(os.path.dirname(staging_path(Session, "x")))
