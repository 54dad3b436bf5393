import json
from datetime import date

import pytest

from tamis import __main__ as cli
from tamis import ingest
from tests.test_operators import inspection


def test_transform(spark, tmp_path, capsys):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    ingest(inspection(spark, {"id": 1}, {"id": 1}, {"id": None}), bronze, "inspection", day=date(2026, 7, 29))
    cli.main(["transform", "--bronze", bronze, "--silver", silver, "--partition-by", "inspection_year"])
    result = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert (result["n_rows"], result["losses"]["duplicates"], result["losses"]["missing_id"]) == (1, 1, 1)
    assert spark.read.parquet(result["path"]).first()["inspection_year"] == 2026


def test_extract(spark, tmp_path, capsys, monkeypatch):
    asked = {}

    def table(session, url, name, **options):
        asked.update(url=url, name=name, **options)
        return inspection(session, {"id": 1})

    monkeypatch.setattr("tamis.plans.bronze.read_table", table)
    monkeypatch.setenv("JDBC_USER", "reader")
    monkeypatch.setenv("JDBC_PASSWORD", "secret")
    cli.main(["extract", "--url", "jdbc:mysql://db/x", "--bronze", str(tmp_path), "--day", "2026-07-29"])
    out = capsys.readouterr().out
    assert json.loads(out.splitlines()[-1]) == {"path": "inspection/ingest_date=2026-07-29", "n_rows": 1}
    assert asked["properties"] == {"user": "reader", "password": "secret"}
    assert (asked["partition_column"], asked["num_partitions"]) == ("id", 16)
    assert "secret" not in out


def test_arguments(capsys):
    with pytest.raises(SystemExit):
        cli.main(["transform", "--bronze", "b"])
    assert "--silver" in capsys.readouterr().err
