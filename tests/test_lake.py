from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tamis.errors import (
    DataLakeBucketNotFoundError,
    DataLakeReadError,
    DataLakeWriteError,
    NoPartitionFoundError,
    SourceDBConnectionError,
    SourceDBQueryError,
)
from tamis.plans.bronze import extract, ingest
from tamis.sources import jdbc, lake
from tests.test_operators import inspection

DAY = date(2026, 7, 29)


def write(spark, path, n=3):
    spark.range(n).coalesce(1).write.parquet(str(path))


@pytest.mark.parametrize(
    "layout, expected", [("ymd", "inspection/2026/07/09"), ("ingest_date", "inspection/ingest_date=2026-07-09")]
)
def test_snapshot_path(layout, expected):
    assert lake.snapshot_path("inspection", date(2026, 7, 9), layout) == expected
    assert lake.snapshot_path("inspection", None, "ymd") == f"inspection/{datetime.now(UTC):%Y/%m/%d}"


def test_unknown_layout_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="hive"):
        lake.snapshot_path("inspection", DAY, "hive")
    with pytest.raises(ValueError, match="hive"):
        lake.latest_snapshot(spark, str(tmp_path), "inspection", "hive")


def test_latest_snapshot_ignores_what_is_no_date(spark, tmp_path):
    for path in (
        "inspection/2025/12/31",
        "inspection/2026/07/28",
        "inspection/2026/07/29",
        "inspection/2026/02/30",
        "inspection/2026/13/01",
        "inspection/0000/01/01",
        "inspection/12026/01/01",
        "inspection/junk/x/y",
        "inspection/2027/01",
        "inspection_archive/2030/01/01",
    ):
        write(spark, tmp_path / path)
    found = lake.latest_snapshot(spark, str(tmp_path), "inspection", "ymd")
    assert (found.date, found.path, found.n_files) == (DAY, "inspection/2026/07/29", 1)
    assert found.n_bytes > 0
    assert len(lake.snapshot_days(spark, str(tmp_path), "inspection", "ymd")) == 3


def test_latest_snapshot_compares_dates_not_names(spark, tmp_path):
    for path in ("t/2026/9/30", "t/2026/10/01", "t/2026/1/31"):
        write(spark, tmp_path / path)
    assert lake.latest_snapshot(spark, str(tmp_path), "t", "ymd").path == "t/2026/10/01"


def test_latest_snapshot_counts_nested_files(spark, tmp_path):
    write(spark, tmp_path / "t/2026/01/01/batch/part")
    assert lake.latest_snapshot(spark, f"file://{tmp_path}/", "t", "ymd").path == "t/2026/01/01"


def test_latest_snapshot_needs_a_file(spark, tmp_path):
    write(spark, tmp_path / "t/ingest_date=2026-07-28")
    (tmp_path / "t/ingest_date=2026-07-29").mkdir()
    (tmp_path / "t/ingest_date=2026-07-30").write_text("no directory")
    assert lake.latest_snapshot(spark, str(tmp_path), "t").date == date(2026, 7, 28)


def test_root_with_pattern_characters(spark, tmp_path):
    root = tmp_path / "a+b (1)" / "t"
    write(spark, root / "t/2026/01/01")
    assert lake.latest_snapshot(spark, str(root), "t", "ymd").path == "t/2026/01/01"


def test_table_name_with_a_slash_has_no_snapshot(spark, tmp_path):
    write(spark, tmp_path / "a/b/2026/01/01")
    with pytest.raises(NoPartitionFoundError):
        lake.latest_snapshot(spark, str(tmp_path), "a/b", "ymd")


def test_no_root(spark, tmp_path):
    with pytest.raises(DataLakeBucketNotFoundError):
        lake.latest_snapshot(spark, str(tmp_path / "absent"), "inspection")


def test_no_snapshot(spark, tmp_path):
    with pytest.raises(NoPartitionFoundError, match="absent"):
        lake.latest_snapshot(spark, str(tmp_path), "absent")
    write(spark, tmp_path / "t/junk")
    with pytest.raises(NoPartitionFoundError):
        lake.latest_snapshot(spark, str(tmp_path), "t")


@pytest.mark.parametrize("layout", ["ymd", "ingest_date"])
def test_bronze_replaces_the_day_and_keeps_others(spark, tmp_path, layout):
    root = str(tmp_path)
    ingest(inspection(spark, {"id": 1}), root, "inspection", day=date(2026, 7, 28), layout=layout)
    ingest(inspection(spark, {"id": 2}, {"id": 3}), root, "inspection", day=DAY, layout=layout)
    result = ingest(inspection(spark, {"id": 4}), root, "inspection", day=DAY, layout=layout)
    assert (result.n_rows, result.written) == (1, True)
    assert [r["id"] for r in lake.read_bronze_parquet(spark, f"{root}/{result.path}").collect()] == [4]
    assert len(lake.snapshot_days(spark, root, "inspection", layout)) == 2


def test_a_failing_write_leaves_the_day_in_place(spark, tmp_path):
    root = str(tmp_path)
    result = ingest(inspection(spark, {"id": 1}), root, "inspection", day=DAY)
    fails_later = spark.range(1000).repartition(2).select(
        F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id")
    )
    with pytest.raises(DataLakeWriteError):
        ingest(fails_later, root, "inspection", day=DAY)
    assert [r["id"] for r in lake.read_bronze_parquet(spark, f"{root}/{result.path}").collect()] == [1]


def test_empty_bronze_writes_nothing(spark, tmp_path):
    root = str(tmp_path)
    ingest(inspection(spark, {"id": 1}), root, "inspection", day=DAY)
    result = ingest(inspection(spark, {"id": 1}).limit(0), root, "inspection", day=DAY)
    assert (result.n_rows, result.written) == (0, False)
    assert lake.read_bronze_parquet(spark, f"{root}/{result.path}").count() == 1


def test_hive_layout_reads_as_a_partitioned_table(spark, tmp_path):
    for day in (date(2026, 7, 28), DAY):
        ingest(inspection(spark, {}), str(tmp_path), "inspection", day=day)
    table = spark.read.parquet(f"{tmp_path}/inspection").filter(F.col("ingest_date") == DAY)
    assert table.count() == 1
    assert "PartitionFilters: [isnotnull(ingest_date" in table._jdf.queryExecution().toString()


def test_a_bronze_source_is_read_once_and_dates_are_optional(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)
    rows = spark.sparkContext.parallelize([("2026-07-29 08:30:00",)], 1).map(lambda r: reads.add(1) or r)
    df = spark.createDataFrame(rows, "date string")
    result = ingest(df, str(tmp_path), "inspection", day=DAY, date_columns=())
    assert reads.value == 1
    assert dict(lake.read_bronze_parquet(spark, f"{tmp_path}/{result.path}").dtypes)["date"] == "string"


def test_read_errors(spark, tmp_path):
    for path in ("", "  ", None):
        with pytest.raises(ValueError):
            lake.read_bronze_parquet(spark, path)
    with pytest.raises(DataLakeReadError):
        lake.read_bronze_parquet(spark, str(tmp_path / "absent"))


def test_write_modes(spark, tmp_path):
    path, one = str(tmp_path / "t"), spark.range(1)
    lake.write_silver_parquet(one, path)
    lake.write_silver_parquet(one, path, "APPEND")
    lake.write_silver_parquet(one, path, "ignore")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(DataLakeWriteError):
        lake.write_silver_parquet(one, path, "error")
    lake.write_silver_parquet(one, path, "Overwrite")
    assert spark.read.parquet(path).count() == 1


def test_write_arguments(spark, tmp_path):
    with pytest.raises(ValueError, match="empty"):
        lake.write_silver_parquet(spark.range(1), " ")
    with pytest.raises(ValueError, match="upsert"):
        lake.write_silver_parquet(spark.range(1), str(tmp_path / "t"), "upsert")


def test_partitioned_write_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.write_silver_parquet(spark.range(9).withColumn("p", F.col("id") % 3), path, partition_by=["p"])
    one = spark.range(1).withColumn("p", F.lit(2))
    lake.write_silver_parquet(one, path, partition_by=["p"], replace_partitions=True)
    counts = {r["p"]: r["count"] for r in spark.read.parquet(path).groupBy("p").count().collect()}
    assert counts == {0: 3, 1: 3, 2: 1}
    lake.write_silver_parquet(one, path, partition_by=["p"])
    assert spark.read.parquet(path).count() == 1


def test_a_partition_holding_most_rows_is_written_by_several_tasks(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = spark.range(200_000).repartition(8).withColumn("p", F.when(F.col("id") % 50 == 0, F.col("id") % 3).otherwise(9))
    before = spark.conf.get(size)
    spark.conf.set(size, "200k")
    try:
        lake.write_silver_parquet(rows, str(tmp_path / "t"), partition_by=["p"])
    finally:
        spark.conf.set(size, before)
    files = {part.name: len(list(part.glob("*.parquet"))) for part in (tmp_path / "t").glob("p=*")}
    assert files.pop("p=9") > 1
    assert 1 in files.values()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


# --- relational source: everything up to the connection ----------------------


@pytest.mark.parametrize("name", ["inspection; DROP TABLE x", "a b", "", "1a", "a`b", "a.b"])
def test_table_guard(spark, name):
    with pytest.raises(ValueError, match="Invalid table name"):
        jdbc.read_table(spark, "jdbc:mysql://db/x", name)


def test_column_guard(spark):
    with pytest.raises(ValueError, match="Invalid column name"):
        jdbc.read_table(spark, "jdbc:mysql://db/x", "inspection", partition_column="id) --")


def test_bounds_query():
    assert jdbc.bounds_query("jdbc:mysql://db/x", "t", "id") == "SELECT MIN(`id`) AS lo, MAX(`id`) AS hi FROM `t`"
    assert jdbc.bounds_query("jdbc:postgresql://db/x", "t", "id") == "SELECT MIN(id) AS lo, MAX(id) AS hi FROM t"


def test_range_predicates():
    assert jdbc.range_predicates("id", None, None, 8) == ["id IS NULL"]
    assert jdbc.range_predicates("id", 5, 5, 8) == ["id IS NOT NULL", "id IS NULL"]
    assert jdbc.range_predicates("id", 1, 900, 3) == ["id < 301", "id >= 301 AND id < 601", "id >= 601", "id IS NULL"]
    days = jdbc.range_predicates("day", date(2026, 1, 1), date(2026, 1, 5), 2)
    assert days == ["day < '2026-01-03'", "day >= '2026-01-03'", "day IS NULL"]


@pytest.mark.parametrize("parts", [1, 2, 7, 50])
def test_every_row_is_in_one_range(spark, parts):
    rows = spark.createDataFrame([(i,) for i in [*range(-3, 30), None]], "id int")
    conditions = jdbc.range_predicates("id", -2, 25, parts)
    assert sorted(r.n for r in rows.selectExpr(" + ".join(f"int(coalesce({c}, false))" for c in conditions) + " AS n").collect()) == [1] * 34


def test_dates_are_parsed_on_ingest(spark):
    df = spark.createDataFrame([("2026-07-29 08:30:00",), ("pas une date",), (None,)], "date string").coalesce(1)
    parsed = jdbc.parse_dates(df)
    assert dict(parsed.dtypes) == {"date": "timestamp"}
    assert [r["date"] for r in parsed.collect()] == [datetime(2026, 7, 29, 8, 30), None, None]
    assert jdbc.parse_dates(spark.range(1)).columns == ["id"]


def test_extract_stores_what_the_table_holds(spark, tmp_path, monkeypatch):
    asked = {}

    def table(session, url, name, **options):
        asked.update(url=url, name=name, **options)
        return inspection(session, {"id": 1}, {"id": 2})

    monkeypatch.setattr("tamis.plans.bronze.read_table", table)
    result = extract(spark, "jdbc:mysql://db/x", "inspection", str(tmp_path), day=DAY, num_partitions=4)
    assert asked == {"url": "jdbc:mysql://db/x", "name": "inspection", "num_partitions": 4, "date_columns": ()}
    assert result.n_rows == lake.read_bronze_parquet(spark, f"{tmp_path}/{result.path}").count() == 2


@pytest.mark.parametrize("options", [{}, {"partition_column": None}, {"predicates": ["id < 5", "id >= 5"]}])
def test_a_database_that_cannot_be_reached(spark, options):
    with pytest.raises(SourceDBConnectionError, match="inspection"):
        jdbc.read_table(spark, "jdbc:nosuch:db", "inspection", **options)


def test_other_failures_of_a_read(spark):
    with pytest.raises(SourceDBQueryError, match="inspection"):
        jdbc.read_table(spark, "jdbc:nosuch:db", "inspection", properties={"driver": "no.such.Driver"})


def test_bronze_keeps_raw_column_names(spark, tmp_path):
    raw = spark.range(1).selectExpr("id AS ` T-AV (°C) `", "id AS `Date, heure; a=b`", "id AS `x.y`")
    for layout in ("ymd", "ingest_date"):
        result = ingest(raw, str(tmp_path), "inspection", day=DAY, layout=layout)
        assert lake.read_bronze_parquet(spark, f"{tmp_path}/{result.path}").columns == raw.columns
