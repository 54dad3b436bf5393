"""Versioned tables under crashes, races and readers; plain tables while staged, moved aside and leased."""

import os
import threading
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tamis.errors import DataLakeReadError, DataLakeWriteError, InvalidNumericRangeError
from tamis.plans.bronze import ingest
from tamis.plans.silver import build_silver, rejected_rows, transform
from tamis.sources import lake, versions
from tests.test_lake import DAY
from tests.test_operators import inspection


def ids(df):
    return sorted(r[0] for r in df.select(df.columns[0]).collect())


def test_versions_follow_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not versions.is_versioned(spark, path)
    with pytest.raises(DataLakeReadError, match="no version"):
        versions.version(spark, path)
    for n in (1, 2, 3):
        assert versions.write_version(spark.range(n), path).number == n
    assert ids(versions.read_version(spark, path)) == [0, 1, 2]
    assert ids(versions.read_version(spark, path, 1)) == [0]
    with pytest.raises(DataLakeReadError):
        versions.version(spark, path, 9)
    assert versions.write_version(spark.range(10, 12), path, "append").number == 4
    assert ids(lake.read_bronze_parquet(spark, path)) == [0, 1, 2, 10, 11]
    assert versions.write_version(spark.range(0), path).number == 5
    empty = versions.read_version(spark, path)
    assert empty.columns == ["id"] and empty.count() == 0


def test_partitions_are_replaced_within_a_version(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *pairs: spark.createDataFrame(pairs, "id long, p long, q string")
    write = lambda df, **kw: versions.write_version(df, path, partition_by=["p", "q"], **kw)
    write(rows((1, 1, "a"), (2, 1, "b=c"), (3, 2, None)))
    write(rows((9, 1, "b=c"), (8, 5, "a")), replace_partitions=True)
    found = lambda n=None: sorted((tuple(r) for r in versions.read_version(spark, path, n).select("id", "p", "q").collect()), key=repr)
    assert found() == [(1, 1, "a"), (3, 2, None), (8, 5, "a"), (9, 1, "b=c")]
    write(rows((7, 2, None)), replace_partitions=True)
    assert found() == [(1, 1, "a"), (7, 2, None), (8, 5, "a"), (9, 1, "b=c")]
    write(rows((6, 1, "a"), (5, 2, None), (4, 5, "a")), replace_partitions=True)
    assert found() == [(4, 5, "a"), (5, 2, None), (6, 1, "a"), (9, 1, "b=c")]
    assert found(1) == [(1, 1, "a"), (2, 1, "b=c"), (3, 2, None)]


STEPS = ["lake.write_parquet", "versions.put_if_absent", "versions._partitions"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_a_crash_at_any_step_leaves_the_old_rows_or_the_new(spark, tmp_path, monkeypatch, step, after):
    path = str(tmp_path / "t")
    old, new = spark.range(2).withColumn("p", F.lit(1)), spark.range(5, 6).withColumn("p", F.lit(1))
    versions.write_version(old, path, partition_by=["p"])
    module = {"lake": lake, "versions": versions}[step.split(".")[0]]
    real = getattr(module, step.split(".")[1])

    class Killed(BaseException):
        pass

    def dies(*args, **kwargs):
        if after:
            real(*args, **kwargs)
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(module, step.split(".")[1], dies)
        with pytest.raises(Killed):
            versions.write_version(new, path, partition_by=["p"], replace_partitions=True)
    committed = after and step == "versions.put_if_absent"
    assert ids(versions.read_version(spark, path)) == ([5] if committed else [0, 1])
    made = versions.write_version(new, path, partition_by=["p"])
    assert made.number == 3 if committed else made.number == 2
    left = versions.vacuum(spark, path, keep=1)
    assert len(left) == (1 if step == "lake.write_parquet" and not after else 2)
    assert ids(versions.read_version(spark, path)) == [5] and len(os.listdir(tmp_path / "t" / "_versions")) == 1


def test_a_draft_of_a_manifest_is_no_version(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write_version(spark.range(1), path)
    for name in (".0f.000000000002", "000000000003.tmp", "notes"):
        (tmp_path / "t" / "_commits" / name).write_text("{")
    assert versions.version(spark, path).number == 1


def test_of_two_writers_one_commits(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write_version(spark.range(1), path)
    one, two = versions.stage(spark.range(2), path), versions.stage(spark.range(3), path)
    assert versions.commit(spark, path, two).number == 2
    with pytest.raises(DataLakeWriteError, match="meanwhile"):
        versions.commit(spark, path, one)
    assert ids(versions.read_version(spark, path)) == [0, 1, 2]
    # what the loser has staged can never be committed, so it may go
    assert versions.vacuum(spark, path, keep=2) == [one.folder]


def test_many_writers_at_once(spark, tmp_path):
    path, done = str(tmp_path / "t"), []
    staged = [versions.stage(spark.range(n, n + 1), path) for n in range(6)]
    gate = threading.Barrier(len(staged))

    def run(n):
        gate.wait()
        try:
            versions.commit(spark, path, staged[n])
            done.append(n)
        except DataLakeWriteError:
            pass

    threads = [threading.Thread(target=run, args=(n,)) for n in range(len(staged))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(done) == 1 and ids(versions.read_version(spark, path)) == done


def test_readers_during_publishing_see_whole_versions(spark, tmp_path):
    path, seen, failed, stop = str(tmp_path / "t"), set(), [], threading.Event()
    versions.write_version(spark.range(100).withColumn("v", F.lit(0)), path)

    def reads():
        while not stop.is_set():
            try:
                seen.add(tuple(versions.read_version(spark, path).agg(F.count("*"), F.min("v"), F.max("v")).first()))
            except Exception as e:
                failed.append(e)

    reader = threading.Thread(target=reads)
    reader.start()
    for v in range(1, 6):
        versions.write_version(spark.range(100 + v).withColumn("v", F.lit(v)), path)
    stop.set()
    reader.join()
    assert not failed and seen <= {(100 + v, v, v) for v in range(6)}


def test_vacuum_spares_readers_of_kept_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2, 3, 4):
        versions.write_version(spark.range(n), path)
    held = versions.read_version(spark, path, 3)
    next_one = versions.stage(spark.range(9), path)
    assert len(versions.vacuum(spark, path, keep=2)) == 2
    assert ids(held) == [0, 1, 2]
    assert versions.commit(spark, path, next_one).number == 5
    with pytest.raises(ValueError):
        versions.vacuum(spark, path, keep=0)
    assert versions.vacuum(spark, str(tmp_path / "none")) == []


def test_put_if_absent(spark, tmp_path):
    place = str(tmp_path / "a" / "b=c" / "note")
    assert versions.put_if_absent(spark, place, "é\n") and not versions.put_if_absent(spark, place, "other")
    assert versions.read_text(spark, place) == "é\n"
    assert os.listdir(tmp_path / "a" / "b=c") == ["note"]


# --- Bronze and Silver as versions ---------------------------------------------


def test_bronze_and_silver_versions(spark, inspections, tmp_path):
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    ingest(inspection(spark, {"id": 1}), bronze, "inspection", day=DAY, versioned=True)
    ingest(inspections, bronze, "inspection", day=DAY)
    assert ingest(inspections.limit(0), bronze, "inspection", day=DAY).written is False
    plain = build_silver(inspections, f"{tmp_path}/plain")
    first = transform(spark, bronze, silver, versioned=True)
    assert (first.version, first.losses, first.nulls, first.ranges) == (1, plain.losses, plain.nulls, plain.ranges)
    rows = lake.read_bronze_parquet(spark, first.path)
    expected = spark.read.parquet(plain.path)
    assert rows.columns == expected.columns and rows.exceptAll(expected).count() == expected.exceptAll(rows).count() == 0
    lost = {r.reason: r.n for r in rejected_rows(spark, first.path).groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert lost == {k: n for k, n in first.losses.items() if k.startswith("missing") and n}
    assert versions.version(spark, first.path).figures == dict(first.losses)
    again = transform(spark, bronze, silver, mode="append")
    assert again.version == 2 and lake.read_bronze_parquet(spark, first.path).count() == 2 * rows.count()
    assert not transform(spark, bronze, silver, mode="ignore").written
    with pytest.raises(DataLakeWriteError):
        transform(spark, bronze, silver, mode="error")


def test_failing_gates_commit_no_version(spark, tmp_path):
    path = str(tmp_path / "silver")
    with pytest.raises(InvalidNumericRangeError, match="t_av: 1 "):
        build_silver(inspection(spark, {"t_av": 121.0}), path, versioned=True)
    assert not versions.is_versioned(spark, path)
    assert build_silver(inspection(spark, {"id": 1}), path, mode="error", versioned=True).version == 1
    with pytest.raises(InvalidNumericRangeError):
        build_silver(inspection(spark, {"t_av": 121.0}), path)
    assert ids(lake.read_bronze_parquet(spark, path)) == [1] and len(os.listdir(f"{path}/_versions")) == 1


def test_rejected_rows_replace_no_partition(spark, tmp_path):
    path, months = str(tmp_path / "silver"), ("inspection_year", "inspection_month")
    early, late = {"id": 1, "date": datetime(2026, 1, 5)}, {"id": 2, "date": datetime(2026, 2, 5)}
    build_silver(inspection(spark, early, late), path, partition_by=months, versioned=True)
    rejected = {"id": 3, "zone": " ", "date": datetime(2026, 1, 9)}
    build_silver(inspection(spark, {**late, "id": 4}, rejected), path, partition_by=months, replace_partitions=True)
    assert ids(lake.read_bronze_parquet(spark, path).select("id")) == [1, 4]
    assert [r.reason for r in rejected_rows(spark, path).collect()] == ["missing_critical"]


def jobs(spark, run):
    group = f"jobs-{time.time()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        run()
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_versioned_run_needs_few_jobs(spark, inspections, tmp_path):
    lake_root = f"{tmp_path}/bronze"
    ingest(inspections, lake_root, "inspection", day=DAY)
    assert jobs(spark, lambda: transform(spark, lake_root, f"{tmp_path}/silver", versioned=True)) < 7


def test_figures_survive_a_task_that_ran_twice(spark, tmp_path, monkeypatch):
    """A repeated task of rejected rows only: nothing but the input shows it."""
    df = inspection(spark, {"id": 1}, {"id": None}, {"id": None, "t_av": 2.0})
    expected = build_silver(df, str(tmp_path / "one")).losses

    class Twice:
        def __init__(self):
            from pyspark.sql import Observation

            self.inner = Observation()

        @property
        def get(self):
            seen = self.inner.get
            return seen | {"missing_id": 2 * seen["missing_id"], "input": seen["input"] + seen["missing_id"]}

    real = type(df).observe
    monkeypatch.setattr("tamis.plans.silver.Observation", Twice)
    monkeypatch.setattr(type(df), "observe", lambda self, seen, *figures: real(self, seen.inner, *figures))
    assert build_silver(df, str(tmp_path / "two"), n_input=3).losses == expected
    assert build_silver(df, str(tmp_path / "three"), versioned=True).losses == expected


# --- plain tables ----------------------------------------------------------------


def test_the_root_reads_while_a_day_is_staged_or_moved_aside(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for day in (DAY, DAY.replace(day=1)):
        ingest(inspection(spark, {"id": 1}), root, "inspection", day=day)
    seen = []
    for step in ("write_parquet", "swap_in"):
        real = getattr(lake, step)

        def looks(*args, real=real, **kwargs):
            found = real(*args, **kwargs)
            seen.append(spark.read.parquet(f"{root}/inspection").count())
            return found

        with monkeypatch.context() as patch:
            patch.setattr(lake, step, looks)
            ingest(inspection(spark, {"id": 2}, {"id": 3}), root, "inspection", day=DAY)
    staged = lake.beside(f"{root}/inspection/ingest_date=2026-07-29")
    spark.range(1).write.parquet(staged)
    assert seen == [2, 3] and spark.read.parquet(f"{root}/inspection").count() == 3


@pytest.mark.parametrize("layout", ["ymd", "ingest_date"])
def test_a_table_left_aside_is_put_back(spark, tmp_path, layout):
    root = str(tmp_path)
    result = ingest(inspection(spark, {"id": 1}), root, "inspection", day=DAY, layout=layout)
    target = f"{root}/{result.path}"

    class Killed(BaseException):
        pass

    def crash():
        os.rename(target, lake.beside(target, lake._ASIDE))

    crash()
    assert ids(lake.read_bronze_parquet(spark, target)) == [1]
    crash()
    ingest(inspection(spark, {"id": 2}).limit(0), root, "inspection", day=DAY, layout=layout)
    assert ids(lake.read_bronze_parquet(spark, target)) == [1]
    crash()
    with lake.lease(spark, target):
        pass
    assert os.path.exists(target)
    crash()
    lake.write_silver_parquet(spark.range(5), target)
    assert ids(lake.read_bronze_parquet(spark, target)) == [0, 1, 2, 3, 4]
    assert [n for n in os.listdir(os.path.dirname(target)) if n.startswith(".")] == []


def test_one_writer_of_a_day_at_a_time(spark, tmp_path):
    target = f"{tmp_path}/inspection/ingest_date=2026-07-29"
    with lake.lease(spark, target), pytest.raises(DataLakeWriteError, match="another run"):
        ingest(inspection(spark, {"id": 1}), str(tmp_path), "inspection", day=DAY)
    assert ingest(inspection(spark, {"id": 1}), str(tmp_path), "inspection", day=DAY).written
    with lake.lease(spark, target, seconds=-1):
        assert ingest(inspection(spark, {"id": 2}), str(tmp_path), "inspection", day=DAY).written
    assert ids(lake.read_bronze_parquet(spark, target)) == [2]


def test_two_runs_of_a_day_at_once(spark, tmp_path):
    outcome, gate = [], threading.Barrier(2)

    def run(n):
        gate.wait()
        try:
            ingest(inspection(spark, {"id": n}, {"id": n}), str(tmp_path), "inspection", day=DAY)
            outcome.append(n)
        except DataLakeWriteError:
            pass

    threads = [threading.Thread(target=run, args=(n,)) for n in (1, 2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert outcome
    assert ids(lake.read_bronze_parquet(spark, f"{tmp_path}/inspection/ingest_date=2026-07-29")) == [outcome[-1]] * 2


# --- pruned lookup ------------------------------------------------------------------


def test_the_latest_day_is_found_without_listing_all(spark, tmp_path, monkeypatch):
    for year in range(2015, 2027):
        for month in range(1, 13):
            (tmp_path / f"t/{year}/{month:02}/01").mkdir(parents=True)
    spark.range(1).write.mode("overwrite").parquet(str(tmp_path / "t/2026/11/01"))
    listed, real = [], lake.children
    monkeypatch.setattr(lake, "children", lambda session, path: listed.append(path) or real(session, path))
    assert lake.latest_snapshot(spark, str(tmp_path), "t", "ymd").path == "t/2026/11/01"
    below = [p.removeprefix(f"{tmp_path}/") for p in listed if "/t" in p.removeprefix(str(tmp_path))]
    assert [p for p in below if p.startswith("t/") and p[2:6].isdigit() and len(p) <= 9] == ["t/2026", "t/2026/12", "t/2026/11"]
    assert len(lake.snapshot_days(spark, str(tmp_path), "t", "ymd")) == 144
