"""Dated Parquet snapshots of a layer, and the tables written from them.

A snapshot of `table` for one day lies under the layer's root in one of two
layouts: `table/ingest_date=YYYY-MM-DD` (the default) or `table/YYYY/MM/DD`.

A plain table is a folder of Parquet files that any reader understands; it is replaced
by two renames, between which it is away for an instant, and a writer that dies there
leaves it aside, from where the next reader or writer of this module puts it back. A
versioned table (`versions`) has no such instant.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import DataLakeBucketNotFoundError, DataLakeReadError, DataLakeWriteError, NoPartitionFoundError
from . import versions
from .versions import children, file_system, put_if_absent, read_text

DATE_COLUMN = "ingest_date"

LAYOUTS = ("ingest_date", "ymd")
_ASIDE, _LEASE = ".aside", ".lease"

WRITE_MODES = ("append", "error", "ignore", "overwrite")


@dataclass(frozen=True)
class Snapshot:
    date: date
    path: str
    """Relative to the layer's root, so it names the same snapshot in every layer."""
    n_files: int
    n_bytes: int

    def under(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.path}"


def _check_layout(layout: str) -> None:
    if layout not in LAYOUTS:
        raise ValueError(f"Unknown layout '{layout}'; one of {sorted(LAYOUTS)}.")


def snapshot_path(table: str, day: date | None = None, layout: str = "ingest_date") -> str:
    """Path of the snapshot of `day` (today in UTC by default), relative to the root."""
    _check_layout(layout)
    day = day or datetime.now(UTC).date()
    return f"{table}/{day:%Y/%m/%d}" if layout == "ymd" else f"{table}/{DATE_COLUMN}={day:%Y-%m-%d}"


def _date(*parts: str) -> date | None:
    try:
        return date(*map(int, parts))
    except ValueError:
        return None


def _walk(spark: SparkSession, root: str, table: str, layout: str) -> Iterator[tuple[date, str]]:
    """`(date, path)` of the dated directories, latest first, listing no more folders than are asked for."""
    top = f"{root.rstrip('/')}/{table}"
    if layout == "ingest_date":
        named = ((re.fullmatch(rf"{DATE_COLUMN}=(\d+)-(\d+)-(\d+)", name, re.ASCII), name) for name, folder in children(spark, top) if folder)
        days = [(_date(*match.groups()), f"{table}/{name}") for match, name in named if match]
        yield from sorted(((day, path) for day, path in days if day), reverse=True)
        return

    def numbered(path: str, most: int) -> list[str]:
        names = [name for name, folder in children(spark, path) if folder and re.fullmatch(r"\d+", name, re.ASCII) and 1 <= int(name) <= most]
        return sorted(names, key=lambda n: (int(n), n), reverse=True)

    # months and days of one number may be written in two ways, so they are merged per year and month
    for year in numbered(top, 9999):
        months = numbered(f"{top}/{year}", 12)
        for month in sorted({int(m) for m in months}, reverse=True):
            ways = [m for m in months if int(m) == month]
            days = [(_date(year, m, d), f"{table}/{year}/{m}/{d}") for m in ways for d in numbered(f"{top}/{year}/{m}", 31)]
            yield from sorted(((day, path) for day, path in days if day), reverse=True)


def snapshot_days(spark: SparkSession, root: str, table: str, layout: str = "ingest_date") -> list[tuple[date, str]]:
    """`(date, path)` of the dated directories, latest first.

    Directories whose name holds no valid calendar date are ignored. Only
    directories are listed, never the files of every snapshot.
    """
    _check_layout(layout)
    return [] if "/" in table else list(_walk(spark, root, table, layout))


def snapshot_size(spark: SparkSession, root: str, path: str) -> tuple[int, int]:
    """Files and bytes of one snapshot, from names and lengths only; no file is opened."""
    place = f"{root.rstrip('/')}/{path}"
    recover(spark, place)
    places = versions.folders(spark, place) if versions.is_versioned(spark, place) else [place]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(places)
    # one task, as nothing but the listing is read
    return tuple(files.coalesce(1).agg(F.count("path"), F.coalesce(F.sum("length"), F.lit(0))).first())


def latest_snapshot(spark: SparkSession, root: str, table: str, layout: str = "ingest_date") -> Snapshot:
    """The latest snapshot that holds a file; `NoPartitionFoundError` if there is none.

    In the `ymd` layout folders are listed newest first and only until one is found.
    """
    _check_layout(layout)
    top, files = file_system(spark, root)
    if not files.exists(top):
        raise DataLakeBucketNotFoundError({root: None})
    for day, path in () if "/" in table else _walk(spark, root, table, layout):
        n_files, n_bytes = snapshot_size(spark, root, path)
        if n_files:
            return Snapshot(day, path, n_files, n_bytes)
    raise NoPartitionFoundError({table: f"none under '{root}'"})


def write_bronze(
    df: DataFrame, root: str, table: str, day: date | None = None, layout: str = "ingest_date", *, versioned: bool = False
) -> int:
    """Write one day's snapshot, replacing that day only; return the rows written.

    The rows are written beside the day and swapped in once they are complete: a
    write that fails, or has no rows, leaves an earlier snapshot in place. The
    source is read once; the rows are counted from the files' footers. Of two runs that
    write the same day at once, the second is refused. With `versioned` the day becomes a
    versioned table, or the next version of one.
    """
    target = f"{root.rstrip('/')}/{snapshot_path(table, day, layout)}"
    spark = df.sparkSession
    if versioned or versions.is_versioned(spark, target):
        staged = versions.stage(df, target)
        try:
            n_rows = versions.read_staged(spark, target, staged).count()
            if n_rows:
                versions.commit(spark, target, staged)
            else:
                versions.discard(spark, target, staged)
        except Exception:
            versions.discard(spark, target, staged)
            raise
        return n_rows
    with lease(spark, target):
        staged = beside(target)
        try:
            write_parquet(df, staged)
            n_rows = spark.read.schema(df.schema).parquet(staged).count()
            if n_rows:
                swap_in(spark, staged, target)
        finally:
            delete_path(spark, staged)
    return n_rows


def read_bronze_parquet(spark: SparkSession, bronze_path: str) -> DataFrame:
    """A snapshot or table, plain or versioned."""
    if not bronze_path or not bronze_path.strip():
        raise ValueError("The Bronze path is empty.")
    if versions.is_versioned(spark, bronze_path):
        return versions.read_version(spark, bronze_path)
    recover(spark, bronze_path)
    try:
        return spark.read.parquet(bronze_path)
    except AnalysisException as e:
        raise DataLakeReadError({bronze_path: e}) from e


def check_target(path: str, mode: str) -> str:
    """The write mode in lower case, once path and mode are acceptable."""
    if not path or not path.strip():
        raise ValueError("The Silver path is empty.")
    if mode.lower() not in WRITE_MODES:
        raise ValueError(f"Invalid write mode '{mode}'; one of {list(WRITE_MODES)}.")
    return mode.lower()


def may_write(spark: SparkSession, path: str, mode: str) -> bool:
    """Whether a target is to be written: not if it exists and the mode is `ignore`; `error` then raises."""
    recover(spark, path)
    if mode not in ("error", "ignore"):
        return True
    # the folder of a versioned table may hold what a failed first run has staged
    if not path_exists(spark, path) or {n for n, _ in children(spark, path)} == {versions.DATA}:
        return True
    if mode == "error":
        raise DataLakeWriteError({path: "it exists"})
    return False


def write_silver_parquet(
    df: DataFrame,
    silver_path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    *,
    replace_partitions: bool = False,
) -> bool:
    """Write a Parquet table; say whether anything was written.

    `overwrite` replaces the whole table: rows are written beside it and swapped
    in once complete, so a failure leaves the old table. With
    `replace_partitions` it replaces only the partitions present in `df`, which
    are swapped when the job commits.

    Partitioned rows are first rebalanced on the partition columns: AQE merges
    small partitions into few files and splits one that holds most of the rows
    over many tasks. A versioned table gets a version in any mode.
    """
    mode = check_target(silver_path, mode)
    spark = df.sparkSession
    if not may_write(spark, silver_path, mode):
        return False
    if versions.is_versioned(spark, silver_path):
        versions.write_version(df, silver_path, mode, partition_by, replace_partitions=replace_partitions)
        return True
    with lease(spark, silver_path):
        if mode == "append" or replace_partitions:
            write_parquet(balanced(df, partition_by), silver_path, mode, partition_by)
            return True
        staged = beside(silver_path)
        try:
            write_parquet(balanced(df, partition_by), staged, "error", partition_by)
            swap_in(spark, staged, silver_path)
        finally:
            delete_path(spark, staged)
    return True


def stage_silver(df: DataFrame, silver_path: str, partition_by: Sequence[str] = ()) -> str:
    """Write the rows of a table to come beside its place; `publish_staged` puts them there."""
    staged = beside(silver_path)
    try:
        write_parquet(balanced(df, partition_by), staged, "error", partition_by)
    except DataLakeWriteError:
        delete_path(df.sparkSession, staged)
        raise
    return staged


def publish_staged(
    spark: SparkSession, staged: str, silver_path: str, mode: str, partition_by: Sequence[str] = (), replace_partitions: bool = False
) -> None:
    """Swap staged rows in; where they join a table that exists, copy them into it."""
    if (mode == "append" or replace_partitions) and path_exists(spark, silver_path):
        rows = spark.read.parquet(staged)
        write_parquet(balanced(rows, partition_by), silver_path, mode, partition_by)
    else:
        swap_in(spark, staged, silver_path)


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    try:
        writer = df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
        writer.parquet(path)
    except (PySparkException, Py4JJavaError) as e:
        raise DataLakeWriteError({path: e}) from e


def path_exists(spark: SparkSession, path: str) -> bool:
    target, files = file_system(spark, path)
    return files.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove what this run has staged, if it is still there."""
    target, files = file_system(spark, path)
    files.delete(target, True)


def beside(path: str, mark: str = "") -> str:
    """A new path in the same folder, which readers of that folder pass over: Spark lists no name that starts with a dot."""
    folder, _, name = path.rstrip("/").rpartition("/")
    name = f"{mark}.{uuid.uuid4().hex}.{name.replace('=', '.')}"
    return f"{folder}/{name}" if folder else name


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Move a staged folder to its place. What was there is moved aside first, and back if that fails.

    Renames are atomic on HDFS-like file systems, and for an instant nothing is
    there; object stores copy instead. `recover` mends what a crash in that instant leaves.
    """
    new, files = file_system(spark, staged)
    target, _ = file_system(spark, path)
    aside, _ = file_system(spark, beside(path, _ASIDE))
    files.mkdirs(target.getParent())
    had = files.exists(target)
    if had and not files.rename(target, aside):
        raise DataLakeWriteError({path: "the table there can't be moved"})
    try:
        moved = files.rename(new, target)
    except Py4JJavaError as e:
        moved, cause = False, e
    else:
        cause = None
    if not moved:
        if had:
            files.rename(aside, target)
        raise DataLakeWriteError({path: "the new table can't be moved there"}) from cause
    files.delete(aside, True)


def _asides(spark: SparkSession, path: str) -> tuple[str, list[str]]:
    folder, _, name = path.rstrip("/").rpartition("/")
    ending = f".{name.replace('=', '.')}"
    return folder, [n for n, inner in children(spark, folder or ".") if inner and n.startswith(f"{_ASIDE}.") and n[len(_ASIDE) + 33 :] == ending]


def recover(spark: SparkSession, path: str) -> bool:
    """Put back a table that a writer moved aside and died; say whether there was one.

    Only where nothing is at the path and no writer holds its lease. A table aside beside one
    that is in place is what a swap had not deleted yet; it goes with the next swap.
    """
    target, files = file_system(spark, path)
    if files.exists(target):
        return False
    folder, found = _asides(spark, path)
    if not found or _held(spark, path):
        return False
    aside, _ = file_system(spark, f"{folder}/{found[0]}" if folder else found[0])
    return bool(files.rename(aside, target))


# --- one writer at a time ------------------------------------------------------------


def _lease_path(path: str) -> str:
    folder, _, name = path.rstrip("/").rpartition("/")
    name = f"{_LEASE}.{name.replace('=', '.')}"
    return f"{folder}/{name}" if folder else name


def _held(spark: SparkSession, path: str) -> dict | None:
    """The lease on a table that has not run out, if there is one."""
    place = _lease_path(path)
    if not path_exists(spark, place):
        return None
    try:
        found = json.loads(read_text(spark, place))
    except Py4JJavaError:  # released meanwhile
        return None
    return found if found["until"] > time.time() else None


@contextmanager
def lease(spark: SparkSession, path: str, seconds: float = 24 * 3600) -> Iterator[None]:
    """Hold a table alone, by a file that only one writer can create; `DataLakeWriteError` while another holds it.

    A lease runs out, so that a writer that died doesn't keep the table. The next one
    takes it over by renaming it away, which succeeds once; then it mends the table.
    """
    place, own = _lease_path(path), {"owner": uuid.uuid4().hex, "until": time.time() + seconds}
    target, files = file_system(spark, place)
    if not put_if_absent(spark, place, json.dumps(own)):
        spent, _ = file_system(spark, beside(place))
        if _held(spark, path) or not files.rename(target, spent):
            raise DataLakeWriteError({path: "another run is writing it"})
        files.delete(spent, False)
        if not put_if_absent(spark, place, json.dumps(own)):
            raise DataLakeWriteError({path: "another run is writing it"})
    try:
        folder, left = _asides(spark, path)
        if left and not path_exists(spark, path):
            aside, _ = file_system(spark, f"{folder}/{left[0]}" if folder else left[0])
            files.rename(aside, file_system(spark, path)[0])
            left = left[1:]
        for name in left:
            delete_path(spark, f"{folder}/{name}" if folder else name)
        yield
    finally:
        if path_exists(spark, place) and json.loads(read_text(spark, place))["owner"] == own["owner"]:
            files.delete(target, False)
