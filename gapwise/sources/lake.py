"""Day-partitioned Parquet output: write, verify, publish, compact.

A lake root is used in one of two ways.  *Versions*: every run writes
``_versions/version=<run>/dt=...`` and readers follow pointers (a catalog table, or ``current_rows`` through the ledger).  *In place*:
a run replaces ``dt=...`` folders directly under the root.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.operators.event_sessions import LAKE_SCHEMA, deal_days


@dataclass(frozen=True)
class OutputStats:
    row_count: int
    days: tuple[str, ...]


# Fixed value: the characters a run id does not keep in a folder name.
NOT_IN_FOLDERS = r"[^A-Za-z0-9._=-]"


def folder_name(run_id: str) -> str:
    return re.sub(NOT_IN_FOLDERS, "_", run_id)


def run_folder(root: str, kind: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/{kind}/{folder_name(run_id)}"


def versions_root(root: str) -> str:
    return f"{root.rstrip('/')}/_versions"


def version_path(root: str, run_id: str) -> str:
    return f"{versions_root(root)}/version={folder_name(run_id)}"


def write_days(rows: DataFrame, path: str, mode: str = "errorifexists", **options: object) -> None:
    """Write Parquet/Snappy with one folder per ``dt``; ``overwrite`` replaces only days in ``rows``.

    Each task writes a file for every day it has rows of; see ``gather_by_day`` for one file per
    day.
    """
    (
        rows.write.mode(mode)
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy("dt")
        .parquet(path)
    )


def read_days(spark: SparkSession, path: str, schema: T.StructType = LAKE_SCHEMA) -> DataFrame:
    """Read a folder of days.  The schema is given, so ``dt`` stays text and a folder without any
    day reads as no rows."""
    return spark.read.schema(schema).parquet(path)


def day_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("dt").agg(F.count("*").alias("row_count"))


def output_stats(rows: DataFrame) -> OutputStats:
    """Row count and sorted days of written output: one small row per day comes to the driver."""
    counted = sorted((r["dt"], r["row_count"]) for r in day_counts(rows).collect())
    return OutputStats(sum(n for _, n in counted), tuple(day for day, _ in counted))


def stage_version(rows: DataFrame, root: str, run_id: str) -> OutputStats:
    """Write a run's version and verify it from the files.

    Nothing points at the version yet, so a failed run changes nothing for readers.  A run id that
    already has a version is refused by the write itself.
    """
    write_days(rows, version_path(root, run_id))
    return verify_version(rows.sparkSession, root, run_id, rows.schema)


def verify_version(
    spark: SparkSession, root: str, run_id: str, schema: T.StructType = LAKE_SCHEMA
) -> OutputStats:
    """Row count and days as the files have them; a version without any day is an error."""
    return _not_empty(output_stats(read_days(spark, version_path(root, run_id), schema)))


def stage_days(rows: DataFrame, root: str, run_id: str) -> OutputStats:
    """Write a run's days beside the live ones and verify them from the files."""
    staged = run_folder(root, "_staging", run_id)
    write_days(rows, staged)
    return _not_empty(output_stats(read_days(rows.sparkSession, staged, rows.schema)))


def replace_days(
    spark: SparkSession, root: str, run_id: str, days: Sequence[str], asked_days: Sequence[str] = ()
) -> None:
    """Put the staged ``days`` of a run in the place of the live ones.

    A day of ``asked_days`` that has no rows any more is removed; all other days stay untouched.
    What is to be moved is written to a journal first, live days are set aside before staged ones
    take their place, and nothing is deleted before all days have moved.  After a loss at any point
    ``recover_days`` finishes the move: without a journal nothing had moved, with one all is there.
    """
    journal = {"run_id": run_id, "days": sorted(days), "gone": sorted(set(asked_days) - set(days))}
    _Files(spark, root).write_journal(run_id, journal)
    recover_days(spark, root)


def recover_days(spark: SparkSession, root: str) -> list[str]:
    """Finish all replacements of days that were begun below ``root``; the run ids that had one.

    Safe to repeat: every step looks at what is there.  A run whose job is still moving days must not
    be helped by another one at the same time.
    """
    files, finished = _Files(spark, root), []
    for name in files.names("_journal"):
        journal = json.loads(files.read(f"_journal/{name}"))
        run = folder_name(journal["run_id"])
        for day in journal["days"]:
            staged, aside, live = f"_staging/{run}/dt={day}", f"_replaced/{run}/dt={day}", f"dt={day}"
            if files.exists(staged):
                if files.exists(live) and not files.exists(aside):
                    files.move(live, aside)
                files.move(staged, live)
        for day in journal["gone"]:
            aside, live = f"_replaced/{run}/dt={day}", f"dt={day}"
            if files.exists(live) and not files.exists(aside):
                files.move(live, aside)
        # The journal goes last: until then a repeat only has to remove what is left.
        files.remove(f"_replaced/{run}")
        files.remove(f"_staging/{run}")
        files.remove(f"_journal/{name}")
        finished.append(journal["run_id"])
    return finished


class _Files:
    """Moves of single folders below a lake root, on whatever file system it is."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")
        self._files = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._root}/{name}" if name else self._root)

    def exists(self, name: str) -> bool:
        return self._files.exists(self._path(name))

    def names(self, folder: str) -> list[str]:
        """Finished files of a folder; those still being written have a leading dot."""
        found = self._files.listStatus(self._path(folder)) if self.exists(folder) else []
        return sorted(n for n in (f.getPath().getName() for f in found) if not n.startswith("."))

    def move(self, source: str, target: str) -> None:
        self._files.mkdirs(self._path(target).getParent())
        if self.exists(target) or not self._files.rename(self._path(source), self._path(target)):
            raise OSError(f"{self._root}/{source} could not be moved to {target}")

    def remove(self, name: str) -> None:
        self._files.delete(self._path(name), True)

    def read(self, name: str) -> str:
        text = self._spark.read.option("wholetext", True).text(self._path(name).toString())
        return text.first()["value"]

    def write_journal(self, run_id: str, journal: dict) -> None:
        """All of the journal appears at once, by a rename."""
        name = f"{folder_name(run_id)}.json"
        if self.exists(f"_journal/{name}"):
            raise OSError(f"run {run_id!r} has a journal already; recover it first")
        out = self._files.create(self._path(f"_journal/.{name}"), True)
        try:
            out.write(bytearray(json.dumps(journal).encode()))
        finally:
            out.close()
        self.move(f"_journal/.{name}", f"_journal/{name}")


def _not_empty(stats: OutputStats) -> OutputStats:
    if not stats.days:
        raise ValueError("no day was written")
    return stats


def ensure_table(
    spark: SparkSession, table: str, root: str, schema: T.StructType = LAKE_SCHEMA
) -> None:
    """External table over the lake root, one partition per day; does nothing when it exists."""
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) "
        f"USING PARQUET PARTITIONED BY (dt) LOCATION {_sql_text(root)}"
    )


def listed_days(spark: SparkSession, table: str) -> list[str]:
    """Days the table has a partition for."""
    return [r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def point_days(
    spark: SparkSession,
    table: str,
    version: str,
    days: Sequence[str],
    asked_days: Sequence[str] = (),
) -> None:
    """Let the table's partitions of ``days`` read from ``version``; repeating it is harmless.

    Days new to the table are added in one statement.  ``asked_days`` that the version does not
    have lose their partition (the files of an external table stay).
    """
    known = set(listed_days(spark, table))

    def spec(day: str) -> str:
        return f"PARTITION (dt={_sql_text(day)})"

    def location(day: str) -> str:
        return f"LOCATION {_sql_text(f'{version}/dt={day}')}"

    fresh = [d for d in days if d not in known]
    if fresh:
        parts = " ".join(f"{spec(d)} {location(d)}" for d in fresh)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    for day in days:
        if day in known:
            spark.sql(f"ALTER TABLE {table} {spec(day)} SET {location(day)}")
    gone = [d for d in asked_days if d in known and d not in set(days)]
    if gone:
        parts = ", ".join(spec(d) for d in gone)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
    spark.sql(f"REFRESH TABLE {table}")


def _sql_text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _current_folders(root: str, pointer: DataFrame) -> list[str]:
    """Day folders that ``pointer`` (dt, run_id) names: one row per calendar day, so few."""
    rows = pointer.select("dt", "run_id").collect()
    return sorted(f"{version_path(root, r['run_id'])}/dt={r['dt']}" for r in rows)


def current_rows(
    spark: SparkSession,
    root: str,
    pointer: DataFrame,
    schema: T.StructType = LAKE_SCHEMA,
    *more: Column,
) -> DataFrame:
    """Rows of a versions lake as of ``pointer``: every day from one run, in a single scan.

    Only the pointed-at day folders are listed and read, so replaced versions cost nothing.
    ``more`` columns may use the files' ``_metadata``.
    """
    folders = _current_folders(root, pointer)
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", versions_root(root))
    return reader.parquet(*folders).select(*schema.fieldNames(), *more)


def day_files(spark: SparkSession, base: str, folders: Sequence[str] = ()) -> DataFrame:
    """Files and bytes per day below ``base``, from the listing alone (no file is opened)."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("basePath", base)
        .load(list(folders) or base)
        .select(F.col("dt").cast("string").alias("dt"), "length")
    )
    return listing.groupBy("dt").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")
    )


def current_day_files(spark: SparkSession, root: str, pointer: DataFrame) -> DataFrame:
    """Files and bytes of each day as of ``pointer``."""
    folders = _current_folders(root, pointer)
    if not folders:
        return spark.createDataFrame([], "dt string, files long, bytes long")
    return day_files(spark, versions_root(root), folders)


def stored_folders(spark: SparkSession, root: str) -> DataFrame:
    """Folders of versions and states below ``root`` (relative) with files, bytes and the time of
    their newest file, from the listing alone."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load([p for p in (versions_root(root), f"{root.rstrip('/')}/_state") if _Files(spark, p).exists("")])
    )
    kept = F.regexp_extract("path", r"/(_versions/version=[^/]+/dt=[^/]+|_state/[^/]+)/[^/]+$", 1)
    return (
        listing.select(kept.alias("folder"), "length", "modificationTime")
        .groupBy("folder")
        .agg(
            F.count("*").alias("files"),
            F.sum("length").alias("bytes"),
            F.max("modificationTime").alias("newest"),
        )
    )


def unreferenced_versions(
    folders: DataFrame, pointer: DataFrame, states: DataFrame, grace_before: Column
) -> DataFrame:
    """Folders that no reader and no later run needs: (``folder``, files, bytes).

    ``pointer`` (dt, run_id) names the day folders that are read, ``states`` (run_id) the runs whose
    state may still be continued.  Folders with a file newer than ``grace_before`` stay whatever they
    are: a run may be about to point at them, and readers may still hold the pointer of before.
    """
    kept = pointer.select(_folder_of("_versions/version=", F.concat(F.lit("/dt="), F.col("dt"))).alias("folder"))
    kept = kept.union(states.select(_folder_of("_state/").alias("folder"))).distinct()
    old = folders.filter((F.col("newest") < grace_before) & (F.col("folder") != ""))
    return old.join(kept, "folder", "left_anti").select("folder", "files", "bytes")


def _folder_of(prefix: str, *suffix: Column) -> Column:
    return F.concat(F.lit(prefix), F.regexp_replace("run_id", NOT_IN_FOLDERS, "_"), *suffix)


def remove_folders(spark: SparkSession, root: str, folders: DataFrame) -> int:
    """Delete the folders that ``unreferenced_versions`` named; how many there were.

    One row per day of a replaced version reaches the driver.
    """
    files, removed = _Files(spark, root), 0
    for row in folders.select("folder").toLocalIterator():
        files.remove(row["folder"])
        removed += 1
    return removed


# Bytes that one task writes as many small files; files above that size have a task each.
TASK_BYTES = 4 << 20
# Files that a range is cut into at the least: the last one is shorter than the others.
SHARED_FILES = 16


def compact_days(
    spark: SparkSession,
    root: str,
    pointer: DataFrame,
    run_id: str,
    file_bytes: int,
    schema: T.StructType = LAKE_SCHEMA,
) -> dict[str, int]:
    """Write the days of ``pointer`` as a new version with files of about ``file_bytes``.

    A day gets ceil(bytes / file_bytes) files.  Rows are dealt to a day's files by their place in
    the source files, so the files come out even whatever the keys are.  Small files of several days
    are written by one task.  Returns the planned
    number of files per day.  See ``cluster_days`` for files that hold neighbouring users and times.
    """
    # One row per calendar day.
    sizes = {r["dt"]: r["bytes"] for r in current_day_files(spark, root, pointer).collect()}
    files = {day: max(1, ceil(size / file_bytes)) for day, size in sorted(sizes.items())}
    dealt_days, tasks = deal_days(files, max(1, TASK_BYTES // file_bytes))
    plan = spark.createDataFrame(dealt_days, "dt string, _first int, _files int")
    # In turn from a source file's rows on, each file beginning somewhere else.
    begin = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(1 << 40))
    place = (begin + F.col("_metadata.row_index")).alias("_place")
    dealt = current_rows(spark, root, pointer, schema, place).join(F.broadcast(plan), "dt")
    slot = (F.col("_first") + F.pmod("_place", "_files")).cast("int")
    columns = [f.name for f in schema]
    gathered = dealt.repartitionById(max(tasks, 1), slot).select(*columns)
    write_days(gathered, version_path(root, run_id))
    return files


# Bits of each of two numbers whose bits are interleaved.
CLUSTER_BITS = 31


def _scaled(number: Column, low: Column, high: Column) -> Column:
    """``number`` between ``low`` and ``high`` as an integer of CLUSTER_BITS bits."""
    share = (number - low) / F.greatest(high - low, F.lit(1))
    return F.floor(share * F.lit(2**CLUSTER_BITS - 1)).cast("long")


def interleaved(first: Column, second: Column) -> Column:
    """The bits of two integers of CLUSTER_BITS bits in turn: a place on a curve on which what is
    near in both is near."""

    def apart(bits: Column) -> Column:
        # Masks that keep ever smaller runs of bits, so that each gets a gap of its size.
        for shift, mask in (
            (16, 0x0000FFFF0000FFFF),
            (8, 0x00FF00FF00FF00FF),
            (4, 0x0F0F0F0F0F0F0F0F),
            (2, 0x3333333333333333),
            (1, 0x5555555555555555),
        ):
            bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask))
        return bits

    return F.shiftleft(apart(first), 1).bitwiseOR(apart(second))


def cluster_days(
    spark: SparkSession,
    root: str,
    pointer: DataFrame,
    run_id: str,
    file_bytes: int,
    schema: T.StructType = LAKE_SCHEMA,
    row_group_bytes: int | None = None,
) -> int:
    """Like ``compact_days``, but the rows of a day lie along a curve over user and time.

    Every file, and every row group in it, then holds a narrow span of users and times, so a filter
    on a user or on an hour skips nearly all of them by their bounds.  The curve goes over the user
    numbers themselves, for bounds say nothing about hashes.  Ranges of the curve are cut by a sample
    into about equal files, so a user with more rows than a file takes several, by time; a file at
    the edge of two days is one of each.  Small files are cut by their number of rows out of ranges
    that hold several, one for each task.  Returns the number of files asked for; only edges of days
    may add to it.

    Rows without a user come first.  The rows are read twice, the first time only users and times.
    """
    # One row per calendar day.
    sizes = [r["bytes"] for r in current_day_files(spark, root, pointer).collect()]
    files = max(1, sum(ceil(size / file_bytes) for size in sizes))
    share = TASK_BYTES // file_bytes
    tasks = ceil(files / share) if share >= SHARED_FILES else files
    rows = current_rows(spark, root, pointer, schema)
    user, micros = F.col("user_id"), F.unix_micros("event_time_utc")
    bounds = rows.groupBy(F.col("dt").alias("_day")).agg(
        F.min(user).alias("_low"),
        F.max(user).alias("_high"),
        F.min(micros).alias("_first"),
        F.max(micros).alias("_last"),
    )
    placed = rows.join(F.broadcast(bounds), F.col("dt") == F.col("_day")).withColumn(
        "_place",
        interleaved(_scaled(user, F.col("_low"), F.col("_high")), _scaled(micros, F.col("_first"), F.col("_last"))),
    )
    order = ["dt", "_place"]
    along = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    options = {} if row_group_bytes is None else {"parquet.block.size": row_group_bytes}
    if tasks < files:
        # A task's last file may be short: the others are larger by as much as that takes.
        options["maxRecordsPerFile"] = max(1, ceil(rows.count() / (files - tasks + 1)))
    write_days(along.select(*schema.fieldNames()), version_path(root, run_id), **options)
    return files
