"""The batch job: raw files to a published, recorded range of local days."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.functions.timeops import day_start
from gapwise.operators import hot
from gapwise.operators.event_sessions import (
    DEFAULT_GAP_MINUTES,
    DEFAULT_ZONE,
    event_rule,
    gather_by_day,
    publishable,
    sessionize_events,
    sessions_at_edge,
    with_day,
)
from gapwise.operators.incremental import session_state, sessionize_incremental
from gapwise.operators.sessions import SESSION_COLUMNS, GapRule
from gapwise.scratch import materialize, scratch_folder
from gapwise.sources import events as source
from gapwise.sources import lake, ledger

VERSIONS, IN_PLACE = "versions", "in place"


@dataclass(frozen=True)
class JobSpec:
    """Parameters of one run.  Days are local days, ``start_date <= dt < end_date``."""

    input: str
    output: str
    start_date: str
    end_date: str
    run_id: str
    lookback_input: str | None = None
    database: str = "default"
    table: str = "sessionized_events"
    session_gap_minutes: int = DEFAULT_GAP_MINUTES
    timezone: str = DEFAULT_ZONE
    catalog_sync: bool = True
    repartition_by_dt: bool = True
    # Keep one row of each group of fully equal ones, for input and lookback files that overlap;
    # two real events that are equal in every column are then one as well.
    drop_copies: bool = False
    # Keep each distinct row as often as the files of input or those of lookback have it, whichever
    # is more: for files that overlap and have real repeats.
    reconcile: bool = False
    # What happens to rows with a field that does not parse: "keep" publishes them with NULL there
    # and keeps their lines below _unparsed, "reject" only keeps the lines, "ignore" loses the text.
    unparsed: str = "keep"
    # Publish rows without a user, as one timeline of their own, instead of rejecting them.
    publish_null_users: bool = False
    strict_time: bool = False
    # Columns after source session and product that order a user's events of one instant.
    ties: tuple[str, ...] = ()
    # Rows that a day's file has about; None leaves the size of files to the session's settings.
    file_rows: int | None = None
    # Write the open sessions after this run, for a run that continues them.
    keep_state: bool = False
    # Continue the sessions of this earlier run, whose days end where these begin.
    state_from: str | None = None
    hot_rows: int | None = hot.HOT_ROWS
    application: str = field(default="gapwise", repr=False)

    def __post_init__(self) -> None:
        for name in ("input", "output", "run_id"):
            if not getattr(self, name):
                raise ValueError(f"{name} is required")
        if not date.fromisoformat(self.start_date) < date.fromisoformat(self.end_date):
            raise ValueError("start_date must be before end_date")
        if self.session_gap_minutes < 1:
            raise ValueError("session_gap_minutes must be 1 or more")
        if self.unparsed not in ("keep", "reject", "ignore"):
            raise ValueError("unparsed must be keep, reject or ignore")
        if self.drop_copies and self.reconcile:
            raise ValueError("overlaps are either reconciled or cut to single rows")
        if self.state_from is not None and self.lookback_input is not None:
            raise ValueError("sessions are continued either from a state or by a lookback")
        if "://" not in self.output and not self.output.startswith(("/", "file:")):
            object.__setattr__(self, "output", os.path.abspath(self.output))

    @property
    def input_paths(self) -> list[str]:
        return source.split_paths(self.lookback_input, self.input)

    @property
    def days(self) -> list[str]:
        first, end = date.fromisoformat(self.start_date), date.fromisoformat(self.end_date)
        return [(first + timedelta(days=n)).isoformat() for n in range((end - first).days)]

    @property
    def full_table(self) -> str:
        return f"{self.database}.{self.table}"

    @property
    def rule(self) -> GapRule:
        return event_rule(self.session_gap_minutes * 60, *self.ties)

    @property
    def mode(self) -> str:
        return VERSIONS if self.catalog_sync else IN_PLACE

    def ledger_fields(self) -> dict:
        return {
            "application": self.application,
            "run_id": self.run_id,
            "input": self.input,
            "lookback_input": self.lookback_input,
            "input_paths": sorted(self.input_paths),
            "output": self.output,
            "database": self.database,
            "table": self.table,
            "start_date": self.start_date,
            "end_date": self.end_date,
            "timezone": self.timezone,
            "session_gap_minutes": self.session_gap_minutes,
            "repartition_by_dt": self.repartition_by_dt,
            "partitions": [],
            "state_from": self.state_from,
            "publish_mode": self.mode,
        }


def run_batch(spark: SparkSession, spec: JobSpec) -> lake.OutputStats:
    """Read, sessionize, publish and record one range of days.

    Everything is written and checked before a reader can see it: rows, rejects, late rows and
    state first, then the table's partitions or the live days, then the SUCCESS row. Every input
    row is accounted for in the ledger: published, outside the range, late, rejected or removed.
    """

    def publish() -> tuple[lake.OutputStats, dict]:
        with scratch_folder(spark, "batch"):
            events, found = _land(spark, spec)
            if spec.state_from is None:
                rows = _sessions_with_history(spec, events)
            else:
                rows = _sessions_with_state(spark, spec, events)
            stats = _stage(spec, rows)
            if spec.state_from is not None:
                found["late_rows"] = _keep_late_rows(spark, spec, events, found, stats.row_count)
        _account(found, stats.row_count)
        staged = lake.read_days(spark, _staged_path(spec))
        if spec.keep_state:
            _write_state(spark, spec, staged)
        read_from = found.pop("read_from")
        if spec.state_from is None:
            edge = sessions_at_edge(staged, F.timestamp_micros(F.lit(read_from)), spec.session_gap_minutes * 60)
            found["sessions_at_edge"] = edge.count()
        _publish(spark, spec, stats)
        return stats, found

    return _recorded(spark, spec, publish)


def compact_batch(spark: SparkSession, spec: JobSpec, file_bytes: int) -> lake.OutputStats:
    """Rewrite the current days of the range as a new version with files of ``file_bytes``.

    Rows keep the run id that made them; the version, the pointers and the ledger get the new one.
    The ledger names the run that each day was copied from, so a run that publishes a day again in
    the meantime stays current.
    """

    def publish() -> tuple[lake.OutputStats, dict]:
        pointer = materialize(_pointer(spark, spec), "pointer")
        lake.compact_days(spark, spec.output, pointer, spec.run_id, file_bytes)
        stats = lake.verify_version(spark, spec.output, spec.run_id)
        before = lake.day_counts(lake.current_rows(spark, spec.output, pointer))
        after = lake.day_counts(lake.read_days(spark, lake.version_path(spec.output, spec.run_id)))
        if not before.exceptAll(after).isEmpty() or not after.exceptAll(before).isEmpty():
            raise ValueError("the compacted days have other row counts than their source")
        origins = {r["dt"]: r["origin"] for r in pointer.collect()}  # one row per calendar day
        still = {r["dt"] for r in _pointer(spark, spec).collect() if origins.get(r["dt"]) == r["origin"]}
        current = lake.OutputStats(stats.row_count, tuple(d for d in stats.days if d in still))
        _point(spark, spec, current, ())
        return stats, {"origins": origins}

    if not spec.catalog_sync:
        raise ValueError("only a lake of versions can be compacted")
    return _recorded(spark, spec, publish)


def _pointer(spark: SparkSession, spec: JobSpec) -> DataFrame:
    in_range = (F.col("dt") >= spec.start_date) & (F.col("dt") < spec.end_date)
    return ledger.current_versions(ledger.read_ledger(spark, spec.output)).filter(in_range)


def _recorded(
    spark: SparkSession, spec: JobSpec, publish: Callable[[], tuple[lake.OutputStats, dict]]
) -> lake.OutputStats:
    """Run ``publish`` between a RUNNING and a SUCCESS row; on an error write FAILED and raise it,
    also when the ledger cannot be written either."""
    _refuse_conflicts(spark, spec)
    if spec.mode == IN_PLACE:
        lake.recover_days(spark, spec.output)
    fields = spec.ledger_fields() | {"started_at": _now()}
    ledger.append_state(spark, spec.output, fields | {"status": ledger.RUNNING})
    try:
        stats, found = publish()
        success = {
            "status": ledger.SUCCESS,
            "completed_at": _now(),
            "row_count": stats.row_count,
            "partitions": list(stats.days),
        }
        ledger.append_state(spark, spec.output, fields | success | found)
    except Exception as error:
        failure = {
            "status": ledger.FAILED,
            "completed_at": _now(),
            "error_class": type(error).__name__,
            "error_message": str(error),
        }
        try:
            ledger.append_state(spark, spec.output, fields | failure)
        except Exception as second:
            error.add_note(f"the ledger could not be written either: {second}")
        raise
    if spec.mode == VERSIONS:
        _settle(spark, spec, fields["started_at"])
    return stats


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _refuse_conflicts(spark: SparkSession, spec: JobSpec) -> None:
    """Before anything is recorded: a used run id, also one that only its folder's name repeats,
    or a root that is kept in the other mode."""
    folder = F.regexp_replace("run_id", lake.NOT_IN_FOLDERS, "_")
    seen = ledger.read_ledger(spark, spec.output).agg(
        F.max(folder == lake.folder_name(spec.run_id)).alias("used"),
        F.max(F.col("publish_mode") != spec.mode).alias("other_mode"),
    ).first()
    if seen["used"]:
        raise ValueError(f"run id {spec.run_id!r}, or its folder, was used before; take a new one")
    if seen["other_mode"]:
        raise ValueError(f"{spec.output} is not published {spec.mode!r}")
    if spec.state_from is not None:
        _check_state(spark, spec)


def _check_state(spark: SparkSession, spec: JobSpec) -> None:
    states = ledger.latest_states(ledger.read_ledger(spark, spec.output))
    before = states.filter(F.col("run_id") == spec.state_from).first()
    if before is None or before["status"] != ledger.SUCCESS:
        raise ValueError(f"run {spec.state_from!r} has not succeeded")
    if before["end_date"] != spec.start_date:
        raise ValueError(f"run {spec.state_from!r} does not end where this one starts")
    for name in ("session_gap_minutes", "timezone"):
        if before[name] != getattr(spec, name):
            raise ValueError(f"run {spec.state_from!r} has another {name}")
    last_day = date.fromisoformat(spec.start_date) - timedelta(days=1)
    covered = ledger.covered_days(ledger.read_ledger(spark, spec.output))
    current = covered.filter(F.col("dt") == last_day.isoformat()).first()
    if current["origin"] != spec.state_from:
        raise ValueError(f"run {spec.state_from!r} was replaced by {current['origin']!r}")


def _land(spark: SparkSession, spec: JobSpec) -> tuple[DataFrame, dict]:
    """Valid input rows as Parquet, and what was found: rows by fate, first instant read.

    Text is parsed once; later passes read only the columns they need.
    """
    rescue = spec.unparsed != "ignore"

    def landed_from(paths: Sequence[str]) -> DataFrame:
        raw = source.read_raw_events(spark, paths, rescue)
        return materialize(source.canonical_events(raw, spec.strict_time), "landed-events")

    read = None
    if spec.reconcile:
        target, history = (source.split_paths(p) for p in (spec.input, spec.lookback_input))
        landed = landed_from(target)
        read = landed.count()
        if history:
            before = landed_from(history)
            read += before.count()
            landed = materialize(source.reconcile_union(landed, before), "single-events")
    else:
        landed = landed_from(spec.input_paths)
    if spec.drop_copies:
        read = landed.count()
        landed = materialize(source.drop_copies(landed), "single-events")
    cut = F.col(source.UNPARSED).isNotNull() if rescue else F.lit(False)
    t = F.col("event_time_utc")
    reject = t.isNull() if spec.publish_null_users else source.is_reject()
    if spec.unparsed == "reject":
        reject = reject | cut
    before = ~reject & (t < day_start(spec.start_date, spec.timezone))
    found = landed.agg(
        F.count("*").alias("_rows"),
        F.count_if(reject).alias("rejected_rows"),
        F.count_if(before).alias("before_range_rows"),
        F.count_if(~reject & (t >= day_start(spec.end_date, spec.timezone))).alias("after_range_rows"),
        F.min(F.unix_micros(t)).alias("read_from"),
        *([F.count_if(cut).alias("unparsed_rows")] if rescue else []),
    ).first().asDict()
    rows = found.pop("_rows")
    found |= {"input_rows": rows if read is None else read, "removed_rows": 0 if read is None else read - rows}
    if found.get("unparsed_rows"):
        landed.filter(cut).write.parquet(lake.run_folder(spec.output, "_unparsed", spec.run_id))
    if found["rejected_rows"]:
        landed.filter(reject).write.parquet(lake.run_folder(spec.output, "_rejects", spec.run_id))
    return landed.filter(~reject).select(*source.CANONICAL_COLUMNS), found


def _account(found: dict, published: int) -> None:
    """Every input row has one fate."""
    fates = ("rejected_rows", "before_range_rows", "after_range_rows", "late_rows", "removed_rows")
    known = published + sum(found.get(name, 0) for name in fates)
    if known != found["input_rows"]:
        raise ValueError(f"{found['input_rows']} rows were read, {known} accounted for: {found}")


def _sessions_with_history(spec: JobSpec, events: DataFrame) -> DataFrame:
    return sessionize_events(
        events,
        spec.run_id,
        spec.rule,
        spec.timezone,
        spec.start_date,
        spec.end_date,
        spec.hot_rows,
        spec.repartition_by_dt,
        spec.file_rows,
    )


def _sessions_with_state(spark: SparkSession, spec: JobSpec, events: DataFrame) -> DataFrame:
    numbered = _continued(spark, spec, events).filter(~F.col("is_late"))
    if spec.repartition_by_dt:
        numbered = gather_by_day(numbered, spec.file_rows, with_day(events, spec.timezone))
    return publishable(numbered, spec.run_id, spec.timezone)


def _continued(spark: SparkSession, spec: JobSpec, events: DataFrame) -> DataFrame:
    t = F.col("event_time_utc")
    first, end = (day_start(day, spec.timezone) for day in (spec.start_date, spec.end_date))
    new = with_day(events.filter((t >= first) & (t < end)), spec.timezone)
    return sessionize_incremental(new, _read_state(spark, spec), spec.rule, spec.hot_rows)


def _keep_late_rows(
    spark: SparkSession, spec: JobSpec, events: DataFrame, found: dict, published: int
) -> int:
    """Write the rows that call for a redo of earlier days: those before the range, where the state
    ends, and any in the range that are older than their user's state all the same."""
    early = events.filter(F.col("event_time_utc") < day_start(spec.start_date, spec.timezone))
    outside = ("rejected_rows", "before_range_rows", "after_range_rows", "removed_rows")
    asked = found["input_rows"] - sum(found[name] for name in outside)
    if asked > published:
        older = _continued(spark, spec, events).filter("is_late")
        early = early.unionByName(older.select(*early.columns))
    late = found["before_range_rows"] + asked - published
    if late:
        early.write.parquet(lake.run_folder(spec.output, "_late", spec.run_id))
    found["before_range_rows"] = 0
    return late


def _read_state(spark: SparkSession, spec: JobSpec) -> DataFrame:
    return spark.read.parquet(lake.run_folder(spec.output, "_state", spec.state_from))


def _write_state(spark: SparkSession, spec: JobSpec, written: DataFrame) -> None:
    """Open sessions after the run, next to its version, so that a redo can start from them."""
    numbered = written.withColumnRenamed("session_start_at_utc", "session_start")
    previous = None if spec.state_from is None else _read_state(spark, spec)
    state = session_state(numbered, spec.rule, previous)
    state.write.parquet(lake.run_folder(spec.output, "_state", spec.run_id))


def _staged_path(spec: JobSpec) -> str:
    if spec.catalog_sync:
        return lake.version_path(spec.output, spec.run_id)
    return lake.run_folder(spec.output, "_staging", spec.run_id)


def _stage(spec: JobSpec, rows: DataFrame) -> lake.OutputStats:
    stage = lake.stage_version if spec.catalog_sync else lake.stage_days
    return stage(rows, spec.output, spec.run_id)


def _publish(spark: SparkSession, spec: JobSpec, stats: lake.OutputStats) -> None:
    if spec.catalog_sync:
        _point(spark, spec, stats, spec.days)
    else:
        lake.replace_days(spark, spec.output, spec.run_id, stats.days, spec.days)


def _settle(spark: SparkSession, spec: JobSpec, since: datetime) -> None:
    """Point the days of the range at what the ledger calls current, if another run over some of them
    ended since this one began.

    Of two runs that end at once, the one whose SUCCESS row is older may have pointed the table last.
    Whichever looks here last sees both rows, so that table and ledger agree.
    """
    at_once = ledger.read_ledger(spark, spec.output).filter(
        (F.col("status") == ledger.SUCCESS)
        & (F.col("run_id") != spec.run_id)
        & (F.col("completed_at") >= F.lit(since))
        & (F.col("start_date") < spec.end_date)
        & (F.col("end_date") > spec.start_date)
    )
    if at_once.isEmpty():
        return
    versions: dict[str, list[str]] = {}
    for row in _pointer(spark, spec).collect():  # one row per calendar day
        versions.setdefault(row["run_id"], []).append(row["dt"])
    current = {day for days in versions.values() for day in days}
    lake.point_days(spark, spec.full_table, spec.output, (), [day for day in spec.days if day not in current])
    for run_id, days in sorted(versions.items()):
        lake.point_days(spark, spec.full_table, lake.version_path(spec.output, run_id), sorted(days))


def _point(
    spark: SparkSession, spec: JobSpec, stats: lake.OutputStats, asked_days: Sequence[str]
) -> None:
    lake.ensure_table(spark, spec.full_table, spec.output)
    version = lake.version_path(spec.output, spec.run_id)
    lake.point_days(spark, spec.full_table, version, stats.days, asked_days)


def current_events(spark: SparkSession, root: str) -> DataFrame:
    """Published rows of a versions lake, each day from its last finished run."""
    pointer = ledger.current_versions(ledger.read_ledger(spark, root))
    return lake.current_rows(spark, root, pointer)


def redo_plan(spark: SparkSession, root: str, days: Sequence[str]) -> DataFrame:
    """All days below ``root`` that are outdated when ``days`` are redone, see ``redo_closure``."""
    asked = spark.createDataFrame([(day,) for day in days], "dt string")
    return ledger.redo_closure(asked, ledger.read_ledger(spark, root))


def reclaimable(spark: SparkSession, root: str, grace_hours: float = 72) -> DataFrame:
    """Folders of replaced or failed versions and of states that no run can continue any more:
    (folder, files, bytes).

    A state is needed while its run answers for its last day, for that is the state a run of the
    days after it asks for, also when that one is redone.
    """
    book = ledger.read_ledger(spark, root)
    covered = ledger.covered_days(book)
    done = ledger.latest_states(book).filter(F.col("status") == ledger.SUCCESS)
    last_day = F.date_sub(F.to_date("end_date"), 1).cast("string")
    ends = done.select(F.col("run_id").alias("origin"), last_day.alias("dt"))
    states = ends.join(covered, ["origin", "dt"], "left_semi").select(F.col("origin").alias("run_id"))
    grace = F.current_timestamp() - F.make_dt_interval(hours=F.lit(0), secs=F.lit(grace_hours * 3600.0))
    pointer = ledger.current_versions(book)
    return lake.unreferenced_versions(lake.stored_folders(spark, root), pointer, states, grace)


def reclaim(spark: SparkSession, root: str, grace_hours: float = 72) -> int:
    """Delete what ``reclaimable`` names; the number of folders."""
    return lake.remove_folders(spark, root, materialize(reclaimable(spark, root, grace_hours), "reclaimable"))


def repair_table(spark: SparkSession, root: str, table: str) -> None:
    """Point every day of the table at the version the ledger calls current, and no other day.

    Settles a table that a run left half pointed when it was lost.
    """
    pointer = ledger.current_versions(ledger.read_ledger(spark, root)).collect()
    lake.ensure_table(spark, table, root)
    listed = lake.listed_days(spark, table)
    current = {row["dt"] for row in pointer}
    lake.point_days(spark, table, root, (), [day for day in listed if day not in current])
    for run_id in sorted({row["run_id"] for row in pointer}):
        days = sorted(row["dt"] for row in pointer if row["run_id"] == run_id)
        lake.point_days(spark, table, lake.version_path(root, run_id), days)
