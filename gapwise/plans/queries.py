"""The registered queries: every operator over the driver's whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.functions.timeops import (
    day_start,
    local_day,
    local_time,
    parse_event_time,
    utc_clock,
    utc_instant,
    week_start,
)
from gapwise.operators import hot, late, metrics
from gapwise.operators.event_sessions import (
    DEFAULT_ZONE,
    event_rule,
    session_rollup,
    sessionize_events,
    sessions_at_edge,
)
from gapwise.operators.incremental import (
    continue_by_ranges,
    session_state,
    sessionize_incremental,
)
from gapwise.operators.sessions import (
    GapRule,
    mark_boundaries,
    sessionize,
    sessionize_by_chunk,
    sessionize_by_ranges,
)
from gapwise.plans.batch import JobSpec, current_events, run_batch
from gapwise.scratch import materialize, scratch_path
from gapwise.sources import events as source
from gapwise.sources import lake, ledger
from gapwise.sources.samples import raw_events, sample_events, table
from gapwise.streaming import sessions as streaming

Query = Callable[[SparkSession, str], DataFrame]

SHORT_GAP = 300
WIDE_GAP = 21_600
OTHER_ZONE = "America/Phoenix"
# Days that a second run publishes again, and the instant where new events begin.
REDO_START, REDO_END = "2024-01-10", "2024-01-20"
CUT = "2024-01-15 00:00:00"
STREAM_LATENESS = "1 hour"
LATE_PRICE = 40
REDO_PRICE = 120
FILE_ROWS = 300

_QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    """Register under the function's name, without the underscore that avoids a name clash."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(build(spark, sf_dir))

    _QUERIES[build.__name__.rstrip("_")] = run
    return run


def _plain(df: DataFrame) -> DataFrame:
    """Zone-free times, and no column whose value is the time of the call."""
    kept = [f for f in df.schema if f.name != "ingested_at"]
    return df.select(
        *[
            utc_clock(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in kept
        ]
    )


def _published(
    spark: SparkSession, sf_dir: str, gap: int = WIDE_GAP, gather_days: bool = False
) -> DataFrame:
    events = sample_events(spark, sf_dir)
    return sessionize_events(events, "run-1", event_rule(gap), gather_days=gather_days)


def _joined(days: Column) -> Column:
    return F.array_join(F.sort_array(days), ",")


# Scans and input shape


@_query
def canonical_events(spark, sf_dir):
    return source.canonical_events(raw_events(spark, sf_dir))


@_query
def parse_event_time_(spark, sf_dir):
    times = raw_events(spark, sf_dir).select(
        F.col("product_id").alias("event_id"), F.col("event_time").alias("text")
    )
    return times.withColumn("parsed", parse_event_time(F.col("text"), strict=True))



def _csv_copy(events: DataFrame) -> str:
    path = scratch_path(events.sparkSession, "csv")
    events.write.option("header", True).csv(path)
    return path


@_query
def csv_typed_scan(spark, sf_dir):
    path = _csv_copy(raw_events(spark, sf_dir))
    return source.read_raw_events(spark, [path])


@_query
def multi_path_scan(spark, sf_dir):
    raw = raw_events(spark, sf_dir)
    early = _csv_copy(raw.filter(F.col("event_time") < CUT))
    late = _csv_copy(raw.filter(F.col("event_time") >= CUT))
    # The second half is named twice, so it is read twice.
    paths = source.split_paths(f"{late}/part-*, {late}", early)
    return source.read_raw_events(spark, paths)


@_query
def dedup_union(spark, sf_dir):
    events = sample_events(spark, sf_dir)
    history = events.filter(F.col("event_time_utc") < day_start(REDO_END, "UTC"))
    target = events.filter(F.col("event_time_utc") >= day_start(REDO_START, "UTC"))
    return source.drop_copies(source.with_lookback(target, history))


@_query
def reconcile_union(spark, sf_dir):
    """Two inputs that overlap by ten days, each with real repeats of its own."""
    events = sample_events(spark, sf_dir)
    kind, t = F.col("event_type"), F.col("event_time_utc")
    history = _repeated(events.filter(t < day_start(REDO_END, "UTC")), F.when(kind == "error", 2).otherwise(1))
    target = _repeated(events.filter(t >= day_start(REDO_START, "UTC")), F.when(kind == "click", 3).otherwise(1))
    return source.reconcile_union(target, history)


def _repeated(events: DataFrame, times: Column) -> DataFrame:
    return events.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")


@_query
def csv_rescue(spark, sf_dir):
    """Events as CSV lines, some with a price or product that is no number, and the lines of those."""
    raw = raw_events(spark, sf_dir)
    product = F.col("product_id").cast("string")
    texts = {
        "product_id": F.when(F.col("event_type") == "click", F.concat(F.lit("p"), product)).otherwise(product),
        "price": F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("price").cast("string")),
        "user_session": product,
    }
    line = F.concat_ws(",", *[F.coalesce(texts.get(c, F.col(c)).cast("string"), F.lit("")) for c in raw.columns])
    path = scratch_path(spark, "csv")
    # Without a header line, the schema gives the names.
    raw.select(line.alias("value")).write.text(path)
    rescued = source.read_raw_events(spark, [path], rescue=True, header=False)
    return rescued.select("event_time", "event_type", "product_id", "price", "user_session", source.UNPARSED)


# Local time


@_query
def local_day_(spark, sf_dir):
    return _local(spark, sf_dir, DEFAULT_ZONE)


@_query
def local_day_other_zone(spark, sf_dir):
    return _local(spark, sf_dir, OTHER_ZONE)


def _local(spark: SparkSession, sf_dir: str, zone: str) -> DataFrame:
    t = F.col("event_time_utc")
    return sample_events(spark, sf_dir).select(
        "product_id", local_time(t, zone).alias("local_time"), local_day(t, zone).alias("dt")
    )



@_query
def week_start_(spark, sf_dir):
    """The Monday of each day."""
    day = local_day(F.col("event_time_utc"), DEFAULT_ZONE)
    return (
        sample_events(spark, sf_dir)
        .select("product_id", day.alias("dt"))
        .withColumn("week_start", week_start(F.col("dt")))
    )



# Sessions, step by step and whole


@_query
def session_boundaries(spark, sf_dir):
    marked = mark_boundaries(sample_events(spark, sf_dir), event_rule(SHORT_GAP))
    return marked.select(
        "product_id", "user_id", "event_time_utc", "previous_time", "gap_seconds", "is_new_session"
    )


def _session_columns(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return _published(spark, sf_dir).select("product_id", "user_id", *columns)


@_query
def session_numbers(spark, sf_dir):
    return _session_columns(spark, sf_dir, "session_seq")


@_query
def session_starts(spark, sf_dir):
    return _session_columns(spark, sf_dir, "session_start_at_utc", "session_start_at_kst")


@_query
def session_event_numbers(spark, sf_dir):
    return _session_columns(spark, sf_dir, "session_event_seq")


@_query
def session_ids(spark, sf_dir):
    return _session_columns(spark, sf_dir, "generated_session_id")


@_query
def sessionize_full(spark, sf_dir):
    return _published(spark, sf_dir, SHORT_GAP)


@_query
def sessionize_wide_gap(spark, sf_dir):
    return _published(spark, sf_dir, WIDE_GAP)


_NUMBERED = ("product_id", "user_id", "session_seq", "session_start", "session_event_seq")


@_query
def sessionize_split(spark, sf_dir):
    day = F.date_trunc("day", "event_time_utc")
    events = sample_events(spark, sf_dir)
    return sessionize_by_chunk(events, event_rule(WIDE_GAP), day).select(*_NUMBERED)


@_query
def sessionize_hot_ranges(spark, sf_dir):
    """All users by the path that hot users take."""
    events = sample_events(spark, sf_dir)
    ranges = _ranges(events)
    return sessionize_by_ranges(events, event_rule(WIDE_GAP), ranges).select(*_NUMBERED)


def _ranges(events: DataFrame) -> int:
    cores = events.sparkSession.sparkContext.defaultParallelism
    return max(cores, events.count() // hot.HOT_ROWS + 1)


@_query
def sessionize_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", utc_instant(F.col("o_orderdate").cast("timestamp_ntz")).alias("ordered_at")
    )
    rule = GapRule(("o_custkey",), "ordered_at", 90 * 86_400, ("o_orderkey",))
    return sessionize(orders, rule)


@_query
def session_rollup_(spark, sf_dir):
    rolled = session_rollup(_published(spark, sf_dir))
    return rolled.withColumn("value", F.col("value").cast("decimal(18,2)"))



# Day ranges and lookback


@_query
def day_range_filter(spark, sf_dir):
    return sessionize_events(
        sample_events(spark, sf_dir),
        "run-1",
        event_rule(WIDE_GAP),
        start_date=REDO_START,
        end_date=REDO_END,
    )


@_query
def lookback_sessionize(spark, sf_dir):
    """Input of the target days plus one month of history that overlaps it by a day."""
    events = sample_events(spark, sf_dir)
    day = local_day(F.col("event_time_utc"), DEFAULT_ZONE)
    target = events.filter(day >= REDO_START)
    history = events.filter(F.date_sub(F.to_date(day), 1) < REDO_START)
    both = source.drop_copies(source.with_lookback(target, history))
    return sessionize_events(
        both, "run-1", event_rule(WIDE_GAP), start_date=REDO_START, end_date=REDO_END
    )


@_query
def edge_sessions(spark, sf_dir):
    """Sessions left unsure when the days are read without any lookback."""
    day = local_day(F.col("event_time_utc"), DEFAULT_ZONE)
    target = sample_events(spark, sf_dir).filter((day >= REDO_START) & (day < REDO_END))
    rows = sessionize_events(target, "run-1", event_rule(WIDE_GAP))
    return sessions_at_edge(rows, day_start(REDO_START, DEFAULT_ZONE), WIDE_GAP)


@_query
def session_state_(spark, sf_dir):
    rule = event_rule(WIDE_GAP)
    return session_state(sessionize(sample_events(spark, sf_dir), rule), rule)



def _old_state_and_new(
    spark: SparkSession, sf_dir: str, rule: GapRule
) -> tuple[DataFrame, DataFrame]:
    """State up to an instant, and what comes then: newer events, and older errors, which arrive
    late."""
    events = sample_events(spark, sf_dir)
    in_time = (F.col("event_time_utc") < day_start(CUT[:10], "UTC")) & (F.col("event_type") != "error")
    old, new = events.filter(in_time), events.filter(~in_time)
    # State is a stored table, as between two real runs.
    return materialize(session_state(sessionize(old, rule), rule), "state"), new


@_query
def incremental_sessionize(spark, sf_dir):
    rule = event_rule(WIDE_GAP)
    state, new = _old_state_and_new(spark, sf_dir, rule)
    return sessionize_incremental(new, state, rule).select(*_NUMBERED, "is_late")


@_query
def incremental_hot_ranges(spark, sf_dir):
    """All users by the path that hot users take."""
    rule = event_rule(WIDE_GAP)
    state, new = _old_state_and_new(spark, sf_dir, rule)
    return continue_by_ranges(new, state, rule, _ranges(new)).select(*_NUMBERED, "is_late")


@_query
def merge_late_events(spark, sf_dir):
    """Some errors arrive after all other events were numbered."""
    rule = event_rule(WIDE_GAP)
    events = sample_events(spark, sf_dir)
    is_late = (F.col("event_type") == "error") & (F.col("price") > LATE_PRICE)
    stored = materialize(sessionize(events.filter(~is_late), rule), "stored")
    return late.merge_late_events(stored, events.filter(is_late), rule).select(*_NUMBERED, "is_changed")


STREAM_RULE = GapRule(("user_id",), "event_time_utc", WIDE_GAP)


def _streamed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sessions that the stream closed, and those it still holds."""
    schema = table(spark, sf_dir, "events").schema
    files = f"{sf_dir.rstrip('/')}/events*.parquet"
    stream = streaming.read_event_stream(spark, files, schema).select(
        "user_id", utc_instant(F.col("ts")).alias("event_time_utc")
    )
    sessions = streaming.stream_sessions(stream, STREAM_RULE, STREAM_LATENESS)
    out = scratch_path(spark, "stream")
    state = scratch_path(spark, "stream-state")
    query = streaming.write_sessions(sessions, out, state)
    query.awaitTermination()
    closed = spark.read.schema(sessions.schema).parquet(out)
    return closed, streaming.open_sessions(spark, state, STREAM_RULE)


@_query
def stream_sessions(spark, sf_dir):
    return _streamed(spark, sf_dir)[0]


@_query
def stream_all_sessions(spark, sf_dir):
    """Closed and open sessions: every event of the stream."""
    closed, still_open = _streamed(spark, sf_dir)
    return closed.unionByName(still_open)


@_query
def stream_events(spark, sf_dir):
    """Events numbered one by one as three batches bring them, the last one with old errors; the
    stream stops after each and goes on from its checkpoint."""
    rule = event_rule(WIDE_GAP)
    events = sample_events(spark, sf_dir)
    t = F.col("event_time_utc")
    in_time = (t < day_start(CUT[:10], "UTC")) & (F.col("event_type") != "error")
    early = t < day_start(REDO_START, "UTC")
    files, root, checkpoint = (scratch_path(spark, name) for name in ("stream-files", "stream-rows", "stream-log"))
    for batch in (events.filter(in_time & early), events.filter(in_time & ~early), events.filter(~in_time)):
        batch.write.mode("append").parquet(files)
        stream = streaming.read_event_stream(spark, files, events.schema)
        streaming.stream_events(stream, rule, root, checkpoint).awaitTermination()
    return streaming.streamed_events(spark, root).select(*_NUMBERED, "is_late")


@_query
def stream_redo_days(spark, sf_dir):
    """Days whose stored events the stream has not turned into sessions, open ones included."""
    streamed, events = _streamed(spark, sf_dir)[0], sample_events(spark, sf_dir)
    last = events.agg(F.max(F.unix_micros("event_time_utc"))).first()[0]
    end = F.timestamp_micros(F.lit(last))
    return streaming.days_to_redo(events, streamed, STREAM_RULE, DEFAULT_ZONE, end)


# Weekly figures and audits


@_query
def wau_by_user(spark, sf_dir):
    return metrics.wau_users(_published(spark, sf_dir))


@_query
def wau_by_session(spark, sf_dir):
    return metrics.wau_sessions(_published(spark, sf_dir))


@_query
def complete_weeks(spark, sf_dir):
    weekly = metrics.wau_users(_published(spark, sf_dir), "2024-01-03", "2024-01-29")
    return metrics.mark_complete_weeks(weekly, "2024-01-03", "2024-01-29")


@_query
def daily_audit(spark, sf_dir):
    return metrics.daily_audit(_published(spark, sf_dir))


@_query
def global_audit(spark, sf_dir):
    return metrics.global_audit(_published(spark, sf_dir))


@_query
def rolling_users(spark, sf_dir):
    """Distinct users of the seven days up to each day, from stored bitmaps of the days."""
    daily = materialize(metrics.daily_users(_published(spark, sf_dir)), "daily-users")
    return metrics.rolling_users(daily)


# Lake


def _lake_root(spark: SparkSession) -> str:
    return scratch_path(spark, "lake")


def _second_run(spark: SparkSession, sf_dir: str, gather_days: bool = True) -> DataFrame:
    """A later run over some days whose source lost its error events and doubled its prices."""
    events = sample_events(spark, sf_dir).filter(F.col("event_type") != "error")
    doubled = events.withColumn("price", (F.col("price") * 2).cast("decimal(18,2)"))
    return sessionize_events(
        doubled,
        "run-2",
        event_rule(WIDE_GAP),
        start_date=REDO_START,
        end_date=REDO_END,
        gather_days=gather_days,
    )


def _provenance(rows: DataFrame) -> DataFrame:
    return metrics.day_provenance(rows).withColumn("run_ids", _joined(F.col("run_ids")))


@_query
def staged_output_stats(spark, sf_dir):
    root = _lake_root(spark)
    lake.stage_version(_published(spark, sf_dir, gather_days=True), root, "run-1")
    staged = lake.read_days(spark, lake.version_path(root, "run-1"))
    # At most one row per calendar day reaches the second step.
    return lake.day_counts(staged).agg(
        F.sum("row_count").alias("row_count"), _joined(F.collect_set("dt")).alias("days")
    )


@_query
def lake_scan_roundtrip(spark, sf_dir):
    path = lake.version_path(_lake_root(spark), "run-1")
    lake.write_days(_published(spark, sf_dir, gather_days=True), path)
    return lake.read_days(spark, path)


@_query
def files_per_partition(spark, sf_dir):
    """Files of each day, which is to have at most 300 rows a file."""
    path = lake.version_path(_lake_root(spark), "run-1")
    events = sample_events(spark, sf_dir)
    rows = sessionize_events(events, "run-1", event_rule(WIDE_GAP), gather_days=True, file_rows=FILE_ROWS)
    lake.write_days(rows, path)
    counts = lake.day_counts(lake.read_days(spark, path))
    return counts.join(lake.day_files(spark, path).select("dt", "files"), "dt")


@_query
def compacted_days(spark, sf_dir):
    """Days rewritten with a byte target that some days exceed: those get several files, and no day
    more than planned."""
    root = _lake_root(spark)
    rows = _published(spark, sf_dir, gather_days=True)
    lake.write_days(rows, lake.version_path(root, "run-1"))
    pointer = lake.day_counts(lake.read_days(spark, lake.version_path(root, "run-1"))).select(
        "dt", F.lit("run-1").alias("run_id")
    )
    planned = lake.compact_days(spark, root, pointer, "run-1-compact", 16_384)
    plan = spark.createDataFrame(list(planned.items()), "dt string, planned int")
    target = lake.version_path(root, "run-1-compact")
    value = F.sum("price").cast("decimal(18,2)")
    as_planned = (F.col("files") <= F.col("planned")) & (F.col("files") > F.col("planned") / 2)
    return (
        lake.read_days(spark, target)
        .groupBy("dt")
        .agg(F.count("*").alias("row_count"), value.alias("value"))
        .join(lake.day_files(spark, target), "dt")
        .join(F.broadcast(plan), "dt")
        .select("dt", "row_count", "value", as_planned.alias("as_planned"))
    )


@_query
def clustered_days(spark, sf_dir):
    """Days rewritten along a curve over user and time, read back."""
    root = _lake_root(spark)
    lake.write_days(_published(spark, sf_dir, gather_days=True), lake.version_path(root, "run-1"))
    pointer = lake.day_counts(lake.read_days(spark, lake.version_path(root, "run-1"))).select(
        "dt", F.lit("run-1").alias("run_id")
    )
    lake.cluster_days(spark, root, pointer, "run-1-cluster", 32_768)
    return lake.read_days(spark, lake.version_path(root, "run-1-cluster"))


@_query
def replace_days(spark, sf_dir):
    root = _lake_root(spark)
    runs = {"run-1": _published(spark, sf_dir, gather_days=True), "run-2": _second_run(spark, sf_dir)}
    for run_id, rows in runs.items():
        stats = lake.stage_days(rows, root, run_id)
        lake.replace_days(spark, root, run_id, stats.days)
    return _provenance(lake.read_days(spark, root))


def _published_table(spark: SparkSession, sf_dir: str, second: bool) -> str:
    root, name = _lake_root(spark), f"default.sessions_{uuid4().hex}"
    lake.ensure_table(spark, name, root)
    runs = {"run-1": _published(spark, sf_dir, gather_days=True)}
    if second:
        runs["run-2"] = _second_run(spark, sf_dir)
    for run_id, rows in runs.items():
        stats = lake.stage_version(rows, root, run_id)
        lake.point_days(spark, name, lake.version_path(root, run_id), stats.days)
    return name


def _dropped(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """``df`` over the table as stored rows, so that the table need not stay."""
    kept = materialize(df, "from-table")
    spark.sql(f"DROP TABLE {name}")
    return kept


@_query
def publish_versions(spark, sf_dir):
    name = _published_table(spark, sf_dir, second=True)
    return _dropped(spark, name, _provenance(spark.table(name)))


@_query
def table_partitions(spark, sf_dir):
    name = _published_table(spark, sf_dir, second=False)
    return _dropped(spark, name, spark.sql(f"SHOW PARTITIONS {name}"))


@_query
def wau_from_table(spark, sf_dir):
    name = _published_table(spark, sf_dir, second=False)
    return _dropped(spark, name, metrics.weekly_engagement(spark.table(name)))


def _two_runs(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A lake with two finished runs and one that only started, and its ledger rows."""
    root = _lake_root(spark)
    runs = {
        "run-1": (_published(spark, sf_dir, gather_days=True), "2024-01-01", "2024-02-01"),
        "run-2": (_second_run(spark, sf_dir), REDO_START, REDO_END),
    }
    days: dict[str, tuple[str, ...]] = {}
    for run_id, (rows, _, _) in runs.items():
        days[run_id] = lake.stage_version(rows, root, run_id).days
    times = F.timestamp_seconds(F.lit(0))
    book = spark.createDataFrame(
        [
            (run_id, "SUCCESS", start, end, list(days[run_id]), order)
            for order, (run_id, (_, start, end)) in enumerate(runs.items())
        ]
        + [("run-3", "RUNNING", "2024-01-01", "2024-02-01", [], 9)],
        "run_id string, status string, start_date string, end_date string, "
        "partitions array<string>, at int",
    ).withColumn("origins", F.lit(None).cast("map<string,string>")).select(
        "*", times.alias("started_at"), F.timestamp_seconds(F.col("at")).alias("completed_at")
    )
    return root, book


@_query
def current_versions(spark, sf_dir):
    """Two finished runs and one that only started: days follow the last finished run."""
    root, book = _two_runs(spark, sf_dir)
    return _provenance(lake.current_rows(spark, root, ledger.current_versions(book)))


@_query
def unreferenced_versions(spark, sf_dir):
    """Folders of the first run that the second one replaced."""
    root, book = _two_runs(spark, sf_dir)
    no_states = spark.createDataFrame([], "run_id string")
    soon = F.current_timestamp() + F.expr("INTERVAL 1 HOUR")
    folders = lake.stored_folders(spark, root)
    unread = lake.unreferenced_versions(folders, ledger.current_versions(book), no_states, soon)
    return unread.select("folder", (F.col("bytes") > 0).alias("has_bytes"))


@_query
def batch_timestamp(spark, sf_dir):
    """A run tags all its rows with one time, the time of the run."""
    path = lake.version_path(_lake_root(spark), "run-1")
    before = F.lit(spark.sql("SELECT unix_micros(current_timestamp())").first()[0])
    lake.write_days(_published(spark, sf_dir, gather_days=True), path)
    micros = F.unix_micros("ingested_at")
    return lake.read_days(spark, path).agg(
        F.count("ingested_at").alias("row_count"),
        (F.min(micros) == F.max(micros)).alias("one_time"),
        ((F.min(micros) >= before) & (F.max(micros) <= F.unix_micros(F.current_timestamp()))).alias("of_the_run"),
    )


@_query
def day_provenance(spark, sf_dir):
    first, second = _published(spark, sf_dir), _second_run(spark, sf_dir, gather_days=False)
    return _provenance(first.unionByName(second))


@_query
def batch_job(spark, sf_dir):
    """The whole job, from CSV text to the rows that the ledger calls current."""
    spec = JobSpec(
        input=_csv_copy(raw_events(spark, sf_dir)),
        output=_lake_root(spark),
        start_date=REDO_START,
        end_date=REDO_END,
        run_id="job-1",
        table=f"sessions_{uuid4().hex}",
    )
    run_batch(spark, spec)
    return _without_table(spark, spec, current_events(spark, spec.output))


@_query
def batch_job_lookback(spark, sf_dir):
    """The job with a history file whose rows overlap the target's and that has real repeats: every
    row counts, as in a union of the files."""
    raw = raw_events(spark, sf_dir)
    early, late = f"{REDO_START} 00:00:00", f"{REDO_END} 00:00:00"
    overlap = F.date_sub(F.to_date(F.lit(REDO_START)), 1).cast("string")
    target = raw.filter((F.col("event_time") >= overlap) & (F.col("event_time") < late))
    spec = JobSpec(
        input=_csv_copy(target.unionByName(target.filter("event_type = 'error'"))),
        lookback_input=_csv_copy(raw.filter(F.col("event_time") < early)),
        output=_lake_root(spark),
        start_date=REDO_START,
        end_date=REDO_END,
        run_id="job-1",
        table=f"sessions_{uuid4().hex}",
        session_gap_minutes=WIDE_GAP // 60,
        ties=("event_type",),
    )
    run_batch(spark, spec)
    return _without_table(spark, spec, current_events(spark, spec.output)).select(
        "product_id", "user_id", "event_time_utc", "session_seq", "session_event_seq", "dt"
    )


def _without_table(spark: SparkSession, spec: JobSpec, rows: DataFrame) -> DataFrame:
    """``rows`` of the lake's files; the table that the run made is dropped, its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {spec.full_table}")
    return rows


@_query
def state_batches(spark, sf_dir):
    """Two jobs, the second continuing the sessions of the first from its state."""
    raw = raw_events(spark, sf_dir)
    first, _ = _state_runs(spark, _csv_copy(raw), _csv_copy(raw.filter(F.col("event_time") >= _FIRST_SECOND)))
    return _without_table(spark, first, current_events(spark, first.output))


@_query
def state_batches_late(spark, sf_dir):
    """Rows per fate when the second file of ``state_batches`` has rows from before its range."""
    raw = raw_events(spark, sf_dir)
    overlap = F.date_sub(F.to_date(F.lit(REDO_START)), 2).cast("string")
    first, second = _state_runs(spark, _csv_copy(raw), _csv_copy(raw.filter(F.col("event_time") >= overlap)))
    kept = spark.read.parquet(lake.run_folder(first.output, "_late", "job-2")).count()
    states = ledger.latest_states(ledger.read_ledger(spark, first.output)).filter("run_id = 'job-2'")
    fates = states.select("input_rows", "row_count", "late_rows", "after_range_rows", "rejected_rows")
    return _without_table(spark, second, fates.withColumn("late_kept", F.lit(kept)))


# The local midnight at which the second run's range begins.
_FIRST_SECOND = "2024-01-09 15:00:00"


def _state_runs(spark: SparkSession, early: str, late: str) -> tuple[JobSpec, JobSpec]:
    first = JobSpec(
        input=early,
        output=_lake_root(spark),
        start_date="2024-01-01",
        end_date=REDO_START,
        run_id="job-1",
        table=f"sessions_{uuid4().hex}",
        session_gap_minutes=WIDE_GAP // 60,
        keep_state=True,
    )
    second = replace(
        first, input=late, start_date=REDO_START, end_date=REDO_END, run_id="job-2", state_from="job-1"
    )
    run_batch(spark, first)
    run_batch(spark, second)
    return first, second


# Ledger


def _sample_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger made of the events: each user is a lake, each of its days a run."""
    t = F.col("event_time_utc")
    kind = F.col("event_type")
    status = (
        F.when(kind == "purchase", ledger.SUCCESS)
        .when(kind == "error", ledger.FAILED)
        .otherwise(ledger.RUNNING)
    )
    output = F.concat(F.lit("lake-"), F.col("user_id").cast("string"))
    days = sample_events(spark, sf_dir).select(
        output.alias("output"),
        local_day(t, DEFAULT_ZONE).alias("start_date"),
        status.alias("status"),
        t.alias("started_at"),
    )
    done = F.col("status") == ledger.SUCCESS
    rows = days.withColumns(
        {
            "run_id": F.concat_ws("/", "output", "start_date"),
            "end_date": F.date_add("start_date", 1).cast("string"),
            "completed_at": F.when(F.col("status") != ledger.RUNNING, F.col("started_at")),
            "partitions": F.when(done, F.array("start_date")).otherwise(
                F.array().cast("array<string>")
            ),
        }
    )
    # Written and read as a ledger is.
    root = _lake_root(spark)
    ledger.append_rows(rows, root)
    return ledger.read_ledger(spark, root)


@_query
def ledger_latest_state(spark, sf_dir):
    states = ledger.latest_states(_sample_ledger(spark, sf_dir))
    return states.select(
        "run_id", "status", "started_at", ledger.outcome(F.col("status")).alias("outcome")
    )


@_query
def run_outcomes(spark, sf_dir):
    """Every lake has a run planned for each of the days any lake has."""
    book = _sample_ledger(spark, sf_dir)
    first, last = book.agg(F.min("start_date"), F.max("start_date")).first()
    days = F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last))))
    planned = (
        book.select("output")
        .distinct()
        .select("output", days.alias("day"))
        .select(F.concat_ws("/", "output", F.col("day").cast("string")).alias("run_id"))
    )
    return ledger.run_outcomes(planned, book)


@_query
def redo_days(spark, sf_dir):
    book = _sample_ledger(spark, sf_dir)
    planned = book.select("output", F.col("start_date").alias("dt")).distinct()
    return ledger.redo_days(planned, book, ["output"])


@_query
def redo_closure(spark, sf_dir):
    """Each user is a lake and each of its days a run, most of which continue the run of the day
    before or (a fork) of the one before that, or read the files of both. Days with dear errors are
    to be redone."""
    user_days = (
        sample_events(spark, sf_dir)
        .withColumn("start_date", local_day(F.col("event_time_utc"), DEFAULT_ZONE))
        .groupBy(F.concat(F.lit("lake-"), F.col("user_id").cast("string")).alias("output"), "start_date")
        .agg(
            F.max("event_time_utc").alias("completed_at"),
            F.max((F.col("event_type") == "error") & (F.col("price") > REDO_PRICE)).alias("asked"),
        )
    )
    user_days = materialize(user_days, "user-days")
    by_day = Window.partitionBy("output").orderBy("start_date")
    before = [F.lag("start_date", n).over(by_day) for n in (1, 2)]
    number = F.dayofmonth(F.to_date("start_date"))

    def named(*parts: Column | str) -> Column:
        return F.when(parts[-1].isNotNull(), F.concat_ws("/", *parts))

    output = F.col("output")
    files = [named(F.lit("in"), output, day) for day in before]
    rows = user_days.select(
        "output",
        F.concat_ws("/", "output", "start_date").alias("run_id"),
        F.lit(ledger.SUCCESS).alias("status"),
        F.concat_ws("/", F.lit("in"), "output", "start_date").alias("input"),
        F.when(number % 7 == 0, F.concat_ws(", ", *files)).alias("lookback_input"),
        F.when(number % 7 != 0, F.when(number % 5 == 0, named(output, before[1])).otherwise(named(output, before[0]))).alias(
            "state_from"
        ),
        "start_date",
        F.date_add("start_date", 1).cast("string").alias("end_date"),
        F.array("start_date").alias("partitions"),
        "completed_at",
    )
    root = _lake_root(spark)
    ledger.append_rows(rows, root)
    asked = user_days.filter("asked").select("output", F.col("start_date").alias("dt"))
    return ledger.redo_closure(asked, ledger.read_ledger(spark, root), ["output"])


@_query
def weekly_engagement(spark, sf_dir):
    """Flagship: events to sessions to weekly users and sessions in one pass."""
    return metrics.weekly_engagement(_published(spark, sf_dir))


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)
