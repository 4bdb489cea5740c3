"""Sessions from a stream of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gapwise.functions.timeops import local_day
from gapwise.operators.incremental import session_state, sessionize_incremental
from gapwise.operators.sessions import SESSION_COLUMNS, GapRule, sessionize
from gapwise.scratch import materialize, scratch_folder

# Lets each task merge the sessions of its own rows before the shuffle, so a hot user sends
# sessions, not events.
MERGE_BEFORE_SHUFFLE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def read_event_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "parquet",
    bytes_per_batch: str | None = None,
) -> DataFrame:
    """Files of a folder or glob as a stream.

    ``bytes_per_batch`` (such as "500g") takes a long backlog in several batches, oldest files
    first; the watermark then moves between them.
    """
    reader = spark.readStream.schema(schema).format(file_format)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.load(path)


def stream_sessions(events: DataFrame, rule: GapRule, lateness: str) -> DataFrame:
    """One row per session that the watermark has closed.

    Spark's session window joins an event exactly one gap after the last, a gap rule does not.
    On whole seconds the two agree when the window gap is one second shorter; the last event of a
    session is then the window's end minus that shorter gap.
    """
    if rule.gap_seconds < 2:
        raise ValueError("a streamed gap must be two seconds or more")
    shorter = rule.gap_seconds - 1
    window = F.session_window("_second", f"{shorter} seconds")
    return (
        events.withColumn("_second", F.date_trunc("second", F.col(rule.time)))
        .withWatermark("_second", lateness)
        .groupBy(*rule.keys, window)
        .agg(F.count("*").alias("events"))
        .select(
            *rule.keys,
            F.col("session_window.start").alias("session_start"),
            _last_second(F.col("session_window.end"), rule).alias("session_end"),
            "events",
        )
    )


def _last_second(window_end: Column, rule: GapRule) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(window_end) - F.lit(rule.gap_seconds - 1))


def write_sessions(
    sessions: DataFrame, path: str, checkpoint: str, query_name: str | None = None
) -> StreamingQuery:
    """Append closed sessions to Parquet files, taking all input that is there, then stopping.

    A restart from the same checkpoint goes on where a lost driver left off.
    """
    conf = sessions.sparkSession.conf
    before = conf.get(MERGE_BEFORE_SHUFFLE, None)
    writer = (
        sessions.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    conf.set(MERGE_BEFORE_SHUFFLE, "true")
    try:
        # The started query keeps a copy of the settings.
        return (writer.queryName(query_name) if query_name else writer).start(path)
    finally:
        conf.unset(MERGE_BEFORE_SHUFFLE) if before is None else conf.set(MERGE_BEFORE_SHUFFLE, before)


def open_sessions(spark: SparkSession, checkpoint: str, rule: GapRule) -> DataFrame:
    """Sessions that a stopped stream still holds open, in the columns of ``stream_sessions``.

    Read from the state in its checkpoint; a restarted stream may still extend them.
    """
    window = F.col("value.session_window")
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        *[F.col(f"value.{key}").alias(key) for key in rule.keys],
        window["start"].alias("session_start"),
        _last_second(window["end"], rule).alias("session_end"),
        F.col("value.count").alias("events"),
    )


def missed_rows(events: DataFrame, *streamed: DataFrame) -> int:
    """Stored events that are in none of the sessions (closed, open): those that came too late.

    Counted from what is there, so it holds for streams of any length and after restarts.
    """
    found = sum(s.agg(F.coalesce(F.sum("events"), F.lit(0))).first()[0] for s in streamed)
    return events.count() - found


def days_to_redo(
    events: DataFrame, streamed: DataFrame, rule: GapRule, zone: str, closed_until: Column
) -> DataFrame:
    """Local days on which the stream missed late events.

    Sessions cut from the stored events that ended by ``closed_until`` (the final watermark) but
    were not streamed with the same bounds and size; each names the days it touches.
    """
    sizes = (
        sessionize(events, rule)
        .groupBy(*rule.keys, "session_seq")
        .agg(
            F.date_trunc("second", F.min("session_start")).alias("session_start"),
            F.date_trunc("second", F.max(rule.time)).alias("session_end"),
            F.count("*").alias("events"),
        )
        .drop("session_seq")
        .filter(F.col("session_end") <= closed_until)
    )
    missed = sizes.subtract(streamed.select(*sizes.columns))
    first, last = (
        F.to_date(local_day(F.col(c), zone)) for c in ("session_start", "session_end")
    )
    days = missed.select(F.explode(F.sequence(first, last)).alias("day"))
    return days.select(F.col("day").cast("string").alias("dt")).distinct()


# Every so many batches the state is written whole; between them only for the keys of a batch.
WHOLE_STATE_EVERY = 32


def stream_events(
    events: DataFrame, rule: GapRule, root: str, checkpoint: str, whole_every: int = WHOLE_STATE_EVERY
) -> StreamingQuery:
    """Number every event of a stream as it comes; takes all input that is there, then stops.

    A batch is numbered on top of the state that the batches before it left, exactly as
    ``sessionize_incremental`` does, and writes three folders named by its number: its rows, with
    ``is_late`` for those older than their key's last event, and the state of its keys (of all keys
    every ``whole_every`` batches, a number that must not change later).  The state comes last and commits the batch: ``streamed_events`` reads rows of committed batches only.

    A batch that is run again, after a loss at any point, starts from the same state and replaces
    its own folders, so nothing counts twice.  One that had committed is not written again.
    """
    spark = events.sparkSession

    def number(batch: DataFrame, batch_id: int) -> None:
        if batch_id in _batches(spark, root):
            return
        with scratch_folder(spark, "stream"):
            stored = materialize(batch, "stream-batch")
            keys = stored.select(*[F.col(k).alias(f"_{k}") for k in rule.keys]).distinct()
            state = _state_before(spark, root, batch_id, rule, stored, whole_every)
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in rule.keys]
            known = materialize(state.join(keys, same, "left_semi"), "stream-state")
            rows = sessionize_incremental(stored, known, rule)
            rows.write.mode("overwrite").parquet(_batch_path(root, "rows", batch_id))
            _write_batch_state(spark, root, batch_id, rule, known, stored, whole_every)

    writer = events.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(number).start()


def _batch_path(root: str, kind: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/{kind}/batch={batch_id:012d}"


def _batches(spark: SparkSession, root: str) -> list[int]:
    """Committed batches in ascending order: those whose state was written to the end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/state/batch=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])


def _state_columns(rule: GapRule) -> list[str]:
    return [*rule.keys, "last_time", *SESSION_COLUMNS]


def _state_before(
    spark: SparkSession, root: str, batch_id: int, rule: GapRule, like: DataFrame, whole_every: int
) -> DataFrame:
    """The state of all keys after the batches before this one: the last whole state and what
    later batches wrote over it, per key the newest."""
    before = [b for b in _batches(spark, root) if b < batch_id]
    time = like.schema[rule.time].dataType
    fields = [T.StructField(k, like.schema[k].dataType) for k in rule.keys]
    fields += [T.StructField("last_time", time), T.StructField("session_seq", T.LongType())]
    fields += [T.StructField("session_start", time), T.StructField("session_event_seq", T.LongType())]
    if not before:
        return spark.createDataFrame([], T.StructType(fields))
    base = f"{root.rstrip('/')}/state"
    reader = spark.read.option("basePath", base)
    with_batch = T.StructType([*fields, T.StructField("batch", T.LongType())])
    # From the last whole state on.
    whole = max([b for b in before if b % whole_every == 0], default=before[0])
    wanted = [b for b in before if b >= whole]
    states = reader.schema(with_batch).parquet(*[_batch_path(root, "state", b) for b in wanted])
    newest = states.groupBy(*rule.keys).agg(
        F.max_by(F.struct("last_time", *SESSION_COLUMNS), "batch").alias("_newest")
    )
    return newest.select(*rule.keys, "_newest.*")


def _write_batch_state(
    spark: SparkSession, root: str, batch_id: int, rule: GapRule, known: DataFrame, stored: DataFrame, whole_every: int
) -> None:
    rows = spark.read.parquet(_batch_path(root, "rows", batch_id)).filter(~F.col("is_late"))
    state = session_state(rows, rule, known).select(*_state_columns(rule))
    if batch_id % whole_every == 0:
        keys = state.select(*[F.col(k).alias(f"_{k}") for k in rule.keys])
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in rule.keys]
        others = _state_before(spark, root, batch_id, rule, stored, whole_every).join(keys, same, "left_anti")
        state = state.unionByName(others)
    path = _batch_path(root, "state", batch_id)
    state.write.mode("overwrite").parquet(path)


def streamed_events(spark: SparkSession, root: str) -> DataFrame:
    """Numbered rows of all committed batches of ``stream_events``."""
    done = _batches(spark, root)
    if not done:
        raise ValueError(f"no batch was committed below {root}")
    base = f"{root.rstrip('/')}/rows"
    reader = spark.read.option("basePath", base)
    return reader.parquet(*[_batch_path(root, "rows", b) for b in done]).drop("batch")
