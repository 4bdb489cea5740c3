"""Sessions of activity events: the published 18-column shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.functions.ids import session_id
from gapwise.functions.timeops import day_start, gap_in_seconds, local_day, local_time
from gapwise.operators import hot
from gapwise.operators.sessions import GapRule, sessionize

DEFAULT_GAP_MINUTES = 5
DEFAULT_ZONE = "Asia/Seoul"

# Names, types and order of the published columns.  The local-time columns keep
# their suffix whatever zone a run uses.
LAKE_SCHEMA = T.StructType(
    [
        T.StructField("event_time_utc", T.TimestampType()),
        T.StructField("event_time_kst", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DecimalType(18, 2)),
        T.StructField("user_id", T.LongType()),
        T.StructField("source_user_session", T.StringType()),
        T.StructField("generated_session_id", T.StringType()),
        T.StructField("session_seq", T.LongType()),
        T.StructField("session_start_at_utc", T.TimestampType()),
        T.StructField("session_start_at_kst", T.TimestampType()),
        T.StructField("session_event_seq", T.LongType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("dt", T.StringType()),
    ]
)


def event_rule(gap_seconds: int = DEFAULT_GAP_MINUTES * 60, *more_ties: str) -> GapRule:
    """Per user; equal times are ordered by source session, product, then the caller's columns."""
    ties = ("source_user_session", "product_id", *more_ties)
    return GapRule(("user_id",), "event_time_utc", gap_seconds, ties)


def sessionize_events(
    events: DataFrame,
    run_id: str,
    rule: GapRule | None = None,
    zone: str = DEFAULT_ZONE,
    start_date: str | None = None,
    end_date: str | None = None,
    hot_rows: int | None = hot.HOT_ROWS,
    gather_days: bool = False,
    file_rows: int | None = None,
) -> DataFrame:
    """Canonical events to published rows, one out per one in, kept to ``start <= dt < end``.

    ``gather_days`` brings the rows of a day together, as a write by day wants them.  That happens
    before ids, local times and tags are added, so the shuffle carries a third of the bytes.

    Only the upper day bound is applied below the windows, as an instant that the scan can use:
    rows after a day never change the numbers of earlier rows.  Rows before the first day do (they may open its first sessions), so
    the lower bound stays on top.
    """
    if end_date is not None:
        events = events.filter(F.col("event_time_utc") < day_start(end_date, zone))
    numbered = with_day(sessionize(events, rule or event_rule(), hot_rows), zone)
    if start_date is not None:
        numbered = numbered.filter(F.col("dt") >= start_date)
    if gather_days:
        # The days' rows are counted on the input: sessions neither add nor drop rows.
        numbered = gather_by_day(numbered, file_rows, with_day(events, zone))
    return publishable(numbered, run_id, zone)


def with_day(events: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    return events.withColumn("dt", local_day(F.col("event_time_utc"), zone))


# Rows of one task that writes many small files; files above that size have a task each.
TASK_ROWS = 50_000


def deal_days(files: dict[str | None, int], per_task: int) -> tuple[list[tuple[str | None, int, int]], int]:
    """Where the files of each day are written: (day, its first task, its files), and the tasks in all.

    File n of a day is in the n-th task from its first. Up to ``per_task`` days with about as many
    files share tasks, which have one file of each.
    """
    # Rows without a time have no day, and a folder like any other.
    most_first = sorted(files.items(), key=lambda f: (-f[1], f[0] is not None, f[0]))
    plan, tasks = [], 0
    for at in range(0, len(most_first), per_task):
        together = most_first[at : at + per_task]
        plan += [(day, tasks, count) for day, count in together]
        tasks += together[0][1]
    return plan, tasks


def gather_by_day(
    rows: DataFrame, file_rows: int | None = None, counted: DataFrame | None = None
) -> DataFrame:
    """Bring each day's rows together, big days over several tasks.

    With ``file_rows`` a day is dealt to ceil(rows / file_rows) tasks, so gets as many files; if these
    are small, the tasks have files of other days too (see ``deal_days``). The rows per day are counted first (in ``counted``, if that is cheaper to read). Without, a rebalance: a day that outgrows
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` is spread over tasks of about that size.
    """
    if file_rows is None:
        return rows.hint("rebalance", "dt")
    days = (rows if counted is None else counted).groupBy("dt").count()
    counts = {r["dt"]: r["count"] for r in days.collect()}  # one row per calendar day
    files = {day: -(-count // file_rows) for day, count in counts.items()}
    plan, tasks = deal_days(files, max(1, TASK_ROWS // file_rows))
    planned = rows.sparkSession.createDataFrame(plan, "_day string, _first int, _files int")
    row = F.xxhash64(*[c for c in rows.columns if c != "dt"])
    slot = (F.col("_first") + F.pmod(row, "_files")).cast("int")
    placed = rows.join(F.broadcast(planned), F.col("dt").eqNullSafe(F.col("_day")))
    return placed.repartitionById(max(tasks, 1), slot).select(*rows.columns)


def publishable(numbered: DataFrame, run_id: str, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Numbered events with their day, in the published columns: id, local times and run tags."""
    start = F.col("session_start")
    derived = {
        "event_time_kst": local_time(F.col("event_time_utc"), zone),
        "session_start_at_utc": start,
        "session_start_at_kst": local_time(start, zone),
        "generated_session_id": session_id(F.col("user_id"), start),
        "ingested_at": F.current_timestamp(),
        "run_id": F.lit(run_id),
    }
    columns = [
        derived.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in LAKE_SCHEMA
    ]
    return numbered.select(*columns)


def sessions_at_edge(published: DataFrame, read_from: Column, gap_seconds: int) -> DataFrame:
    """Sessions that may have begun before ``read_from``, the first instant that was read.

    They start less than one gap after it, so an event that was not read could have opened them.
    More lookback, or a state table, settles them.
    """
    near = gap_in_seconds(read_from, F.col("session_start_at_utc")) < gap_seconds
    return (
        published.filter(near)
        .select("user_id", "generated_session_id", "session_start_at_utc")
        .distinct()
    )


def session_rollup(published: DataFrame) -> DataFrame:
    """One row per session.  Combines on the map side; reuses a partitioning by user."""
    first = F.min("event_time_utc")
    last = F.max("event_time_utc")
    return published.groupBy("user_id", "generated_session_id").agg(
        F.min("session_start_at_utc").alias("session_start_at_utc"),
        last.alias("session_end_at_utc"),
        F.count("*").alias("events"),
        (F.unix_timestamp(last) - F.unix_timestamp(first)).alias("duration_seconds"),
        F.sum("price").alias("value"),
    )
