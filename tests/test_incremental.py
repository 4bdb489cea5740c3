from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gapwise.operators.incremental import (
    continue_by_ranges,
    session_state,
    sessionize_incremental,
)
from gapwise.operators.sessions import GapRule, sessionize
from gapwise.scratch import materialize
from gapwise.streaming.sessions import (
    days_to_redo,
    missed_rows,
    open_sessions,
    read_event_stream,
    stream_sessions,
    write_sessions,
)
from tests.test_sessions import random_rows, same

CUTS = [datetime(2024, 3, 1, 6), datetime(2024, 3, 2), datetime(2024, 3, 3, 17, 30)]


@pytest.mark.parametrize("hot_share, hot_rows", [(0.0, None), (0.4, None), (0.4, 40), (1.0, 30)])
def test_batches_with_state_equal_full_run(spark, hot_share, hot_rows):
    rule = GapRule(("k",), "t", 3_600, ("id",))
    df = spark.createDataFrame(random_rows(11, 5, 400, hot_share), "k string, t timestamp, id int")
    full = sessionize(df, rule, None)
    state, parts = None, []
    for start, end in zip([None, *CUTS], [*CUTS, None]):
        batch = df
        if start is not None:
            batch = batch.filter(F.col("t") >= F.lit(start))
        if end is not None:
            batch = batch.filter(F.col("t") < F.lit(end))
        if state is None:
            rows = sessionize(batch, rule, hot_rows)
        else:
            rows = sessionize_incremental(batch, state, rule, hot_rows)
            assert rows.filter("is_late").isEmpty()
            rows = rows.drop("is_late")
        rows = materialize(rows, "batch")
        state = materialize(session_state(rows, rule, state), "state")
        parts.append(rows)
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    assert same(together, full)
    assert same(state, session_state(full, rule))


@pytest.mark.parametrize("by_ranges", [False, True])
def test_late_rows_are_marked_and_change_nothing(spark, by_ranges):
    rule = GapRule(("k",), "t", 600, ("id",))
    at = datetime(2024, 1, 1, 12)
    old = spark.createDataFrame(
        [("a", at, 1), ("a", at + timedelta(minutes=5), 2), (None, at, 3)], "k string, t timestamp, id int"
    )
    state = materialize(session_state(sessionize(old, rule, None), rule), "state")
    new = spark.createDataFrame(
        [
            ("a", at + timedelta(minutes=3), 10),
            ("a", at + timedelta(minutes=5), 11),
            ("a", at + timedelta(minutes=14, seconds=59), 12),
            ("a", at + timedelta(minutes=30), 13),
            ("b", at - timedelta(days=1), 14),
            (None, at + timedelta(minutes=1), 15),
        ],
        "k string, t timestamp, id int",
    )
    if by_ranges:
        got = continue_by_ranges(new, state, rule, 3)
    else:
        got = sessionize_incremental(new, state, rule)
    rows = {r["id"]: r for r in got.collect()}
    assert [i for i in rows if rows[i]["is_late"]] == [10]
    assert rows[10]["session_seq"] is None
    numbers = {i: (r["session_seq"], r["session_event_seq"]) for i, r in rows.items() if i != 10}
    assert numbers == {11: (1, 3), 12: (1, 4), 13: (2, 1), 14: (1, 1), 15: (1, 2)}
    assert rows[12]["session_start"] == at and rows[15]["session_start"] == at


def test_one_exchange_for_new_events(spark):
    rule = GapRule(("k",), "t", 600, ("id",))
    df = spark.createDataFrame(random_rows(3, 4, 50), "k string, t timestamp, id int")
    state = materialize(session_state(sessionize(df, rule, None), rule), "state")
    plan = sessionize_incremental(df, state, rule)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1 and "Join" not in plan


def test_state_is_hashed_not_sorted(spark):
    rule = GapRule(("k",), "t", 600, ("id",))
    rows = (
        "k string, t timestamp, id int, "
        "session_seq long, session_start timestamp, session_event_seq long"
    )
    biggest = 2**63 - 1
    df = spark.createDataFrame(
        [("a", CUTS[0], 1, biggest, CUTS[0], biggest), ("a", CUTS[0], 1, 5, CUTS[0], 7)], rows
    )
    state = session_state(df, rule)
    assert "SortAggregate" not in state._jdf.queryExecution().executedPlan().toString()
    assert (state.first()["session_seq"], state.first()["session_event_seq"]) == (biggest, biggest)


def stream_run(spark, source, out, state, rule, lateness="1 hour"):
    schema = "k string, t timestamp, id int"
    stream = read_event_stream(spark, source, spark.createDataFrame([], schema).schema)
    sessions = stream_sessions(stream, rule, lateness)
    query = write_sessions(sessions, out, state)
    query.awaitTermination()
    return query, spark.read.schema(sessions.schema).parquet(out)


def test_stream_equals_batch_for_closed_sessions(spark, tmp_path):
    rule = GapRule(("k",), "t", 300)
    at = datetime(2024, 1, 1)
    rows = [("a", at, 1), ("a", at + timedelta(minutes=5), 2), ("a", at + timedelta(minutes=9, seconds=59), 3),
            ("b", at + timedelta(milliseconds=900), 4), ("b", at + timedelta(minutes=5, milliseconds=100), 5),
            ("end", at + timedelta(days=1), 6)]
    source = str(tmp_path / "in")
    spark.createDataFrame(rows, "k string, t timestamp, id int").write.parquet(source)
    _, got = stream_run(spark, source, str(tmp_path / "out"), str(tmp_path / "state"), rule)
    found = sorted((r["k"], r["session_start"], r["session_end"], r["events"]) for r in got.collect())
    minute = timedelta(minutes=5)
    last = at + timedelta(minutes=9, seconds=59)
    assert found == [("a", at, at, 1), ("a", at + minute, last, 2), ("b", at, at, 1), ("b", at + minute, at + minute, 1)]


def test_stream_late_rows_lead_to_redo_days(spark, tmp_path):
    rule = GapRule(("k",), "t", 300)
    schema, source = "k string, t timestamp, id int", str(tmp_path / "in")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    at = datetime(2024, 1, 1)
    first = [("a", at, 1), ("b", at + timedelta(days=2), 2), ("end", at + timedelta(days=9), 3)]
    spark.createDataFrame(first, schema).write.parquet(source)
    stream_run(spark, source, out, state, rule)
    late = [("a", at + timedelta(days=1), 4), ("b", at + timedelta(days=2, minutes=1), 5)]
    spark.createDataFrame(late, schema).write.mode("append").parquet(source)
    query, streamed = stream_run(spark, source, out, state, rule)
    still_open = open_sessions(spark, state, rule)
    assert query.lastProgress is not None
    assert missed_rows(spark.read.parquet(source), streamed, still_open) == 2
    stored = spark.read.schema(schema).parquet(source)
    days = days_to_redo(stored, streamed, rule, "UTC", F.lit(at + timedelta(days=8)))
    assert sorted(r["dt"] for r in days.collect()) == ["2024-01-02", "2024-01-03"]


def test_stream_needs_two_seconds(spark):
    with pytest.raises(ValueError):
        stream_sessions(spark.createDataFrame([], "k string, t timestamp"), GapRule(("k",), "t", 1), "1 hour")
