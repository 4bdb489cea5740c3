"""Late events merged into stored sessions, against numbering everything again."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gapwise.operators import hot, late
from gapwise.operators.late import merge_late_events
from gapwise.operators.sessions import SESSION_COLUMNS, GapRule, sessionize
from gapwise.scratch import materialize
from tests.test_sessions import random_rows, same

RULE = GapRule(("k",), "t", 3_600, ("id",))
SCHEMA = "k string, t timestamp, id int"


def merged(spark, rows, late_ids, rule=RULE, schema=SCHEMA, hot_rows=None):
    """The merge and the full numbering of ``rows``, of which ``late_ids`` come late."""
    df = spark.createDataFrame(rows, schema)
    is_late = F.col("id").isin(list(late_ids))
    stored = materialize(sessionize(df.filter(~is_late), rule, None), "stored")
    return merge_late_events(stored, df.filter(is_late), rule, hot_rows), sessionize(df, rule, None), stored


def check(spark, rows, late_ids, **more):
    out, full, stored = merged(spark, rows, late_ids, **more)
    out = materialize(out, "out")
    assert same(out.drop("is_changed"), full)
    before = {r["id"]: tuple(r[c] for c in SESSION_COLUMNS) for r in stored.collect()}
    for r in out.collect():
        assert r["is_changed"] == (before.get(r["id"]) != tuple(r[c] for c in SESSION_COLUMNS)), r
    return out


@pytest.mark.parametrize("seed, share, hot_share, tie_share", [(1, 0.1, 0, 0), (2, 0.5, 0.4, 0.3), (3, 0.02, 0.9, 0), (4, 0.95, 0, 0.5)])
def test_equals_numbering_everything_again(spark, seed, share, hot_share, tie_share):
    rows = random_rows(seed, 6, 400, hot_share, tie_share)
    chosen = random.Random(seed)
    check(spark, rows, [r[2] for r in rows if chosen.random() < share])


def at(minutes):
    return datetime(2024, 3, 1, 12) + timedelta(minutes=minutes)


@pytest.mark.parametrize(
    "late_at, sessions",
    [
        ((30,), 3),  # inside a session
        ((-59,), 3),  # before one, within the gap
        ((-60,), 4),  # exactly the gap before: a session of its own
        ((100,), 3),  # nearer to the first session than the gap
        ((105, 160, 210), 2),  # joins two sessions over a chain of late events
        ((300, 5_000, 20_000), 5),  # own sessions between and, days later, after all
        ((-3_000, -2_990), 4),  # before all
    ],
)
def test_places_of_a_late_event(spark, late_at, sessions):
    stored = [("a", at(m), i) for i, m in enumerate((0, 50, 250, 251, 1_500))] + [("b", at(0), 90), (None, at(10), 91)]
    rows = stored + [("a", at(m), 100 + i) for i, m in enumerate(late_at)]
    out = check(spark, rows, range(100, 110))
    assert out.filter("k = 'a'").agg(F.max("session_seq")).first()[0] == sessions
    assert out.filter("k <=> NULL OR k = 'b'").filter("is_changed").isEmpty()


def test_null_keys_new_keys_and_nothing_late(spark):
    rows = [(None, at(m), i) for i, m in enumerate((0, 50, 250, 1_500))] + [("a", at(5), 9)]
    check(spark, rows, [1, 2])
    check(spark, rows, [9])
    check(spark, rows, [])
    check(spark, rows, [0, 1, 2, 3, 9])


def test_several_keys(spark):
    rule = GapRule(("k", "n"), "t", 600, ("id",))
    rows = [(k, i % 3, t, i) for k, t, i in random_rows(8, 3, 200)]
    check(spark, rows, range(0, 200, 7), rule=rule, schema="k string, n int, t timestamp, id int")


def test_hot_key_and_long_tables(spark, monkeypatch):
    """Tables too long to broadcast, and a late key too big for one task."""
    rows = random_rows(5, 4, 300, 0.7)
    monkeypatch.setattr(hot, "BROADCAST_ROWS", 3)
    check(spark, rows, [r[2] for r in rows if r[2] % 4 == 0], hot_rows=30)


def test_only_rows_of_touched_sessions_are_shuffled(spark):
    """Of 5,000 rows the numbering again gets those of the one session that is touched."""
    rows = [(f"u{i % 500}", at(3 * (i // 500) if i % 500 else 400 * (i // 500)), i) for i in range(5_000)]
    rows.append(("u0", at(401), 9_999))
    seen = {}
    real = late.sessionize

    def numbering(df, rule, hot_rows):
        seen["rows"] = df.count()
        return real(df, rule, hot_rows)

    late.sessionize = numbering
    try:
        out, _, _ = merged(spark, rows, [9_999])
    finally:
        late.sessionize = real
    assert seen["rows"] == 2
    plan = out._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    # What remains to be run passes all rows on without moving one: only short tables are broadcast.
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    assert out.filter("is_changed").count() == 1


def test_long_tables_are_not_broadcast(spark, monkeypatch):
    """Spark would send a table that was counted as too long, for the small file it is read from, or
    for the one whose rows are copied to many tasks."""
    rows = random_rows(6, 4, 300)
    monkeypatch.setattr(hot, "BROADCAST_ROWS", 3)
    joined = []
    for hot_rows in (None, 10_000):
        out, _, _ = merged(spark, rows, [r[2] for r in rows if r[2] % 4 == 0], hot_rows=hot_rows)
        joined.append(out)
    table = spark.createDataFrame([("a", 1), (None, 2)], "_of_k string, n int")
    df = spark.createDataFrame(rows, SCHEMA)
    joined.append(hot.spread_join(df, table, F.col("k").eqNullSafe(F.col("_of_k")), "left"))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    for out in joined:
        plan = out._jdf.queryExecution().explainString(mode)
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_long_join_spreads_hot_keys_only(spark, how):
    rows = [(k, at(0), i) for i, k in enumerate(["a"] * 50 + [None] * 40 + ["b", "c", "c"])]
    df = spark.createDataFrame(rows, SCHEMA)
    table = spark.createDataFrame([("a", 1), ("c", 2), (None, 3), ("z", 4)], "_of_k string, n int")
    same = F.col("k").eqNullSafe(F.col("_of_k"))
    found = hot.find_hot_keys(df, ["k"], 20)
    assert sorted(str(r[0]) for r in found.table.collect()) == ["None", "a"]
    out = hot.long_join(df, table, same, how, "_of_", found)
    assert out.columns == df.join(table, same, how).columns
    assert out.exceptAll(df.join(table, same, how)).isEmpty() and out.count() == df.join(table, same, how).count()
