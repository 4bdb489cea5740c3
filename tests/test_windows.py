"""Rolling users, reconciled inputs, events numbered by a stream, plans of the stitch."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gapwise.operators import metrics
from gapwise.operators.event_sessions import deal_days, gather_by_day
from gapwise.operators.sessions import GapRule, sessionize, sessionize_by_chunk
from gapwise.scratch import materialize, scratch_path
from gapwise.sources import events as source
from gapwise.sources import lake
from gapwise.streaming import sessions as streaming
from tests.test_sessions import random_rows, same


@pytest.mark.parametrize("days", [1, 3, 7])
def test_rolling_users(spark, days):
    rng = random.Random(days)
    start = date(2024, 1, 30)
    rows = [(rng.choice([0, 1, 5, 40_000, 10**12, -7, None]), (start + timedelta(rng.choice([0, 1, 2, 9, 30]))).isoformat()) for _ in range(60)]
    rows += [(3, None), (3, start.isoformat()), (3, (start + timedelta(30)).isoformat())]
    published = spark.createDataFrame(rows, "user_id long, dt string")
    got = {r["dt"]: r["users"] for r in metrics.rolling_users(metrics.daily_users(published), days).collect()}
    want = {}
    for n in range(31):
        end = start + timedelta(n)
        span = {(end - timedelta(k)).isoformat() for k in range(days)}
        want[end.isoformat()] = len({u for u, d in rows if u is not None and d in span})
    assert got == want


def test_rolling_users_of_nothing(spark):
    none = spark.createDataFrame([], "user_id long, dt string")
    assert metrics.rolling_users(metrics.daily_users(none)).collect() == []
    with pytest.raises(ValueError):
        metrics.rolling_users(metrics.daily_users(none), 0)


def test_a_replaced_day_replaces_its_bitmaps(spark):
    """Windows come from the stored bitmaps of the days, whichever run each is from."""
    old = spark.createDataFrame([(u, d) for d in ("2024-01-01", "2024-01-02") for u in range(10)], "user_id long, dt string")
    new = spark.createDataFrame([(u, "2024-01-02") for u in (2, 50)], "user_id long, dt string")
    path = scratch_path(spark, "bitmaps")
    for rows in (old, new):
        daily = metrics.daily_users(rows)
        daily.write.partitionBy("dt").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    stored = spark.read.schema("bucket long, users binary, dt string").parquet(path)
    assert sorted(tuple(r) for r in metrics.rolling_users(stored).collect()) == [("2024-01-01", 10), ("2024-01-02", 11)]


def test_audit_of_days_without_session_starts(spark):
    """A session that skips a day and goes on after it: days with rows count, however many it spans."""
    rows = [(1, 100, d) for d in ("2024-01-01", "2024-01-03")] + [(None, 5, "2024-01-04"), (2, 7, None)]
    df = spark.createDataFrame(rows, "user_id long, session_start_at_utc long, dt string")
    assert tuple(metrics.global_audit(df).first()) == (4, 2, 3, 3)
    assert tuple(metrics.global_audit(df.limit(0)).first()) == (0, 0, 0, 0)


def test_global_audit_has_no_window(spark):
    df = spark.createDataFrame([(1, 1, "2024-01-01")], "user_id long, session_start_at_utc long, dt string")
    assert "Window" not in metrics.global_audit(df)._jdf.queryExecution().toString()


def test_reconciled_copies(spark):
    rng = random.Random(5)
    values = [(None, 1), ("a", None), ("a", 1), ("b", 2), (None, None)]
    target, history = ([v for v in values for _ in range(rng.randrange(5))] for _ in range(2))
    target += [("t", 1)] * 25_000
    history += [("t", 1)] * 24_000 + [("h", 3)]
    a, b = (spark.createDataFrame(rows, "x string, y int") for rows in (target, history))
    got = {(r.x, r.y): r["count"] for r in source.reconcile_union(a, b.select("y", "x")).groupBy("x", "y").count().collect()}
    want = {v: max(target.count(v), history.count(v)) for v in {*target, *history}}
    assert got == want
    assert source.reconcile_union(a.limit(0), b.limit(0)).isEmpty()


def test_rescued_lines(spark, tmp_path):
    path = tmp_path / "in.csv"
    good = "2019-10-01 00:00:00 UTC,view,1,2,c,b,1.50,7,s"
    bad = ["2019-10-01 00:00:00 UTC,view,x,2,c,b,1.50,7,s", "2019-10-01 00:00:00 UTC,view,1,2,c,b,,7,s,more", "only,three,3"]
    path.write_text("\n".join([",".join(source.RAW_EVENT_SCHEMA.fieldNames()), good, *bad]) + "\n")
    rows = source.read_raw_events(spark, [str(path)], rescue=True)
    assert sorted(r[source.UNPARSED] for r in rows.collect() if r[source.UNPARSED] is not None) == sorted(bad)
    plain = source.read_raw_events(spark, [str(path)])
    assert plain.columns == source.RAW_EVENT_SCHEMA.fieldNames()
    assert same(plain, rows.drop(source.UNPARSED))


def test_rows_without_a_day_are_gathered(spark, tmp_path):
    rows = spark.createDataFrame([(i, None if i % 3 else "2024-01-01") for i in range(100)], "id int, dt string")
    placed = gather_by_day(rows, file_rows=10)
    assert same(placed, rows)
    lake.write_days(placed, str(tmp_path / "days"))
    assert spark.read.parquet(str(tmp_path / "days")).count() == 100


def test_small_files_of_several_days_share_tasks(spark, tmp_path):
    """Each day gets its own number of files, from as few tasks as the day with the most needs."""
    days = {"2024-01-01": 90, "2024-01-02": 30, "2024-01-03": 85, None: 5}
    rows = spark.createDataFrame([(i, d) for d, n in days.items() for i in range(n)], "id int, dt string")
    placed = gather_by_day(rows, file_rows=10)
    assert placed.rdd.getNumPartitions() == 9
    lake.write_days(placed, str(tmp_path / "days"))
    files = [p.parent.name for p in (tmp_path / "days").glob("dt=*/*.parquet")]
    assert {d: files.count(f"dt={d}") for d in days if d} == {"2024-01-01": 9, "2024-01-02": 3, "2024-01-03": 9}
    assert same(spark.read.schema(rows.schema).parquet(str(tmp_path / "days")), rows)


def test_days_of_about_as_many_files_are_dealt_together():
    plan, tasks = deal_days({"a": 1, "b": 5, "c": 4, None: 2}, 2)
    assert plan == [("b", 0, 5), ("c", 0, 4), (None, 5, 2), ("a", 5, 1)] and tasks == 7
    assert deal_days({"a": 3, "b": 2}, 1) == ([("a", 0, 3), ("b", 3, 2)], 5)
    assert deal_days({}, 4) == ([], 0)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_ranges_are_sorted_once(spark, monkeypatch):
    """Rows cut into ranges are numbered in one pass; edges and result come from what it wrote."""
    from gapwise.operators import sessions

    df = spark.createDataFrame(random_rows(3, 5, 300), "k string, t timestamp, id int")
    plans = []
    real = sessions.materialize

    def seen(frame, label):
        plans.append((label, plan_of(frame)))
        return real(frame, label)

    monkeypatch.setattr(sessions, "materialize", seen)
    out = sessions.sessionize_by_ranges(df, GapRule(("k",), "t", 3_600, ("id",)), 4)
    ((label, numbered),) = plans
    physical = numbered.split("== Physical Plan ==")[1]
    assert label == "numbered" and physical.count("Sort [") == 1
    assert physical.count("rangepartitioning") == physical.count("hashpartitioning") == 1
    rest = plan_of(out).split("== Physical Plan ==")[1]
    assert "BroadcastHashJoin" in rest and "SortMergeJoin" not in rest


SCHEMA = "k string, t timestamp, id int"
RULE = GapRule(("k",), "t", 3_600, ("id",))


def streamed(spark, folder, files, whole_every=2):
    stream = streaming.read_event_stream(spark, files, spark.createDataFrame([], SCHEMA).schema)
    streaming.stream_events(stream, RULE, f"{folder}/out", f"{folder}/log", whole_every).awaitTermination()


def slices(rows, n):
    rows = sorted(rows, key=lambda r: r[1])
    return [rows[k * len(rows) // n : (k + 1) * len(rows) // n] for k in range(n)]


@pytest.mark.parametrize("whole_every", [1, 3])
def test_streamed_events_equal_one_numbering(spark, tmp_path, whole_every):
    rows = random_rows(7, 6, 300, 0.3)
    files = str(tmp_path / "in")
    for part in slices(rows, 5):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(files)
        streamed(spark, tmp_path, files, whole_every)
    out = streaming.streamed_events(spark, f"{tmp_path}/out")
    assert same(out.drop("is_late"), sessionize(spark.createDataFrame(rows, SCHEMA), RULE, None))
    assert out.filter("is_late").isEmpty()


@pytest.mark.parametrize("lost_at", ["before rows", "before state", "after state"])
def test_a_lost_batch_is_run_again(spark, tmp_path, monkeypatch, lost_at):
    rows = random_rows(9, 5, 240)
    files = str(tmp_path / "in")
    for k, part in enumerate(slices(rows, 4)):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(files)
        if k == 2:
            def lost(*args, **more):
                raise RuntimeError("lost here")

            def after(*args, **more):
                real(*args, **more)
                raise RuntimeError("lost here")

            real = streaming._write_batch_state
            name, how = {
                "before rows": ("sessionize_incremental", lost),
                "before state": ("_write_batch_state", lost),
                "after state": ("_write_batch_state", after),
            }[lost_at]
            with monkeypatch.context() as m:
                m.setattr(streaming, name, how)
                with pytest.raises(Exception, match="lost here"):
                    streamed(spark, tmp_path, files)
            committed = streaming.streamed_events(spark, f"{tmp_path}/out")
            assert committed.count() == sum(map(len, slices(rows, 4)[: 3 if lost_at == "after state" else 2]))
        streamed(spark, tmp_path, files)
    out = streaming.streamed_events(spark, f"{tmp_path}/out")
    assert same(out.drop("is_late"), sessionize(spark.createDataFrame(rows, SCHEMA), RULE, None))


def test_late_events_of_a_stream_keep_out_of_numbers(spark, tmp_path):
    at = datetime(2024, 1, 1, 12)
    files = str(tmp_path / "in")
    for part in ([("a", at, 1), (None, at, 2)], [("a", at - timedelta(hours=3), 3), ("a", at + timedelta(minutes=5), 4), ("b", at, 5)]):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(files)
        streamed(spark, tmp_path, files)
    out = {r["id"]: (r["session_seq"], r["session_event_seq"], r["is_late"]) for r in streaming.streamed_events(spark, f"{tmp_path}/out").collect()}
    assert out == {1: (1, 1, False), 2: (1, 1, False), 3: (None, None, True), 4: (1, 2, False), 5: (1, 1, False)}
    with pytest.raises(ValueError, match="no batch"):
        streaming.streamed_events(spark, str(tmp_path / "nothing"))


def test_materialized_input_is_needed_once(spark):
    """Numbering by chunks gives the same when its input is a random one that is written first."""
    df = materialize(spark.range(500).select(F.col("id").cast("string").alias("k"), F.current_timestamp().alias("t"), F.col("id").cast("int")), "in")
    rule = GapRule(("k",), "t", 60, ("id",))
    assert same(sessionize_by_chunk(df, rule, F.date_trunc("day", "t")), sessionize(df, rule, None))
