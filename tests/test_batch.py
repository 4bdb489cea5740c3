from __future__ import annotations

import shutil
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from gapwise.operators import metrics
from gapwise.plans.batch import JobSpec, compact_batch, current_events, repair_table, run_batch
from gapwise.scratch import materialize
from gapwise.sources import events as source
from gapwise.sources import lake, ledger

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"

# The golden input rows of all tests here.
SAMPLE = """
2019-10-01 00:00:00 UTC,view,1001,2001,electronics.smartphone,apple,100.00,100,source-session-a
2019-10-01 00:04:59 UTC,cart,1001,2001,electronics.smartphone,apple,100.00,100,source-session-a
2019-10-01 00:09:59 UTC,view,1002,2001,electronics.smartphone,samsung,200.00,100,source-session-a
2019-10-01 00:15:00 UTC,purchase,1002,2001,electronics.smartphone,samsung,200.00,100,source-session-b
2019-10-01 00:01:00 UTC,view,2001,3001,computers.notebook,lenovo,500.00,200,source-session-c
2019-10-01 00:03:00 UTC,view,2002,3001,computers.notebook,asus,700.00,200,source-session-c
2019-10-01 15:30:00 UTC,view,3001,4001,appliances.kitchen.kettle,,30.00,300,source-session-d
2019-10-01 15:34:59 UTC,cart,3001,4001,appliances.kitchen.kettle,,30.00,300,source-session-d
2019-10-01 15:39:59 UTC,purchase,3001,4001,appliances.kitchen.kettle,,30.00,300,source-session-d
"""
MORE = """
2019-10-02 15:10:00 UTC,view,4001,5001,electronics.audio,sony,80.00,400,source-session-e
2019-10-02 15:14:00 UTC,cart,4001,5001,electronics.audio,sony,80.00,400,source-session-e
2019-10-02 15:20:00 UTC,purchase,4001,5001,electronics.audio,sony,80.00,400,source-session-f
"""
AGAIN = """
2019-10-01 15:30:00 UTC,view,3001,4001,appliances.kitchen.kettle,,31.00,300,reprocess-session-a
2019-10-01 15:34:59 UTC,cart,3001,4001,appliances.kitchen.kettle,,31.00,300,reprocess-session-a
"""
HISTORY = """
2019-10-31 14:58:00 UTC,view,8001,9001,electronics.smartphone,apple,100.00,800,source-lookback-a
"""
TARGET = """
2019-10-31 15:01:00 UTC,cart,8002,9001,electronics.smartphone,apple,100.00,800,source-lookback-b
"""


@pytest.fixture
def files(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.write_text(HEADER + "\n" + text.strip() + "\n")
        return str(path)

    return write


def audit(rows):
    return {
        r["dt"]: (r["row_count"], r["users"], r["sessions"])
        for r in metrics.daily_audit(rows).collect()
    }


def spec_for(tmp_path, csv, run_id, start, end, **more):
    return JobSpec(csv, str(tmp_path / "lake"), start, end, run_id, **more)


FATES = ("input_rows", "row_count", "before_range_rows", "after_range_rows", "late_rows", "rejected_rows", "removed_rows")


def fates(spark, root):
    """Row counts other than 0 of each run in the ledger."""
    states = ledger.latest_states(ledger.read_ledger(spark, root)).collect()
    return {r["run_id"]: {c: r[c] for c in FATES if r[c]} for r in states}


@pytest.mark.parametrize("sync", [True, False])
def test_load_add_replace_vanish(spark, tmp_path, files, sync):
    table = f"load_add_replace_{sync}".lower()
    more = {"catalog_sync": sync, "table": table}
    root = str(tmp_path / "lake")

    def published():
        if not sync:
            return lake.read_days(spark, root)
        from_table = spark.table(f"default.{table}")
        assert audit(from_table) == audit(current_events(spark, root))
        return from_table

    first = run_batch(
        spark, spec_for(tmp_path, files("a.csv", SAMPLE), "initial", "2019-10-01", "2019-10-03", **more)
    )
    assert (first.row_count, first.days) == (9, ("2019-10-01", "2019-10-02"))
    assert audit(published()) == {"2019-10-01": (6, 2, 4), "2019-10-02": (3, 1, 2)}

    run_batch(spark, spec_for(tmp_path, files("b.csv", MORE), "add", "2019-10-03", "2019-10-04", **more))
    assert {d: a[0] for d, a in audit(published()).items()} == {
        "2019-10-01": 6, "2019-10-02": 3, "2019-10-03": 3,
    }

    run_batch(spark, spec_for(tmp_path, files("c.csv", AGAIN), "again", "2019-10-02", "2019-10-03", **more))
    days = {r["dt"]: r for r in metrics.day_provenance(published()).collect()}
    assert days["2019-10-02"]["row_count"] == 2
    assert days["2019-10-02"]["run_ids"] == ["again"]
    assert str(days["2019-10-02"]["min_price"]) == str(days["2019-10-02"]["max_price"]) == "31.00"
    assert days["2019-10-01"]["run_ids"] == ["initial"]
    assert days["2019-10-03"]["run_ids"] == ["add"]

    # The new run covers two days but has rows for one: the other must not keep old rows.
    run_batch(spark, spec_for(tmp_path, files("d.csv", AGAIN), "vanish", "2019-10-01", "2019-10-03", **more))
    assert {d: a[0] for d, a in audit(published()).items()} == {"2019-10-02": 2, "2019-10-03": 3}
    if sync:
        assert lake.listed_days(spark, f"default.{table}") == ["2019-10-02", "2019-10-03"]


def test_lookback(spark, tmp_path, files):
    spec = spec_for(
        tmp_path, files("t.csv", TARGET), "look", "2019-11-01", "2019-11-02",
        lookback_input=files("h.csv", HISTORY), catalog_sync=False,
    )
    assert run_batch(spark, spec).row_count == 1
    row = lake.read_days(spark, spec.output).first()
    assert (row["product_id"], row["session_seq"], row["session_event_seq"]) == (8002, 1, 2)
    assert str(row["session_start_at_kst"]) == "2019-10-31 23:58:00"
    # The session opens with the very first event read, so an earlier one might belong to it.
    assert ledger.read_ledger(spark, spec.output).agg({"sessions_at_edge": "max"}).first()[0] == 1


def test_overlapping_lookback(spark, tmp_path, files):
    csv = files("t.csv", HISTORY + TARGET.strip())
    spec = spec_for(
        tmp_path, csv, "overlap", "2019-11-01", "2019-11-02", lookback_input=csv, catalog_sync=False
    )
    assert run_batch(spark, spec).row_count == 2
    once = replace(spec, run_id="once", drop_copies=True)
    assert run_batch(spark, once).row_count == 1
    assert fates(spark, spec.output)["once"] == {"input_rows": 4, "row_count": 1, "before_range_rows": 1, "removed_rows": 2}


def test_ledger_success_and_failure(spark, tmp_path, files):
    root = str(tmp_path / "lake")
    good = spec_for(
        tmp_path, files("a.csv", SAMPLE), "good", "2019-10-01", "2019-10-03", table="ledger_states"
    )
    run_batch(spark, good)
    bad = spec_for(
        tmp_path, str(tmp_path / "none.csv"), "bad", "2019-10-03", "2019-10-05", table="ledger_states"
    )
    with pytest.raises(Exception):
        run_batch(spark, bad)
    book = ledger.read_ledger(spark, root)
    assert book.count() == 4
    states = {r["run_id"]: r for r in ledger.latest_states(book).collect()}
    assert states["good"]["status"] == "SUCCESS"
    assert states["good"]["row_count"] == 9
    assert states["good"]["partitions"] == ["2019-10-01", "2019-10-02"]
    assert states["good"]["completed_at"] >= states["good"]["started_at"]
    assert states["bad"]["status"] == "FAILED"
    assert states["bad"]["row_count"] is None and states["bad"]["partitions"] == []
    assert states["bad"]["error_class"] == "AnalysisException"
    assert "PATH_NOT_FOUND" in states["bad"]["error_message"]

    planned = spark.createDataFrame([(f"2019-10-0{d}",) for d in range(1, 5)], "dt string")
    assert sorted(r["dt"] for r in ledger.redo_days(planned, book).collect()) == [
        "2019-10-03", "2019-10-04",
    ]
    runs = spark.createDataFrame([("good",), ("bad",), ("never",)], "run_id string")
    found = {r["run_id"]: r["outcome"] for r in ledger.run_outcomes(runs, book).collect()}
    assert found == {"good": "done", "bad": "failed", "never": "not done"}

    # A used run id is refused before anything is recorded, and readers see no change.
    with pytest.raises(ValueError, match="used before"):
        run_batch(spark, good)
    assert ledger.read_ledger(spark, root).count() == 4
    assert current_events(spark, root).count() == 9


def test_only_running_is_incomplete(spark, tmp_path):
    root = str(tmp_path / "lake")
    ledger.append_state(spark, root, {"run_id": "x", "status": "RUNNING", "start_date": "2019-10-01",
                                      "end_date": "2019-10-02", "partitions": []})
    runs = spark.createDataFrame([("x",)], "run_id string")
    book = ledger.read_ledger(spark, root)
    assert ledger.run_outcomes(runs, book).first()["outcome"] == "incomplete"
    assert ledger.current_versions(book).count() == 0


def test_modes_do_not_mix(spark, tmp_path, files):
    csv = files("a.csv", SAMPLE)
    run_batch(spark, spec_for(tmp_path, csv, "r1", "2019-10-01", "2019-10-03", catalog_sync=False))
    with pytest.raises(ValueError, match="not published"):
        run_batch(spark, spec_for(tmp_path, csv, "r2", "2019-10-01", "2019-10-03"))


def test_empty_range_fails(spark, tmp_path, files):
    csv = files("a.csv", SAMPLE)
    for sync in (True, False):
        root = tmp_path / str(sync)
        spec = spec_for(root, csv, "r", "2020-01-01", "2020-01-02", catalog_sync=sync, table="empty_range")
        with pytest.raises(ValueError, match="no day"):
            run_batch(spark, spec)
        state = ledger.latest_states(ledger.read_ledger(spark, spec.output)).first()
        assert state["status"] == "FAILED"


def test_rejects_are_kept_apart(spark, tmp_path, files):
    csv = files("bad.csv", SAMPLE + """
not a time,view,1,1,a,b,1.00,100,s
2019-10-01 00:00:00 UTC,view,1,1,a,b,1.00,nobody,s
2019-10-01 00:00:01 UTC,view,x,1,a,b,1.239,200,s""")
    spec = spec_for(tmp_path, csv, "r", "2019-10-01", "2019-10-03", catalog_sync=False)
    assert run_batch(spark, spec).row_count == 10
    state = ledger.latest_states(ledger.read_ledger(spark, spec.output)).first()
    assert state["rejected_rows"] == 2
    assert spark.read.parquet(f"{spec.output}/_rejects/r").count() == 2
    odd = lake.read_days(spark, spec.output).filter("product_id IS NULL").first()
    assert str(odd["price"]) == "1.24"


def test_spec_checks():
    with pytest.raises(ValueError):
        JobSpec("in", "/out", "2019-10-02", "2019-10-02", "r")
    with pytest.raises(ValueError):
        JobSpec("in", "/out", "2019-1-02", "2019-10-02", "r")
    with pytest.raises(ValueError):
        JobSpec("in", "/out", "2019-10-01", "2019-10-02", "")
    spec = JobSpec("Nov, Dec,", "/out", "2019-11-01", "2020-01-01", "r", lookback_input="Oct")
    assert spec.input_paths == ["Oct", "Nov", "Dec"]
    assert spec.repartition_by_dt and spec.catalog_sync
    assert not JobSpec("Nov", "/o", "2019-11-01", "2020-01-01", "r", repartition_by_dt=False).repartition_by_dt
    assert len(spec.days) == 61


def test_path_named_twice_is_read_twice(spark, files):
    csv = files("a.csv", SAMPLE)
    assert source.read_raw_events(spark, source.split_paths(f"{csv}, {csv}")).count() == 18


def test_files_per_day_and_compaction(spark, tmp_path, files):
    root = str(tmp_path / "lake")
    run_batch(
        spark, spec_for(tmp_path, files("a.csv", SAMPLE), "r", "2019-10-01", "2019-10-03", table="compact_src")
    )
    run_batch(
        spark, spec_for(tmp_path, files("b.csv", MORE), "r2", "2019-10-03", "2019-10-04", table="compact_src")
    )
    before = materialize(current_events(spark, root), "before")
    pointer = ledger.current_versions(ledger.read_ledger(spark, root))
    sizes = {r["dt"]: r for r in lake.current_day_files(spark, root, pointer).collect()}
    assert {d: r["files"] for d, r in sizes.items()} == {
        "2019-10-01": 1, "2019-10-02": 1, "2019-10-03": 1,
    }
    small = sizes["2019-10-01"]["bytes"] // 2 + 1
    compact = spec_for(tmp_path, root, "tidy", "2019-10-01", "2019-10-04", table="compact_src")
    assert compact_batch(spark, compact, small).row_count == 12
    pointer = ledger.current_versions(ledger.read_ledger(spark, root))
    assert {r["run_id"] for r in pointer.collect()} == {"tidy"}
    after = current_events(spark, root)
    assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()
    found = {r["dt"]: r["files"] for r in lake.current_day_files(spark, root, pointer).collect()}
    assert found["2019-10-01"] == 2
    assert audit(spark.table("default.compact_src")) == audit(before)


def test_repair_of_a_half_pointed_table(spark, tmp_path, files):
    root, name = str(tmp_path / "lake"), "default.half_pointed"
    more = {"table": "half_pointed"}
    run_batch(spark, spec_for(tmp_path, files("a.csv", SAMPLE), "one", "2019-10-01", "2019-10-03", **more))
    run_batch(spark, spec_for(tmp_path, files("c.csv", AGAIN), "two", "2019-10-02", "2019-10-03", **more))
    # A lost run pointed a day at its own rows and added one, without a SUCCESS row.
    rows = current_events(spark, root).limit(1).withColumn("dt", F.lit("2019-10-01"))
    extra = rows.unionByName(rows.withColumn("dt", F.lit("2019-10-09")))
    stats = lake.stage_version(extra, root, "lost")
    lake.point_days(spark, name, lake.version_path(root, "lost"), stats.days)
    assert audit(spark.table(name))["2019-10-01"][0] == 1
    repair_table(spark, root, name)
    assert audit(spark.table(name)) == audit(current_events(spark, root))
    assert lake.listed_days(spark, name) == ["2019-10-01", "2019-10-02"]


def test_runs_continue_from_state(spark, tmp_path, files):
    root = str(tmp_path / "lake")
    more = {"table": "from_state"}
    first = spec_for(
        tmp_path, files("h.csv", HISTORY), "oct", "2019-10-31", "2019-11-01", keep_state=True, **more
    )
    run_batch(spark, first)
    late = "2019-10-31 15:00:30 UTC,view,1,1,a,b,1.00,900,s"
    spec = spec_for(
        tmp_path, files("t.csv", TARGET + late), "nov", "2019-11-01", "2019-11-02",
        state_from="oct", keep_state=True, **more,
    )
    assert run_batch(spark, spec).row_count == 2
    row = current_events(spark, root).filter("product_id = 8002").first()
    assert (row["session_seq"], row["session_event_seq"]) == (1, 2)
    assert str(row["session_start_at_kst"]) == "2019-10-31 23:58:00"
    states = {r["run_id"]: r for r in ledger.latest_states(ledger.read_ledger(spark, root)).collect()}
    assert (states["nov"]["state_from"], states["nov"]["late_rows"]) == ("oct", 0)
    assert spark.read.parquet(f"{root}/_state/nov").count() == 2

    with pytest.raises(ValueError, match="does not end"):
        run_batch(spark, spec_for(tmp_path, spec.input, "gap", "2019-11-03", "2019-11-04", state_from="nov", **more))
    with pytest.raises(ValueError, match="another session_gap"):
        run_batch(spark, spec_for(tmp_path, spec.input, "gap", "2019-11-02", "2019-11-04", state_from="nov",
                                  session_gap_minutes=9, **more))
    with pytest.raises(ValueError, match="not succeeded"):
        run_batch(spark, spec_for(tmp_path, spec.input, "gap", "2019-11-02", "2019-11-04", state_from="x", **more))
    assert ledger.read_ledger(spark, root).count() == 4


def test_rows_older_than_the_state_are_kept_apart(spark, tmp_path, files):
    root = str(tmp_path / "lake")
    first = spec_for(tmp_path, files("h.csv", TARGET), "one", "2019-11-01", "2019-11-02", keep_state=True,
                     catalog_sync=False)
    run_batch(spark, first)
    # A state that is ahead of the days that follow, as after a clock error.
    state = spark.read.parquet(f"{root}/_state/one").withColumn(
        "last_time", F.to_timestamp(F.lit("2019-11-02 00:00:00"))
    )
    materialize(state, "ahead").write.mode("overwrite").parquet(f"{root}/_state/one")
    rows = """
2019-11-01 20:00:00 UTC,view,1,1,a,b,1.00,800,s
2019-11-02 00:04:00 UTC,view,2,1,a,b,1.00,800,s"""
    second = spec_for(tmp_path, files("n.csv", rows), "two", "2019-11-02", "2019-11-03", state_from="one",
                      catalog_sync=False)
    assert run_batch(spark, second).row_count == 1
    found = ledger.latest_states(ledger.read_ledger(spark, root)).filter("run_id = 'two'").first()
    assert found["late_rows"] == 1
    assert spark.read.parquet(f"{root}/_late/two").first()["product_id"] == 1
    kept = lake.read_days(spark, root).filter("product_id = 2").first()
    assert (kept["session_seq"], kept["session_event_seq"]) == (1, 2)


def test_path_as_table_name(spark, tmp_path, files):
    spec = spec_for(tmp_path, files("a.csv", SAMPLE), "r", "2019-10-01", "2019-10-03", catalog_sync=False)
    run_batch(spark, spec)
    got = spark.sql(f"SELECT cast(dt AS string) AS dt, count(*) AS n FROM parquet.`{spec.output}` GROUP BY dt")
    assert {r["dt"]: r["n"] for r in got.collect()} == {"2019-10-01": 6, "2019-10-02": 3}


def test_hot_users_in_a_run(spark, tmp_path, files):
    runs = {}
    for hot_rows in (None, 2):
        root = tmp_path / str(hot_rows)
        spec = spec_for(
            root, files("a.csv", SAMPLE), "r", "2019-10-01", "2019-10-03", hot_rows=hot_rows,
            table=f"hot_{hot_rows}".lower(),
        )
        assert run_batch(spark, spec).row_count == 9
        runs[hot_rows] = current_events(spark, spec.output).drop("ingested_at")
    assert runs[None].exceptAll(runs[2]).isEmpty() and runs[2].exceptAll(runs[None]).isEmpty()


def test_weekly_users_of_the_table(spark, tmp_path, files):
    spec = spec_for(tmp_path, files("a.csv", SAMPLE), "r", "2019-10-01", "2019-10-03", table="weekly_sql")
    run_batch(spark, spec)
    rows = spark.table(spec.full_table).select("dt", "user_id").collect()
    users = {}
    for dt, user in rows:
        day = date.fromisoformat(dt)
        users.setdefault(day - timedelta(days=day.weekday()), set()).add(user)
    got = metrics.wau_users(spark.table(spec.full_table)).collect()
    assert {r["week_start"]: r["wau_users"] for r in got} == {w: len(u) for w, u in users.items()}
    assert {str(r["week_start"]) for r in got} == {"2019-09-30"}


def test_full_columns_in_order(spark, tmp_path, files):
    spec = spec_for(tmp_path, files("a.csv", SAMPLE), "r", "2019-10-01", "2019-10-03", table="cols")
    run_batch(spark, spec)
    version = lake.version_path(spec.output, "r")
    inferred = spark.read.parquet(version).schema
    assert [f.name for f in inferred] == [f.name for f in lake.LAKE_SCHEMA]
    assert inferred["session_event_seq"].dataType.simpleString() == "bigint"
    assert spark.table("default.cols").schema["dt"].dataType.simpleString() == "string"
    ids = lake.read_days(spark, version).select(F.length("generated_session_id").alias("n"))
    assert {r["n"] for r in ids.collect()} == {64}


def test_rows_before_a_state_run_are_late(spark, tmp_path, files):
    root, more = str(tmp_path / "lake"), {"table": "late_rows"}
    run_batch(spark, spec_for(tmp_path, files("h.csv", HISTORY), "oct", "2019-10-31", "2019-11-01", keep_state=True, **more))
    after = "\n2019-11-05 00:00:00 UTC,view,1,1,a,b,1.00,7,s\nno time,view,1,1,a,b,1.00,7,s"
    csv = files("t.csv", HISTORY + HISTORY.replace("14:58", "14:59").strip() + TARGET + TARGET.strip() + after)
    spec = spec_for(tmp_path, csv, "nov", "2019-11-01", "2019-11-02", state_from="oct", **more)
    assert run_batch(spark, spec).row_count == 2
    assert fates(spark, root)["nov"] == {
        "input_rows": 6, "row_count": 2, "late_rows": 2, "after_range_rows": 1, "rejected_rows": 1,
    }
    late = spark.read.parquet(f"{root}/_late/nov").select(F.minute("event_time_utc")).collect()
    assert sorted(r[0] for r in late) == [58, 59]


def test_repeats_in_the_target_stay_with_a_lookback(spark, tmp_path, files):
    csv = files("t.csv", TARGET + TARGET.strip() + "\n" + TARGET.strip())
    for run_id, history in (("alone", None), ("with", files("h.csv", HISTORY))):
        spec = spec_for(tmp_path, csv, run_id, "2019-11-01", "2019-11-02", lookback_input=history, catalog_sync=False)
        assert run_batch(spark, spec).row_count == 3


def test_rows_without_user_on_request(spark, tmp_path, files):
    csv = files("a.csv", SAMPLE + "2019-10-01 00:00:00 UTC,view,1,1,a,b,1.00,,s")
    for publish, rows in ((False, 9), (True, 10)):
        spec = spec_for(tmp_path, csv, f"r{rows}", "2019-10-01", "2019-10-03", catalog_sync=False, publish_null_users=publish)
        assert run_batch(spark, spec).row_count == rows


@pytest.mark.parametrize("sync", [True, False])
@pytest.mark.parametrize("step", ["write_days", "output_stats", "_write_state", "_keep_late_rows", "sessions_at_edge", "publish"])
def test_a_failed_run_changes_nothing(spark, tmp_path, files, monkeypatch, sync, step):
    name = f"failed_{step}_{sync}".lower()
    more = {"catalog_sync": sync, "table": name}
    root = str(tmp_path / "lake")
    run_batch(spark, spec_for(tmp_path, files("a.csv", HISTORY), "zero", "2019-10-31", "2019-11-01", keep_state=True, **more))
    run_batch(spark, spec_for(tmp_path, files("b.csv", TARGET), "one", "2019-11-01", "2019-11-02", **more))

    def published():
        rows = spark.table(f"default.{name}") if sync else lake.read_days(spark, root)
        return sorted((r["dt"], r["run_id"], r["product_id"]) for r in rows.collect())

    before = published()

    def fail(*args, **options):
        raise OSError(f"{step} is down")

    from gapwise.plans import batch

    place = {"publish": lake if sync else lake, "write_days": lake, "output_stats": lake}.get(step, batch)
    target = ("ensure_table" if sync else "replace_days") if step == "publish" else step
    monkeypatch.setattr(place, target, fail)
    state = None if step == "sessions_at_edge" else "zero"
    spec = spec_for(
        tmp_path, files("c.csv", HISTORY + TARGET.replace("8002", "9999").strip()), "two", "2019-11-01", "2019-11-02",
        state_from=state, keep_state=True, **more,
    )
    with pytest.raises(OSError, match="is down"):
        run_batch(spark, spec)
    monkeypatch.undo()
    assert published() == before
    if sync:
        assert sorted((r["dt"], r["run_id"], r["product_id"]) for r in current_events(spark, root).collect()) == before
    states = {r["run_id"]: r["status"] for r in ledger.latest_states(ledger.read_ledger(spark, root)).collect()}
    assert states == {"zero": "SUCCESS", "one": "SUCCESS", "two": "FAILED"}


def test_the_first_error_reaches_the_caller(spark, tmp_path, files, monkeypatch):
    real = ledger.append_state

    def down(spark, root, fields):
        if fields["status"] == "FAILED":
            raise OSError("ledger down")
        real(spark, root, fields)

    monkeypatch.setattr(ledger, "append_state", down)
    with pytest.raises(Exception, match="PATH_NOT_FOUND") as caught:
        run_batch(spark, spec_for(tmp_path, str(tmp_path / "none.csv"), "r", "2019-10-01", "2019-10-03"))
    assert "ledger down" in caught.value.__notes__[0]


def test_run_ids_with_one_folder_are_refused(spark, tmp_path, files):
    csv = files("a.csv", SAMPLE)
    run_batch(spark, spec_for(tmp_path, csv, "a/b", "2019-10-01", "2019-10-03", catalog_sync=False))
    with pytest.raises(ValueError, match="used before"):
        run_batch(spark, spec_for(tmp_path, csv, "a_b", "2019-10-01", "2019-10-03", catalog_sync=False))


def test_a_rerun_during_a_compaction_stays_current(spark, tmp_path, files, monkeypatch):
    root, more = str(tmp_path / "lake"), {"table": "rerun_compaction"}
    run_batch(spark, spec_for(tmp_path, files("a.csv", SAMPLE), "one", "2019-10-01", "2019-10-03", **more))
    again = spec_for(tmp_path, files("c.csv", AGAIN), "two", "2019-10-02", "2019-10-03", **more)
    real = lake.compact_days

    def meanwhile(*args, **options):
        run_batch(spark, again)
        return real(*args, **options)

    monkeypatch.setattr(lake, "compact_days", meanwhile)
    compact_batch(spark, spec_for(tmp_path, root, "tidy", "2019-10-01", "2019-10-03", **more), 1 << 20)
    pointer = ledger.current_versions(ledger.read_ledger(spark, root)).collect()
    assert {r["dt"]: r["run_id"] for r in pointer} == {"2019-10-01": "tidy", "2019-10-02": "two"}
    assert audit(current_events(spark, root))["2019-10-02"][0] == 2
    assert audit(spark.table("default.rerun_compaction")) == audit(current_events(spark, root))
    # A compaction of the compaction stands in for the same run.
    monkeypatch.undo()
    compact_batch(spark, spec_for(tmp_path, root, "tidier", "2019-10-01", "2019-10-03", **more), 1 << 20)
    pointer = ledger.current_versions(ledger.read_ledger(spark, root)).collect()
    assert {(r["run_id"], r["origin"]) for r in pointer} == {("tidier", "one"), ("tidier", "two")}


def test_a_replaced_state_is_refused(spark, tmp_path, files):
    more = {"table": "replaced_state", "keep_state": True}
    for run_id in ("oct-1", "oct-2"):
        run_batch(spark, spec_for(tmp_path, files("h.csv", HISTORY), run_id, "2019-10-31", "2019-11-01", **more))
    spec = spec_for(tmp_path, files("t.csv", TARGET), "nov", "2019-11-01", "2019-11-02", state_from="oct-1", **more)
    with pytest.raises(ValueError, match="replaced by 'oct-2'"):
        run_batch(spark, spec)
    assert run_batch(spark, replace(spec, state_from="oct-2")).row_count == 1


def test_current_view_of_many_runs_is_one_scan(spark, tmp_path, files):
    root = tmp_path / "lake"
    run_batch(spark, spec_for(tmp_path, files("a.csv", SAMPLE), "r", "2019-10-01", "2019-10-02", table="many_runs"))
    source_day = root / "_versions" / "version=r" / "dt=2019-10-01"
    pointers = []
    for k in range(400):
        day = (date(2019, 1, 1) + timedelta(days=k)).isoformat()
        shutil.copytree(source_day, root / "_versions" / f"version=r{k}" / f"dt={day}")
        pointers.append((day, f"r{k}"))
    pointer = spark.createDataFrame(pointers, "dt string, run_id string")
    rows = lake.current_rows(spark, str(root), pointer)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    assert rows.columns == lake.LAKE_SCHEMA.fieldNames()
    assert rows.count() == 400 * 6
    assert lake.current_day_files(spark, str(root), pointer).count() == 400


def test_files_per_day_by_rows(spark, tmp_path, files):
    for rows, count in ((2, 3), (4, 2), (100, 1)):
        spec = spec_for(tmp_path, files("a.csv", SAMPLE), f"r{rows}", "2019-10-01", "2019-10-03", table="file_rows", file_rows=rows)
        run_batch(spark, spec)
        found = lake.day_files(spark, lake.version_path(spec.output, spec.run_id)).filter("dt = '2019-10-01'").first()
        assert 1 <= found["files"] <= count
        assert current_events(spark, spec.output).count() == 9


def test_two_runs_over_the_same_days_leave_one_result(spark, tmp_path, files, monkeypatch):
    """A run that starts and ends while another one is about to write its SUCCESS row: the later row
    counts, and the table says so too."""
    from gapwise.plans import batch

    first = spec_for(tmp_path, files("a.csv", SAMPLE), "one", "2019-10-01", "2019-10-03", table="two_at_once")
    second = replace(first, input=files("b.csv", AGAIN), run_id="two")
    real, inner = batch._publish, []

    def publish(spark, spec, stats):
        real(spark, spec, stats)
        if spec.run_id == "one" and not inner:
            inner.append(run_batch(spark, second))

    monkeypatch.setattr(batch, "_publish", publish)
    run_batch(spark, first)
    by_ledger = {r["dt"]: r["run_id"] for r in current_events(spark, first.output).select("dt", "run_id").distinct().collect()}
    by_table = {r["dt"]: r["run_id"] for r in spark.table(first.full_table).select("dt", "run_id").distinct().collect()}
    assert by_ledger == by_table == {"2019-10-01": "one", "2019-10-02": "one"}
    spark.sql("DROP TABLE default.two_at_once")


def test_repair_without_any_current_day(spark, tmp_path, files):
    """Partitions that no finished run answers for are dropped, also when they are all."""
    spec = spec_for(tmp_path, files("a.csv", SAMPLE), "one", "2019-10-01", "2019-10-03", table="nothing_current")
    run_batch(spark, spec)
    shutil.rmtree(tmp_path / "lake" / "_runs")
    repair_table(spark, spec.output, spec.full_table)
    assert lake.listed_days(spark, spec.full_table) == []
    spark.sql("DROP TABLE default.nothing_current")
