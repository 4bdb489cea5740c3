"""Replacement that survives a loss, reclaimed versions, clustered days."""

from __future__ import annotations

import glob
from dataclasses import replace
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gapwise.operators.event_sessions import LAKE_SCHEMA, event_rule, sessionize_events
from gapwise.plans import batch
from gapwise.plans.batch import current_events, reclaim, reclaimable, run_batch
from gapwise.sources import lake, ledger
from gapwise.sources.samples import sample_events
from tests.test_batch import AGAIN, MORE, SAMPLE, files, spec_for  # noqa: F401


def rows_of(spark, run_id, days):
    df = spark.createDataFrame([(f"2024-01-0{d}", d) for d in days], "dt string, product_id long")
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in LAKE_SCHEMA if f.name not in ("dt", "product_id", "run_id")]
    return df.select("*", *columns, F.lit(run_id).alias("run_id")).select(*LAKE_SCHEMA.fieldNames())


def live(spark, root):
    return {r["dt"]: r["run_id"] for r in lake.read_days(spark, root).collect()}


class Lost(Exception):
    pass


# The journal and its rename, six moves of days, three folders removed.
STEPS = 11


@pytest.mark.parametrize("at", range(1, STEPS + 2))
def test_replacement_is_whole_after_a_loss_at_any_step(spark, tmp_path, monkeypatch, at):
    root = str(tmp_path / "lake")
    lake.stage_days(rows_of(spark, "one", [1, 2, 3, 4]), root, "one")
    lake.replace_days(spark, root, "one", ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"])
    old = live(spark, root)
    assert old == {f"2024-01-0{d}": "one" for d in (1, 2, 3, 4)}
    lake.stage_days(rows_of(spark, "two", [2, 3, 5]), root, "two")
    new = {"2024-01-01": "one", "2024-01-02": "two", "2024-01-03": "two", "2024-01-05": "two"}

    done = 0

    def counted(real):
        def step(self, *args):
            nonlocal done
            done += 1
            if done == at:
                raise Lost
            return real(self, *args)

        return step

    with monkeypatch.context() as m:
        for name in ("write_journal", "move", "remove"):
            m.setattr(lake._Files, name, counted(getattr(lake._Files, name)))
        try:
            lake.replace_days(spark, root, "two", ["2024-01-02", "2024-01-03", "2024-01-05"], ["2024-01-04", "2024-01-05"])
            lost = False
        except Lost:
            lost = True
    assert lost == (at <= STEPS)
    journal = lake._Files(spark, root).names("_journal")
    lake.recover_days(spark, root)
    assert live(spark, root) == (new if journal or not lost else old)
    assert lake._Files(spark, root).names("_journal") == [] == lake.recover_days(spark, root)
    if journal or not lost:
        assert not lake._Files(spark, root).exists("_replaced/two")


def test_a_run_recovers_the_one_before(spark, tmp_path, files, monkeypatch):  # noqa: F811
    spec = spec_for(tmp_path, files("a.csv", SAMPLE), "one", "2019-10-01", "2019-10-03", catalog_sync=False)
    with monkeypatch.context() as m:
        m.setattr(lake._Files, "remove", lambda *a: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            run_batch(spark, spec)
    assert lake._Files(spark, spec.output).names("_journal") == ["one.json"]
    run_batch(spark, replace(spec, input=files("b.csv", MORE), run_id="two", start_date="2019-10-03", end_date="2019-10-04"))
    assert lake._Files(spark, spec.output).names("_journal") == []
    assert {r[0] for r in lake.read_days(spark, spec.output).select("run_id").distinct().collect()} == {"one", "two"}


def test_reclaiming_keeps_what_readers_and_chains_need(spark, tmp_path, files):  # noqa: F811
    first = spec_for(tmp_path, files("a.csv", SAMPLE), "one", "2019-10-01", "2019-10-03", keep_state=True, table="reclaimed")
    run_batch(spark, first)
    run_batch(spark, replace(first, input=files("b.csv", MORE), run_id="two", start_date="2019-10-03", end_date="2019-10-04", state_from="one"))
    plan = {r.dt: (r.run_id, r.because, r.steps) for r in batch.redo_plan(spark, first.output, ["2019-10-01"]).collect()}
    assert plan == {
        "2019-10-01": ("one", "asked", 0),
        "2019-10-02": ("one", "same run", 0),
        "2019-10-03": ("two", "state", 1),
    }
    run_batch(spark, replace(first, input=files("c.csv", AGAIN), run_id="three", start_date="2019-10-02", end_date="2019-10-03"))
    before = sorted(current_events(spark, first.output).drop("ingested_at").collect())
    assert reclaimable(spark, first.output).isEmpty(), "everything is younger than the grace period"
    found = {r.folder: (r.files, r.bytes) for r in reclaimable(spark, first.output, -1).collect()}
    # The second day was published again; its first run no longer answers for its last day.
    assert set(found) == {"_versions/version=one/dt=2019-10-02", "_state/one"}
    assert all(n > 0 and size > 0 for n, size in found.values())
    assert reclaim(spark, first.output, -1) == 2 and reclaimable(spark, first.output, -1).isEmpty()
    assert sorted(current_events(spark, first.output).drop("ingested_at").collect()) == before
    run_batch(spark, replace(first, input=files("d.csv", MORE), run_id="four", start_date="2019-10-03", end_date="2019-10-04", state_from="three"))
    spark.sql("DROP TABLE default.reclaimed")


def test_a_failed_run_can_be_reclaimed(spark, tmp_path, files, monkeypatch):  # noqa: F811
    spec = spec_for(tmp_path, files("a.csv", SAMPLE), "one", "2019-10-01", "2019-10-03", table="failed_reclaimed")
    with monkeypatch.context() as m:
        m.setattr(batch, "_publish", lambda *a: (_ for _ in ()).throw(OSError("down")))
        with pytest.raises(OSError):
            run_batch(spark, spec)
    folders = {r.folder for r in reclaimable(spark, spec.output, -1).collect()}
    assert folders == {"_versions/version=one/dt=2019-10-01", "_versions/version=one/dt=2019-10-02"}


def test_interleaved_bits(spark):
    pairs = [(a, b) for a in (0, 1, 2, 5, 2**31 - 1) for b in (0, 1, 3, 2**30)]
    df = spark.createDataFrame(pairs, "a long, b long").select("*", lake.interleaved(F.col("a"), F.col("b")).alias("z"))
    for a, b, z in df.collect():
        assert z == sum(((a >> i & 1) << (2 * i + 1)) | ((b >> i & 1) << (2 * i)) for i in range(31))


def test_a_user_filter_reads_few_row_groups(spark, sf_dir, tmp_path):
    root = str(tmp_path / "lake")
    start = datetime(2024, 1, 1, 1)
    events = spark.range(60_000).select(
        F.timestamp_seconds(F.lit(int(start.timestamp())) + (F.col("id") * 7919) % 80_000).alias("event_time_utc"),
        (F.xxhash64("id") % 2_000 + 2_000).alias("user_id"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("event_type", "string"), ("category_id", "long"), ("category_code", "string"), ("brand", "string"), ("price", "decimal(18,2)"))],
        F.col("id").alias("product_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("source_user_session"),
    )
    rows = sessionize_events(events, "one", event_rule(300), zone="UTC", gather_days=True)
    lake.write_days(rows, lake.version_path(root, "one"))
    pointer = lake.day_counts(lake.read_days(spark, lake.version_path(root, "one"))).select("dt", F.lit("one").alias("run_id"))
    ranges = lake.cluster_days(spark, root, pointer, "two", 1 << 20, row_group_bytes=1 << 16)
    written, copied = (lake.read_days(spark, lake.version_path(root, v)) for v in ("one", "two"))
    assert written.exceptAll(copied).isEmpty() and copied.exceptAll(written).isEmpty()
    groups = []
    found = glob.glob(f"{lake.version_path(root, 'two')}/dt=*/*.parquet")
    assert ranges > 3 and len(found) <= ranges + 1
    for path in found:
        meta = pq.ParquetFile(path).metadata
        place = meta.schema.names.index("user_id")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(place).statistics
            groups.append((stats.min, stats.max))
    assert len(groups) >= 60
    for user in (100, 2_000, 3_500):
        assert sum(low <= user <= high for low, high in groups) < len(groups) / 10


def small_lake(spark, root):
    days = F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string"))
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in LAKE_SCHEMA if f.name not in ("dt", "product_id", "user_id", "event_time_utc", "run_id")]
    rows = spark.range(6_000).select(
        days.alias("dt"), F.col("id").alias("product_id"), (F.col("id") % 97).alias("user_id"), F.timestamp_seconds("id").alias("event_time_utc"), *columns, F.lit("one").alias("run_id")
    ).select(*LAKE_SCHEMA.fieldNames())
    lake.write_days(rows.repartition(1), lake.version_path(root, "one"))
    return rows, spark.createDataFrame([(f"2024-01-0{d}", "one") for d in (1, 2, 3)], "dt string, run_id string")


def seen_tasks(monkeypatch):
    tasks = []
    real = lake.write_days

    def write(rows, path, *args, **options):
        tasks.append(rows.rdd.getNumPartitions())
        return real(rows, path, *args, **options)

    monkeypatch.setattr(lake, "write_days", write)
    return tasks


def test_a_compaction_into_small_files_takes_few_tasks(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    rows, pointer = small_lake(spark, root)
    tasks = seen_tasks(monkeypatch)
    planned = lake.compact_days(spark, root, pointer, "two", 2_048)
    assert tasks == [max(planned.values())] and sum(planned.values()) > 2 * tasks[0] > 10
    copied = lake.version_path(root, "two")
    assert {r["dt"]: r["files"] for r in lake.day_files(spark, copied).collect()} == planned
    assert lake.read_days(spark, copied).exceptAll(rows).isEmpty() and lake.read_days(spark, copied).count() == 6_000


def test_small_clustered_files_take_few_tasks(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    rows, pointer = small_lake(spark, root)
    tasks = seen_tasks(monkeypatch)
    asked = lake.cluster_days(spark, root, pointer, "two", 2_048)
    assert tasks == [1] and asked > 10
    copied = lake.version_path(root, "two")
    found = glob.glob(f"{copied}/dt=*/*.parquet")
    assert asked <= len(found) <= asked + 3
    assert max(pq.ParquetFile(p).metadata.num_rows for p in found) <= -(-6_000 // asked)
    assert lake.read_days(spark, copied).exceptAll(rows).isEmpty() and lake.read_days(spark, copied).count() == 6_000


def test_a_run_with_cut_lines(spark, tmp_path, files):  # noqa: F811
    """Fields that do not parse are published as NULL and kept as text, or rejected, or ignored."""
    text = SAMPLE.replace("view,1001", "view,x1001").replace("700.00", "seven hundred")
    root = {}
    for how in ("keep", "reject", "ignore"):
        spec = spec_for(tmp_path / how, files(f"{how}.csv", text), how, "2019-10-01", "2019-10-03", unparsed=how, table=f"cut_{how}")
        root[how] = spec.output
        run_batch(spark, spec)
        spark.sql(f"DROP TABLE default.cut_{how}")
    states = {how: ledger.latest_states(ledger.read_ledger(spark, root[how])).first() for how in root}
    assert [states[h]["unparsed_rows"] for h in ("keep", "reject", "ignore")] == [2, 2, None]
    assert [states[h]["row_count"] for h in ("keep", "reject", "ignore")] == [9, 7, 9]
    assert [states[h]["rejected_rows"] for h in ("keep", "reject", "ignore")] == [0, 2, 0]
    lines = sorted(r[0] for r in spark.read.parquet(lake.run_folder(root["keep"], "_unparsed", "keep")).select("unparsed_line").collect())
    assert lines == sorted(line for line in text.strip().split("\n") if "x1001" in line or "seven" in line)
    kept, ignored = (current_events(spark, root[h]).drop("run_id", "ingested_at") for h in ("keep", "ignore"))
    assert kept.exceptAll(ignored).isEmpty() and ignored.exceptAll(kept).isEmpty()
    with pytest.raises(ValueError, match="unparsed"):
        replace(spec, unparsed="no")


def test_a_run_with_reconciled_files(spark, tmp_path, files):  # noqa: F811
    """Overlap counts once, repeats stay, and the ledger has what was taken away."""
    lines = SAMPLE.strip().split("\n")
    target, history = "\n".join(lines + lines[:1]), "\n".join(lines[:2] + MORE.strip().split("\n")[:1])
    spec = spec_for(
        tmp_path, files("t.csv", target), "one", "2019-10-01", "2019-10-04", lookback_input=files("h.csv", history), reconcile=True, table="reconciled"
    )
    run_batch(spark, spec)
    state = ledger.latest_states(ledger.read_ledger(spark, spec.output)).first()
    assert (state["input_rows"], state["row_count"], state["removed_rows"]) == (13, 11, 2)
    products = sorted(r[0] for r in current_events(spark, spec.output).select("product_id").collect())
    assert products == [1001] * 3 + [1002] * 2 + [2001, 2002] + [3001] * 3 + [4001]
    spark.sql("DROP TABLE default.reconciled")
    with pytest.raises(ValueError, match="reconciled"):
        replace(spec, drop_copies=True)
