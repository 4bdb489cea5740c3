from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gapwise.functions.timeops import (
    day_start,
    local_day,
    local_time,
    parse_event_time,
    week_start,
)
from gapwise.operators import hot
from gapwise.operators.event_sessions import (
    LAKE_SCHEMA,
    event_rule,
    publishable,
    session_rollup,
    sessionize_events,
    with_day,
)
from gapwise.operators.sessions import (
    GapRule,
    mark_boundaries,
    sessionize,
    sessionize_by_chunk,
    sessionize_by_ranges,
)
from gapwise.sources.events import RAW_EVENT_SCHEMA, canonical_events
from gapwise.sources.samples import sample_events

COLUMNS = ["session_seq", "session_start", "session_event_seq"]


def raw(spark, *rows):
    """Rows of (time text, product, user, source session)."""
    full = [
        (text, "view", product, 10, None, None, Decimal("10.00"), user, own)
        for text, product, user, own in rows
    ]
    return canonical_events(spark.createDataFrame(full, RAW_EVENT_SCHEMA))


def by_product(df):
    return {r["product_id"]: r for r in df.collect()}


def same(a, b):
    a = a.select(*sorted(a.columns))
    b = b.select(*sorted(b.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def brute_force(rows, gap):
    """Number (key, time, tie) rows one by one, as the definition reads."""
    result, last, seq, start, n = {}, {}, {}, {}, {}
    for key, t, tie in sorted(rows, key=lambda r: (r[1], r[2])):
        cut = t.replace(microsecond=0)
        if key not in last or (cut - last[key]).total_seconds() >= gap:
            seq[key], start[key], n[key] = seq.get(key, 0) + 1, t, 0
        last[key] = cut
        n[key] += 1
        result[(key, t, tie)] = (seq[key], start[key], n[key])
    return result


def test_gap_edge_ids_and_source_session(spark):
    """A gap of 299 seconds goes on, one of 300 opens a session, whatever the source calls it."""
    at = datetime(2023, 3, 9, 11, 11, 11)
    steps = [0, 299, 299 + 300, 2 * 299 + 300, 2 * 299 + 600]
    rows = [
        (f"{at + timedelta(seconds=s)} UTC", 10 + k, user, f"own-{k % 2}")
        for user in (41, 42)
        for k, s in enumerate(steps)
    ]
    sessions = {}
    for r in sessionize_events(raw(spark, *rows), "r").collect():
        assert r["source_user_session"] == f"own-{r['product_id'] % 2}"
        place = (r["product_id"], r["session_seq"], r["session_event_seq"])
        sessions.setdefault(r["generated_session_id"], []).append((r["user_id"], *place))
    parts = [[(10, 1, 1), (11, 1, 2)], [(12, 2, 1), (13, 2, 2)], [(14, 3, 1)]]
    expected = [[(user, *p) for p in part] for user in (41, 42) for part in parts]
    assert sorted(sorted(v) for v in sessions.values()) == expected


def test_more_history_moves_numbers_but_not_ids(spark):
    rows = [(f"2023-06-0{d} 23:59:00 UTC", d, 5, "s") for d in range(1, 8)]
    whole = by_product(sessionize_events(raw(spark, *rows), "r"))
    for first in range(1, 7):
        part = by_product(sessionize_events(raw(spark, *rows[first:]), "r"))
        for product, row in part.items():
            assert row["generated_session_id"] == whole[product]["generated_session_id"]
            assert row["session_seq"] == whole[product]["session_seq"] - first
            assert row["dt"] == f"2023-06-0{product + 1}"


def test_a_session_goes_on_into_the_first_asked_day(spark):
    """Events every four minutes over local midnight: the day's first rows keep numbers and start."""
    midnight = datetime(2023, 8, 1, 15)
    rows = [(f"{midnight + timedelta(minutes=4 * k)} UTC", k + 50, 6, "s") for k in range(-3, 3)]
    kept = by_product(
        sessionize_events(raw(spark, *rows), "r", start_date="2023-08-02", end_date="2023-08-03")
    )
    assert {p: r["session_event_seq"] for p, r in kept.items()} == {50: 4, 51: 5, 52: 6}
    assert {r["session_start_at_kst"] for r in kept.values()} == {datetime(2023, 8, 1, 23, 48)}


def zone_free(spark, sf_dir):
    """What a run publishes, with times as numbers."""
    rows = sessionize_events(sample_events(spark, sf_dir), "r", start_date="2024-01-05", end_date="2024-03-12")
    times = [f.name for f in rows.schema if f.dataType.typeName() == "timestamp" and f.name != "ingested_at"]
    out = rows.select(*[F.unix_micros(c).alias(c) if c in times else c for c in rows.columns if c != "ingested_at"])
    return sorted(out.collect(), key=lambda r: r["product_id"])


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Kolkata"])
def test_published_rows_do_not_depend_on_the_session_zone(spark, sf_dir, zone):
    expected = zone_free(spark, sf_dir)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert zone_free(spark, sf_dir) == expected
        text = spark.createDataFrame([("2024-03-10 02:30:00 UTC",)], "s string")
        parsed = [F.unix_seconds(parse_event_time(F.col("s"), strict)) for strict in (False, True)]
        assert list(text.select(*parsed).first()) == [1_710_037_800] * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("zone", ["Asia/Seoul", "America/New_York", "America/Santiago", "Pacific/Apia"])
def test_day_start_is_the_first_instant_of_its_day(spark, zone):
    hours = spark.range(0, 24 * 366).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 3600).alias("t")
    )
    for day in ("2024-03-10", "2024-04-07", "2024-09-08", "2024-11-03"):
        agree = hours.filter((F.col("t") >= day_start(day, zone)) != (local_day(F.col("t"), zone) >= day))
        assert agree.isEmpty()


def test_upper_day_bound_below_windows_changes_nothing(spark, sf_dir):
    events, rule = sample_events(spark, sf_dir), event_rule(21_600)
    kept = sessionize_events(events, "r", rule, start_date="2024-01-09", end_date="2024-01-12")
    whole = sessionize_events(events, "r", rule).filter("dt >= '2024-01-09' AND dt < '2024-01-12'")
    assert same(kept.drop("ingested_at"), whole.drop("ingested_at"))


def test_gap_uses_whole_seconds(spark):
    rows = [("a", datetime(2024, 1, 1, 0, 0, 0, 900_000)), ("a", datetime(2024, 1, 1, 0, 5, 0, 100_000))]
    df = spark.createDataFrame(rows, "k string, t timestamp")
    assert sessionize(df, GapRule(("k",), "t", 300)).agg(F.max("session_seq")).first()[0] == 2


def test_null_user_and_null_time(spark):
    rows = raw(
        spark,
        ("2019-10-01 00:00:00 UTC", 1, None, "a"),
        ("2019-10-01 00:01:00 UTC", 2, None, "b"),
        ("no time", 3, 5, "c"),
        ("no time", 4, 5, "d"),
        ("2019-10-01 00:00:00 UTC", 5, 5, "e"),
    )
    got = by_product(sessionize_events(rows, "r"))
    assert [got[p]["session_seq"] for p in (1, 2, 3, 4, 5)] == [1, 1, 1, 2, 3]
    assert got[1]["generated_session_id"] == got[2]["generated_session_id"]
    assert got[3]["dt"] is None
    for other in (
        sessionize(rows, event_rule(), 1),
        sessionize_by_chunk(rows, event_rule(), F.date_trunc("hour", "event_time_utc")),
    ):
        assert same(other, sessionize(rows, event_rule(), None))


def test_bad_time_text(spark):
    df = spark.createDataFrame([("2019-10-01 00:00:00 UTC",), ("x",), (None,)], "s string")
    got = df.select(parse_event_time(F.col("s")).alias("t")).collect()
    assert [r["t"] for r in got] == [datetime(2019, 10, 1), None, None]
    with pytest.raises(Exception):
        df.select(parse_event_time(F.col("s"), strict=True).alias("t")).collect()


def test_daylight_saving_zone(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 11, 3, 5, 30),), (datetime(2024, 11, 3, 6, 30),), (datetime(2024, 11, 4, 4, 59),)],
        "t timestamp",
    )
    zone = "America/New_York"
    got = df.select(local_time(F.col("t"), zone).alias("l"), local_day(F.col("t"), zone).alias("d")).collect()
    assert got[0]["l"] == got[1]["l"] == datetime(2024, 11, 3, 1, 30)
    assert [r["d"] for r in got] == ["2024-11-03"] * 3


def test_week_start_is_monday(spark):
    days = spark.sql("SELECT explode(sequence(date'1969-12-20', date'1970-01-20')) AS d")
    for row in days.select("d", week_start(F.col("d").cast("string")).alias("w")).collect():
        assert row["w"] == row["d"] - timedelta(days=row["d"].weekday())


def test_published_shape(spark, sf_dir):
    rows = sessionize_events(sample_events(spark, sf_dir), "run-9")
    assert [(f.name, f.dataType) for f in rows.schema] == [
        (f.name, f.dataType) for f in LAKE_SCHEMA
    ]
    assert rows.select("run_id").distinct().first()[0] == "run-9"
    assert rows.select("ingested_at").distinct().count() == 1


@pytest.mark.parametrize("gap, expected", [(300, 990), (1_800, 946), (21_600, 585)])
def test_known_session_counts(spark, sf_dir, gap, expected):
    rows = sessionize_events(sample_events(spark, sf_dir), "r", event_rule(gap))
    assert rows.select("generated_session_id").distinct().count() == expected
    assert rows.count() == 1_000
    # One id per (user, start) and the other way round.
    pairs = rows.select("user_id", "session_start_at_utc", "generated_session_id").distinct()
    assert pairs.count() == expected
    rolled = session_rollup(rows)
    assert rolled.count() == expected
    assert rolled.agg(F.sum("events")).first()[0] == 1_000


def test_session_properties(spark, sf_dir):
    gap = 21_600
    rows = session_rollup(sessionize_events(sample_events(spark, sf_dir), "r", event_rule(gap)))
    users: dict[int, list] = {}
    for r in rows.collect():
        users.setdefault(r["user_id"], []).append(r)
    for sessions in users.values():
        sessions.sort(key=lambda r: r["session_start_at_utc"])
        for one, two in zip(sessions, sessions[1:]):
            end = one["session_end_at_utc"].replace(microsecond=0)
            start = two["session_start_at_utc"].replace(microsecond=0)
            assert (start - end).total_seconds() >= gap


def random_rows(seed, users, n, hot_share=0.0, tie_share=0.0):
    rng = random.Random(seed)
    base = datetime(2024, 3, 1)
    rows, t = [], base
    for i in range(n):
        key = "hot" if rng.random() < hot_share else f"u{rng.randrange(users)}"
        if rng.random() >= tie_share:
            t = base + timedelta(seconds=rng.randrange(4 * 86_400), microseconds=rng.randrange(1_000_000))
        rows.append((key, t, i))
    return rows


@pytest.mark.parametrize(
    "seed, hot_share, tie_share, gap",
    [
        (1, 0.0, 0.0, 300),
        (2, 0.35, 0.0, 2),
        (2, 0.35, 0.0, 7_200),
        (3, 0.35, 0.5, 300),
        (3, 0.35, 0.5, 7_200),
        (4, 1.0, 0.9, 2),
        (4, 1.0, 0.9, 7_200),
    ],
)
def test_all_paths_match_brute_force(spark, seed, hot_share, tie_share, gap):
    rows = random_rows(seed, 6, 400, hot_share, tie_share)
    expected = brute_force(rows, gap)
    shuffled = random.Random(seed).sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, "k string, t timestamp, id int").repartition(3)
    rule = GapRule(("k",), "t", gap, ("id",))
    paths = {
        "plain": sessionize(df, rule, None),
        "hot": sessionize(df, rule, 90),
        "day": sessionize_by_chunk(df, rule, F.date_trunc("day", "t")),
        "minute": sessionize_by_chunk(df, rule, F.date_trunc("minute", "t")),
        "hot day": sessionize_by_chunk(df, rule, F.date_trunc("day", "t"), 60),
    }
    for name, result in paths.items():
        got = {(r["k"], r["t"], r["id"]): tuple(r[c] for c in COLUMNS) for r in result.collect()}
        assert got == expected, name
    assert same(mark_boundaries(df, rule, 90), mark_boundaries(df, rule, None))


def test_copies_of_one_row_spread_over_ranges(spark):
    """Two thirds of the rows are one row; the ranges still come out about even."""
    rows = [("a", datetime(2024, 1, 1), 1)] * 2_000 + [
        ("a", datetime(2024, 1, 1) + timedelta(seconds=40 * i), i) for i in range(1, 1_000)
    ]
    df = spark.createDataFrame(rows, "k string, t timestamp, id int").repartition(4)
    rule = GapRule(("k",), "t", 60, ("id",))
    cut = hot.cut_into_ranges(df, rule, 6)
    sizes = [r["count"] for r in cut.groupBy("_chunk").count().collect()]
    assert len(sizes) == 6 and max(sizes) < 1_000
    got = sessionize_by_ranges(df, rule, 6)
    assert same(got, sessionize(df, rule, None))
    numbers = sorted(r[0] for r in got.select("session_event_seq").collect())
    assert numbers == list(range(1, 3_000))


def test_hot_keys_from_a_sample(spark):
    """With a limit above the sampled size, keys far from it are still told apart exactly."""
    limit = 10 * hot.SAMPLED_ROWS
    rows = spark.range(8 * limit).select(
        F.when(F.col("id") % 2 == 0, 0)
        .when(F.col("id") % 4 == 1, 1)
        .otherwise(2 + F.col("id") % 40)
        .alias("k"),
        F.timestamp_seconds(F.col("id") * 7).alias("t"),
        "id",
    )
    found = hot.find_hot_keys(rows, ["k"], limit)
    assert sorted(r[0] for r in found.table.collect()) == [0, 1]
    assert abs(found.rows - 6 * limit) < 0.1 * limit
    rule = GapRule(("k",), "t", 15, ("id",))
    split, whole = sessionize(rows, rule, limit), sessionize(rows, rule, None)
    check = F.bit_xor(F.xxhash64("k", "t", "id", *COLUMNS)), F.count("*")
    assert split.agg(*check).first() == whole.agg(*check).first()


def test_several_keys_and_key_types(spark):
    rows = [
        ("x" if i % 2 else None, i % 3 == 0, datetime(2024, 1, 1) + timedelta(minutes=7 * i), i)
        for i in range(120)
    ]
    df = spark.createDataFrame(rows, "a string, b boolean, t timestamp, id int")
    rule = GapRule(("a", "b"), "t", 1_500, ("id",))
    assert same(sessionize(df, rule, 15), sessionize(df, rule, None))


def test_zone_free_time_column(spark):
    df = spark.sql(
        "SELECT id % 2 AS k, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id * 4) AS t, id "
        "FROM range(60)"
    )
    rule = GapRule(("k",), "t", 600, ("id",))
    assert same(sessionize(df, rule, 10), sessionize(df, rule, None))


def test_rule_checks():
    with pytest.raises(ValueError):
        GapRule(("k",), "t", 0)
    with pytest.raises(ValueError):
        GapRule((), "t", 5)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_one_exchange_one_sort(spark, sf_dir):
    rows = sessionize_events(sample_events(spark, sf_dir), "r")
    plan = plan_of(rows)
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    # The roll-up per session stays on the partitioning by user.
    assert plan_of(session_rollup(rows)).count("Exchange hashpartitioning") == 1


def test_plan_day_bounds(spark, sf_dir, tmp_path):
    """The upper bound reaches the scan, the lower one stays above the windows."""
    sample_events(spark, sf_dir).write.parquet(str(tmp_path / "canonical"))
    rows = sessionize_events(
        spark.read.parquet(str(tmp_path / "canonical")), "r", start_date="2024-01-10", end_date="2024-01-20"
    )
    plan = plan_of(rows)
    assert "LessThan(event_time_utc,2024-01-19 15:00:00.0)" in plan
    assert plan.index(">= 2024-01-10") < plan.index("Window")


def test_plan_figures_group_by_user_first(spark, sf_dir):
    from gapwise.operators import metrics

    rows = sessionize_events(sample_events(spark, sf_dir), "r", event_rule(21_600))
    for figures in (metrics.weekly_engagement, metrics.wau_sessions, metrics.daily_audit, metrics.global_audit):
        plan = plan_of(figures(rows))
        assert "Expand" not in plan and "sha2" not in plan
        assert plan.count("Exchange hashpartitioning") == 2
        assert plan.count("Exchange hashpartitioning(user_id") == 1


def test_figures_with_null_users(spark):
    from gapwise.operators import metrics

    rows = sessionize_events(
        raw(
            spark,
            ("2024-01-01 00:00:00 UTC", 1, None, "a"),
            ("2024-01-02 00:00:00 UTC", 2, None, "a"),
            ("2024-01-01 14:59:00 UTC", 3, 7, "a"),
            ("2024-01-01 15:01:00 UTC", 4, 7, "a"),
        ),
        "r",
    )
    daily = [tuple(r) for r in metrics.daily_audit(rows).collect()]
    assert daily == [("2024-01-01", 2, 1, 2), ("2024-01-02", 2, 1, 2)]
    assert tuple(metrics.global_audit(rows).first()) == (4, 1, 3, 2)
    assert tuple(metrics.global_audit(rows.limit(0)).first()) == (0, 0, 0, 0)


def test_plan_prunes_columns(spark, sf_dir):
    from gapwise.operators.metrics import wau_users

    numbered = sessionize(sample_events(spark, sf_dir), event_rule(), None)
    plan = plan_of(wau_users(publishable(with_day(numbered), "r")))
    # Weekly users need no session at all: two columns read, no window left.
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan
    assert "Window" not in plan


def test_plan_days_are_gathered_before_ids(spark, sf_dir):
    rows = sessionize_events(sample_events(spark, sf_dir), "r", gather_days=True)
    plan = plan_of(rows)
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.index("sha2") < plan.index("REBALANCE_PARTITIONS_BY_COL") < plan.index("Window")


def test_session_over_a_week_edge_counts_twice(spark):
    from gapwise.operators import metrics

    # Sunday night and Monday morning in Seoul.
    rows = raw(
        spark, ("2024-01-07 14:58:00 UTC", 1, 1, "a"), ("2024-01-07 15:01:00 UTC", 2, 1, "a")
    )
    weekly = metrics.weekly_engagement(sessionize_events(rows, "r")).collect()
    assert [(str(r[0]), r[1], r[2]) for r in weekly] == [("2024-01-01", 1, 1), ("2024-01-08", 1, 1)]
    complete = metrics.mark_complete_weeks(
        metrics.wau_users(sessionize_events(rows, "r")), "2024-01-01", "2024-01-10"
    )
    assert [r["complete_week"] for r in complete.collect()] == [True, False]


def test_plan_hot_edges_are_broadcast_rows_are_not(spark):
    rows = random_rows(5, 3, 300, 0.5)
    df = spark.createDataFrame(rows, "k string, t timestamp, id int")
    plan = plan_of(sessionize(df, GapRule(("k",), "t", 300, ("id",)), 100))
    assert "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_long_hot_list_is_joined_with_its_keys_spread(spark, monkeypatch):
    rows = random_rows(5, 3, 300, 0.5)
    df = spark.createDataFrame(rows, "k string, t timestamp, id int")
    rule = GapRule(("k",), "t", 300, ("id",))
    whole = sessionize(df, rule, None)
    monkeypatch.setattr(hot, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = sessionize(df, rule, 100)
        plan = plan_of(split)
        joined = [line for line in plan.split("\n") if "Join [" in line and ("LeftSemi" in line or "LeftAnti" in line)]
        assert joined and all("_salt" in line for line in joined)
        assert same(split, whole)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
