"""Days that are outdated by redoing others."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest

from gapwise.sources import ledger

FIELDS = "run_id string, status string, start_date string, end_date string, state_from string, input string, lookback_input string, partitions array<string>, started_at timestamp, completed_at timestamp"
START = date(2024, 1, 1)


def day(n):
    return (START + timedelta(days=n)).isoformat()


def run(run_id, first, end, state_from=None, input=None, lookback=None, status="SUCCESS", order=0):
    done = datetime(2024, 6, 1) + timedelta(minutes=order)
    days = [day(n) for n in range(first, end)]
    return (run_id, status, day(first), day(end), state_from, input or f"/in/{run_id}", lookback, days, done, done)


def book(spark, runs):
    rows = spark.createDataFrame([r for r in runs], FIELDS)
    from pyspark.sql import functions as F

    return rows.withColumn("origins", F.lit(None).cast("map<string,string>"))


def closure(spark, runs, asked):
    days = spark.createDataFrame([(day(n),) for n in asked], "dt string")
    out = ledger.redo_closure(days, book(spark, runs)).collect()
    found = {r.dt: (r.run_id, r.because, r.steps) for r in out}
    assert len(found) == len(out)
    return found


def test_a_chain_a_fork_and_a_reader(spark):
    runs = [
        run("a", 0, 3),
        run("b", 3, 5, "a", order=1),
        run("c", 5, 6, "b", order=2),
        run("fork", 6, 7, "b", order=3),
        run("reader", 7, 8, lookback=" /x, /in/a ", order=4),
        run("after", 8, 9, "reader", order=5),
        run("apart", 9, 10, lookback="/in/b", order=6),
    ]
    got = closure(spark, runs, [1])
    assert got == {
        day(1): ("a", "asked", 0),
        day(2): ("a", "same run", 0),
        day(3): ("b", "state", 1),
        day(4): ("b", "state", 1),
        day(5): ("c", "state", 2),
        day(6): ("fork", "state", 2),
        day(7): ("reader", "lookback", 1),
        day(8): ("after", "state", 2),
    }
    assert closure(spark, runs, [9]) == {day(9): ("apart", "asked", 0)}
    assert closure(spark, runs, [40]) == {} == closure(spark, runs, [])


def test_replaced_runs(spark):
    """Days follow the run that answers for them now; a chain goes through replaced ones."""
    runs = [run("a", 0, 2), run("b", 2, 4, "a", order=1), run("c", 4, 5, "b", order=2), run("b2", 2, 4, order=3)]
    assert closure(spark, runs, [0]) == {
        day(0): ("a", "asked", 0),
        day(1): ("a", "same run", 0),
        day(4): ("c", "state", 2),
    }
    assert closure(spark, runs, [3]) == {day(3): ("b2", "asked", 0)}


def test_failed_runs_do_not_count(spark):
    runs = [run("a", 0, 1), run("b", 1, 2, "a", status="FAILED", order=1), run("c", 2, 3, "b", status="RUNNING", order=2)]
    assert closure(spark, runs, [0, 1]) == {day(0): ("a", "asked", 0)}


def test_an_asked_run_that_is_outdated_as_well(spark):
    """Its days before the asked one are outdated by the state it continued."""
    runs = [run("a", 0, 1), run("b", 1, 4, "a", order=1)]
    assert closure(spark, runs, [0, 2]) == {
        day(0): ("a", "asked", 0),
        day(1): ("b", "state", 1),
        day(2): ("b", "asked", 0),
        day(3): ("b", "same run", 0),
    }


def test_a_ring_ends(spark):
    runs = [run("a", 0, 1, "c"), run("b", 1, 2, "a", order=1), run("c", 2, 3, "b", order=2)]
    assert {k: v[2] for k, v in closure(spark, runs, [0]).items()} == {day(0): 0, day(1): 1, day(2): 2}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_forests(spark, seed):
    """Against walking down from every asked run; chains of up to a hundred runs."""
    rng = random.Random(seed)
    parent = {n: n - 1 if rng.random() < 0.9 else rng.randrange(n) for n in range(1, 150)}
    runs = [run(f"r{n}", n, n + 1, f"r{parent[n]}" if n and rng.random() < 0.97 else None, order=n) for n in range(150)]
    up = {r[0]: r[4] for r in runs}
    asked = rng.sample(range(150), 3)

    def steps(run_id):
        walked = 0
        while run_id is not None:
            if int(run_id[1:]) in asked:
                return walked
            run_id, walked = up[run_id], walked + 1
        return None

    want = {day(n): steps(f"r{n}") for n in range(150) if steps(f"r{n}") is not None}
    assert {k: v[2] for k, v in closure(spark, runs, asked).items()} == want
