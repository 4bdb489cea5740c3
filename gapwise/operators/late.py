"""Late events merged into stored sessions, without redoing days.

A late event extends the session it falls into or next to, joins two sessions it lies between, or
makes one of its own.  Only the rows of such sessions are numbered again.  All other rows of the
same key only need another session number, and rows of other keys nothing at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwise.functions.timeops import gap_in_seconds
from gapwise.operators import hot as hot_keys
from gapwise.operators.sessions import SESSION_COLUMNS, GapRule, sessionize
from gapwise.scratch import materialize

# Length of the time buckets in which late events meet sessions.
BUCKET_SECONDS = 86_400


def merge_late_events(
    stored: DataFrame,
    late: DataFrame,
    rule: GapRule,
    hot_rows: int | None = hot_keys.HOT_ROWS,
) -> DataFrame:
    """``stored`` rows, numbered by ``sessionize``, and ``late`` ones as one numbering of them all.

    ``late`` has the columns of ``stored`` without the session columns.  The result has all rows of
    both and ``is_changed``: late rows, and stored rows whose session start, number or place in the
    session is another one now, so that a caller knows which days to write.

    Both sides must have a time in every row, and ``stored`` all rows of its keys.  Without late rows
    nothing changes.

    What is shuffled grows with the late events and the sessions they touch.  Stored rows are read
    three times: the bounds of the sessions of late keys, the rows of touched sessions, and once to
    pass all rows on, with the number that theirs is moved by joined to them (by broadcast, if that
    table is short, else by a shuffle that spreads the rows of hot keys).  Late events meet sessions in buckets of a day, so a key with a long history
    is many small groups; one row per (key, day) and one per touched or new session are what a
    single task may sort of one key.
    """
    columns = [c for c in stored.columns if c not in SESSION_COLUMNS]
    late = materialize(late.select(*columns), "late")
    known = _named(materialize(late.select(*rule.keys).distinct(), "late-keys"), rule, "_late")
    sessions = materialize(_sessions_of(stored, known, rule, hot_rows), "sessions")
    touched = materialize(_touched(sessions, late, rule), "touched")

    of_touched = _named(touched, rule, "_of").withColumnRenamed("session_seq", "_of_seq")
    same_session = _same(rule, "_of") & (F.col("session_seq") == F.col("_of_seq"))
    again = _short_join(stored, of_touched, same_session, "left_semi", rule, "_of", hot_rows)
    before = [F.col(c).alias(f"_old_{c}") for c in SESSION_COLUMNS]
    rows = again.select(*columns, *before).unionByName(late, allowMissingColumns=True)
    numbered = materialize(sessionize(materialize(rows, "again"), rule, hot_rows), "numbered-again")

    new = numbered.groupBy(*rule.keys, "session_seq").agg(F.min("session_start").alias("_start"))
    new = materialize(new.withColumnRenamed("session_seq", "_nth"), "new-sessions")
    placed = _named(materialize(_new_numbers(sessions, touched, new, rule), "new-numbers"), rule, "_new")
    seq = F.col("_seq")
    changed = F.lit(False)
    for column, now in zip(SESSION_COLUMNS, (seq, F.col("session_start"), F.col("session_event_seq"))):
        changed = changed | ~F.col(f"_old_{column}").eqNullSafe(now)
    same_new = _same(rule, "_new") & (F.col("session_seq") == F.col("_new_nth"))
    renumbered = _short_join(numbered, placed, same_new, "inner", rule, "_new", hot_rows).select(*columns, seq.alias("session_seq"), "session_start", "session_event_seq", changed.alias("is_changed"))

    moves = _named(materialize(_moves(sessions, touched, new, rule), "moves"), rule, "_move")
    day = _bucket(F.col("session_start"))
    start = F.col("session_start")
    here = _same(rule, "_move") & (day == F.col("_day")) & (start >= F.col("_from")) & (
        F.col("_to").isNull() | (start < F.col("_to"))
    )
    passed = _short_join(stored.withColumn("_seq", F.col("session_seq")), moves, here, "left", rule, "_move", hot_rows)
    passed = passed.filter(~F.coalesce("_gone", F.lit(False)))
    moved = F.coalesce("_by", F.lit(0).cast("long"))
    passed = passed.select(
        *columns, (F.col("_seq") + moved).alias("session_seq"), "session_start", "session_event_seq", (moved != 0).alias("is_changed")
    )
    return passed.unionByName(renumbered)


def _named(table: DataFrame, rule: GapRule, prefix: str) -> DataFrame:
    """``table`` with its key columns under other names, to be joined with NULL as a key."""
    for key in rule.keys:
        table = table.withColumnRenamed(key, f"{prefix}_{key}")
    return table


def _same(rule: GapRule, prefix: str) -> Column:
    same = F.lit(True)
    for key in rule.keys:
        same = same & F.col(key).eqNullSafe(F.col(f"{prefix}_{key}"))
    return same


def _is_short(table: DataFrame) -> bool:
    return table.limit(hot_keys.BROADCAST_ROWS + 1).count() <= hot_keys.BROADCAST_ROWS


def _short_join(
    df: DataFrame, table: DataFrame, on: Column, how: str, rule: GapRule, prefix: str, hot_rows: int | None
) -> DataFrame:
    """``df`` stays where it is if ``table``, a written one, is short; else rows of hot keys are spread."""
    if _is_short(table):
        return df.join(F.broadcast(table), on, how)
    hot = hot_keys.find_hot_keys(df, rule.keys, hot_rows or hot_keys.HOT_ROWS)
    return hot_keys.long_join(df, table, on, how, f"{prefix}_", hot)


def _sized(df: DataFrame, written: DataFrame) -> DataFrame:
    """``df``, with no more rows than ``written``, for a join: the size of a file does not tell Spark
    how much a broadcast of its rows takes."""
    return F.broadcast(df) if _is_short(written) else df.hint("merge")


def _bucket(time: Column) -> Column:
    return F.floor(F.unix_timestamp(time) / BUCKET_SECONDS)


def _sessions_of(stored: DataFrame, keys: DataFrame, rule: GapRule, hot_rows: int | None) -> DataFrame:
    """Bounds of the sessions of the late events' keys; combines on the map side."""
    rows = stored.select(*rule.keys, rule.time, "session_seq", "session_start")
    return (
        _short_join(rows, keys, _same(rule, "_late"), "left_semi", rule, "_late", hot_rows)
        .groupBy(*rule.keys, "session_seq")
        .agg(F.min("session_start").alias("_start"), F.max(rule.time).alias("_end"))
    )


def _touched(sessions: DataFrame, late: DataFrame, rule: GapRule) -> DataFrame:
    """Sessions that a late event falls into or is nearer to than the gap."""
    reach = rule.gap_seconds
    # A session lies in every bucket that it or the gap around it reaches into.
    first, last = (
        F.floor((F.unix_timestamp(c) + by) / BUCKET_SECONDS) for c, by in (("_start", -reach), ("_end", reach))
    )
    spans = sessions.withColumn("_bucket", F.explode(F.sequence(first, last)))
    times = late.select(*rule.keys, F.col(rule.time).alias("_at")).distinct()
    times = _named(times, rule, "_late").withColumn("_late_bucket", _bucket(F.col("_at")))
    met = (
        _same(rule, "_late")
        & (F.col("_bucket") == F.col("_late_bucket"))
        & (gap_in_seconds(F.col("_at"), F.col("_start")) < reach)
        & (gap_in_seconds(F.col("_end"), F.col("_at")) < reach)
    )
    return spans.join(_sized(times, late), met, "left_semi").select(*rule.keys, "session_seq", "_start").distinct()


def _steps(touched: DataFrame, new: DataFrame, rule: GapRule) -> DataFrame:
    """Where the numbers of later sessions change, and by how much: (keys, ``_from``, ``_by``).

    A touched session no longer counts, each new one does.
    """
    gone = touched.select(*rule.keys, F.col("_start").alias("_from"), F.lit(-1).cast("long").alias("_step"))
    come = new.select(*rule.keys, F.col("_start").alias("_from"), F.lit(1).cast("long").alias("_step"))
    steps = gone.unionByName(come).groupBy(*rule.keys, "_from").agg(F.sum("_step").alias("_step"))
    so_far = Window.partitionBy(*rule.keys).orderBy("_from")
    return steps.withColumn("_by", F.sum("_step").over(so_far.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "_to", F.lead("_from", 1).over(so_far)
    )


def _moves(sessions: DataFrame, touched: DataFrame, new: DataFrame, rule: GapRule) -> DataFrame:
    """What happens to stored rows by the day of their session's start: the session is gone
    (``_gone``), or its number moves by ``_by``; nothing where there is no row.

    Steps reach from one change to the next, the last one to the key's last day; each is cut into
    the days it covers, so that it is found by equality.
    """
    last = _named(sessions.groupBy(*rule.keys).agg(F.max(_bucket(F.col("_start"))).alias("_last_day")), rule, "_any")
    steps = _steps(touched, new, rule).join(last, _same(rule, "_any"), "left")
    first = _bucket(F.col("_from"))
    end = F.greatest(first, F.coalesce(_bucket(F.col("_to")), F.col("_last_day")))
    spread = steps.select(*rule.keys, F.explode(F.sequence(first, end)).alias("_day"), "_from", "_to", "_by")
    # A touched session has a step at its start; it alone starts there.
    old = _named(touched.select(*rule.keys, F.col("_start").alias("_gone_at")), rule, "_old")
    alone = spread.join(_sized(old, touched), _same(rule, "_old") & (F.col("_from") == F.col("_gone_at")), "left")
    tick = F.expr("INTERVAL 1 MICROSECOND")
    kept = alone.select(
        *rule.keys,
        "_day",
        F.when(F.col("_gone_at").isNotNull(), F.col("_from") + tick).otherwise(F.col("_from")).alias("_from"),
        "_to",
        "_by",
        F.lit(False).alias("_gone"),
    ).filter(F.col("_by") != 0)
    gone = touched.select(
        *rule.keys,
        _bucket(F.col("_start")).alias("_day"),
        F.col("_start").alias("_from"),
        (F.col("_start") + tick).alias("_to"),
        F.lit(0).cast("long").alias("_by"),
        F.lit(True).alias("_gone"),
    )
    return kept.unionByName(gone)


def _new_numbers(sessions: DataFrame, touched: DataFrame, new: DataFrame, rule: GapRule) -> DataFrame:
    """The session number of each new session: stored ones that start before it and are not
    touched, and new ones up to it.

    Stored sessions before it are found in its own day by comparison, in earlier days by the
    highest number of each day.
    """
    start = F.col("_start")
    daily = sessions.groupBy(*rule.keys, _bucket(start).alias("_day")).agg(F.max("session_seq").alias("_top"))
    wanted = new.select(*rule.keys, "_nth", "_start", _bucket(start).alias("_day"))
    earlier = Window.partitionBy(*rule.keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    all_days = daily.unionByName(wanted.select(*rule.keys, "_day").distinct(), allowMissingColumns=True)
    per_day = all_days.groupBy(*rule.keys, "_day").agg(F.max("_top").alias("_top"))
    per_day = _named(per_day.withColumn("_before_day", F.max("_top").over(earlier)), rule, "_any")
    per_day = per_day.withColumnRenamed("_day", "_any_day")
    with_days = wanted.join(per_day, _same(rule, "_any") & (F.col("_day") == F.col("_any_day")))
    that_day = _named(
        sessions.select(*rule.keys, F.col("session_seq").alias("_other"), F.col("_start").alias("_other_start")), rule, "_that"
    ).withColumn("_that_day", _bucket(F.col("_other_start")))
    on_day = _same(rule, "_that") & (F.col("_day") == F.col("_that_day")) & (F.col("_other_start") < start)
    below = with_days.join(_sized(that_day, sessions), on_day, "left").groupBy(*rule.keys, "_nth", "_start").agg(
        F.coalesce(F.max("_other"), F.max("_before_day"), F.lit(0).cast("long")).alias("_below")
    )
    # Touched sessions that start before it no longer count.
    marks = touched.select(*rule.keys, "_start", F.lit(1).alias("_gone")).unionByName(
        below.withColumn("_gone", F.lit(0)), allowMissingColumns=True
    )
    # At one instant the new session comes first: the touched one that starts there is not before it.
    order = Window.partitionBy(*rule.keys).orderBy("_start", "_gone").rowsBetween(Window.unboundedPreceding, 0)
    counted = marks.withColumn("_gone_before", F.sum("_gone").over(order)).filter(F.col("_gone") == 0)
    return counted.select(
        *rule.keys,
        F.col("_nth").alias("_new_nth"),
        (F.col("_below") - F.col("_gone_before") + F.col("_nth")).cast("long").alias("_seq"),
    )
