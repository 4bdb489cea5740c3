"""Continue sessions from a per-key state table instead of re-reading history.

State has one row per key: last event time, and number, start and size of its open session.
New events plus state give exactly what a full recompute would, as long as no new event is older
than its key's last one; such late rows come back marked, for a redo of their days.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapwise.operators import hot as hot_keys
from gapwise.operators.sessions import SESSION_COLUMNS, GapRule, sessionize_by_ranges

# More rows than a session can have; a session number times this still fits 38 digits.
PLACE_BASE = Decimal(10**19)


def session_state(
    sessionized: DataFrame, rule: GapRule, previous: DataFrame | None = None
) -> DataFrame:
    """State after the given rows; keys without new rows keep their previous state.

    Only running maxima per key: combines on the map side, a hot key shuffles one row per task.
    """
    rows = sessionized.select(
        *rule.keys, F.col(rule.time).alias("last_time"), *SESSION_COLUMNS
    ).filter(F.col("last_time").isNotNull())
    if previous is not None:
        rows = previous.select(*rows.columns).unionByName(rows)
    # Within a key, starts grow with time, and rows grow by (session, row in it).  That pair as one
    # number keeps the aggregation hashed; a struct would make every task sort its rows.
    place = F.col("session_seq") * F.lit(PLACE_BASE) + F.col("session_event_seq")
    latest = rows.groupBy(*rule.keys).agg(
        F.max("last_time").alias("last_time"),
        F.max("session_seq").alias("session_seq"),
        F.max("session_start").alias("session_start"),
        F.max(place.cast("decimal(38,0)")).alias("_place"),
    )
    size = (F.col("_place") % F.lit(PLACE_BASE)).cast("long")
    return latest.withColumn("session_event_seq", size).drop("_place")


def sessionize_incremental(
    new_events: DataFrame,
    state: DataFrame,
    rule: GapRule,
    hot_rows: int | None = hot_keys.HOT_ROWS,
) -> DataFrame:
    """Number new events on top of ``state``; adds the session columns and ``is_late``.

    Late rows keep NULL session columns.  A state row enters the key's window as its first row,
    so there is no join: one exchange and one sort of the new events only.
    """
    hot = None if hot_rows is None else hot_keys.find_hot_keys(new_events, rule.keys, hot_rows)
    if hot is None:
        return _continue_in_one_window(new_events, state, rule)
    big, rest = hot_keys.split(new_events, hot)
    big_state, rest_state = hot_keys.split(state, hot)
    return _continue_in_one_window(rest, rest_state, rule).unionByName(
        continue_by_ranges(big, big_state, rule, hot.ranges(hot_rows), few_keys=hot.short)
    )


def _continue_in_one_window(new_events: DataFrame, state: DataFrame, rule: GapRule) -> DataFrame:
    t = F.col(rule.time)
    opening = state.select(
        *rule.keys,
        F.col("last_time").alias(rule.time),
        F.lit(True).alias("_is_state"),
        F.col("session_seq").alias("_seq"),
        F.col("session_start").alias("_start"),
        F.col("session_event_seq").alias("_size"),
    )
    rows = new_events.withColumn("_is_state", F.lit(False)).unionByName(
        opening, allowMissingColumns=True
    )
    w = Window.partitionBy(*rule.keys).orderBy(F.col("_is_state").desc(), *rule.order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    placed = rows.withColumns(
        {
            "_state_time": F.first(F.when(F.col("_is_state"), t), True).over(run),
            "_lag": F.lag(rule.time, 1).over(w),
        }
    ).withColumns(
        {
            "is_late": F.coalesce(~F.col("_is_state") & (t < F.col("_state_time")), F.lit(False)),
            "_previous": F.greatest("_lag", "_state_time"),
        }
    )
    # A state row adds its sessions and the size of the open one; a late row adds nothing.
    opens = F.when(F.col("is_late"), 0).otherwise(rule.opens(F.col("_previous")))
    counted = placed.withColumns(
        {
            "_opens": F.when(F.col("_is_state"), 1).otherwise(opens),
            "_sessions": F.when(F.col("_is_state"), F.col("_seq")).otherwise(opens),
            "_events": F.when(F.col("_is_state"), F.col("_size")).otherwise(
                F.when(F.col("is_late"), 0).otherwise(1)
            ),
            "_start": F.when(F.col("_is_state"), F.col("_start")).otherwise(F.when(opens == 1, t)),
        }
    ).withColumn("_pos", F.sum("_events").over(run))
    numbered = counted.withColumns(
        {
            "session_seq": F.sum("_sessions").over(run),
            "session_start": F.last("_start", True).over(run),
            "_base": F.last(
                F.when(F.col("_opens") == 1, F.col("_pos") - F.col("_events")), True
            ).over(run),
        }
    ).withColumn("session_event_seq", F.col("_pos") - F.col("_base"))
    on_time = [F.when(~F.col("is_late"), F.col(c)).alias(c) for c in SESSION_COLUMNS]
    return numbered.filter(~F.col("_is_state")).select(*new_events.columns, *on_time, "is_late")


def continue_by_ranges(
    new_events: DataFrame,
    state: DataFrame,
    rule: GapRule,
    ranges: int,
    few_keys: bool = False,
) -> DataFrame:
    """Like ``sessionize_incremental`` with the rows cut into ordered ranges, for hot keys.

    A key's state is one more chunk summary in front of its ranges.  ``few_keys`` promises no more
    keys than ``hot.BROADCAST_ROWS`` in ``state``.
    """
    columns = new_events.columns
    t = F.col(rule.time)
    known = state.select(
        *[F.col(k).alias(f"_state_{k}") for k in rule.keys], F.col("last_time").alias("_state_time")
    )
    same = None
    for key in rule.keys:
        one = F.col(key).eqNullSafe(F.col(f"_state_{key}"))
        same = one if same is None else same & one
    late = F.coalesce(t < F.col("_state_time"), F.lit(False))
    if few_keys:
        with_state = new_events.join(F.broadcast(known), same, "left")
    else:
        with_state = hot_keys.spread_join(new_events, known, same, "left")
    marked = with_state.select(*columns, late.alias("is_late"))
    on_time = marked.filter(~F.col("is_late")).select(*columns)
    numbered = sessionize_by_ranges(on_time, rule, ranges, state, few_keys).withColumn(
        "is_late", F.lit(False)
    )
    return numbered.unionByName(marked.filter("is_late"), allowMissingColumns=True)
