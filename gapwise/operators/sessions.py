"""Gap sessions for any (key, time) table.

``sessionize`` adds three columns to every input row:

* ``session_seq``        running number of the session within its key, from 1
* ``session_start``      time of the session's first row
* ``session_event_seq``  number of the row within its session, from 1

A row opens a session when its key has no earlier row, or when the whole-second gap to the
previous row is at least the limit.

Normal keys cost one exchange and one sort: all numbers come from running frames over a single
window specification.  A key too big for one task (see ``hot``) is cut into ordered ranges that
are numbered in parallel, written, and stitched at their edges, with the same result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.functions.timeops import gap_in_seconds
from gapwise.operators import hot as hot_keys
from gapwise.scratch import materialize

SESSION_COLUMNS = ("session_seq", "session_start", "session_event_seq")


@dataclass(frozen=True)
class GapRule:
    """Which rows belong together: key columns, time column, gap limit, order among equal times.

    ``ties`` should end with a column that is unique per key, else the numbers of rows that are
    equal in all of them are interchangeable.  Session number, start and id never depend on ties.
    """

    keys: tuple[str, ...]
    time: str
    gap_seconds: int
    ties: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError("at least one key column is needed")
        if self.gap_seconds < 1:
            raise ValueError("the gap must be one second or more")

    @property
    def order(self) -> list[Column]:
        return [F.col(c).asc_nulls_first() for c in (self.time, *self.ties)]

    def opens(self, previous: Column) -> Column:
        """1 when the row starts a session, given the time of the row before it."""
        far = gap_in_seconds(previous, F.col(self.time)) >= F.lit(self.gap_seconds)
        return F.when(previous.isNull() | far, F.lit(1)).otherwise(F.lit(0))


def sessionize(
    df: DataFrame, rule: GapRule, hot_rows: int | None = hot_keys.HOT_ROWS
) -> DataFrame:
    """Number the sessions of ``df``.

    ``hot_rows`` is the most rows of one key that a single task may hold; bigger keys are split.
    Finding them reads the key columns once.  ``None`` skips that pass for input known to be even.
    The input is evaluated more than once, so it must give the same rows each time.
    """
    return _numbered(df, rule, hot_rows).select(*df.columns, *SESSION_COLUMNS)


def mark_boundaries(
    df: DataFrame, rule: GapRule, hot_rows: int | None = hot_keys.HOT_ROWS
) -> DataFrame:
    """Add the previous row's time, the gap to it in whole seconds, and the new-session flag."""
    previous = F.col("previous_time")
    return _numbered(df, rule, hot_rows).select(
        *df.columns,
        previous,
        gap_in_seconds(previous, F.col(rule.time)).alias("gap_seconds"),
        rule.opens(previous).alias("is_new_session"),
    )


def _numbered(df: DataFrame, rule: GapRule, hot_rows: int | None) -> DataFrame:
    hot = None if hot_rows is None else hot_keys.find_hot_keys(df, rule.keys, hot_rows)
    if hot is None:
        return _in_one_window(df, rule)
    big, rest = hot_keys.split(df, hot)
    return _in_one_window(rest, rule).unionByName(
        _by_ranges(big, rule, hot.ranges(hot_rows), few_keys=hot.short)
    )


def _in_one_window(df: DataFrame, rule: GapRule) -> DataFrame:
    w = Window.partitionBy(*rule.keys).orderBy(*rule.order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.col("_opens") == 1
    return (
        df.withColumns({"previous_time": F.lag(rule.time, 1).over(w), "_row": F.row_number().over(w)})
        .withColumn("_opens", rule.opens(F.col("previous_time")))
        .withColumns(
            {
                "session_seq": F.sum("_opens").over(run),
                "session_start": F.last(F.when(opened, F.col(rule.time)), True).over(run),
                "_before": F.last(F.when(opened, F.col("_row") - 1), True).over(run),
            }
        )
        .withColumn("session_event_seq", (F.col("_row") - F.col("_before")).cast("long"))
        .select(*df.columns, "previous_time", *SESSION_COLUMNS)
    )


def sessionize_by_chunk(
    df: DataFrame, rule: GapRule, chunk: Column, hot_rows: int | None = hot_keys.HOT_ROWS
) -> DataFrame:
    """Number sessions with the window split over (key, chunk); same result as ``sessionize``.

    ``chunk`` must grow with the rule's time and give equal times equal values, e.g.
    ``date_trunc('day', t)``.  Every key is split; use it where all keys are long and their events
    are spread over time.  A key with more than ``hot_rows`` rows in one chunk goes by ranges.
    """
    chunked = df.withColumn("_chunk", chunk)
    hot = None
    if hot_rows is not None:
        hot = hot_keys.with_hot_part(chunked, rule.keys, "_chunk", hot_rows)
    if hot is None:
        return _stitch(chunked, rule).select(*df.columns, *SESSION_COLUMNS)
    big, rest = hot_keys.split(chunked, hot)
    by_ranges = _by_ranges(big.drop("_chunk"), rule, hot.ranges(hot_rows), few_keys=hot.short)
    both = _stitch(rest, rule).unionByName(by_ranges)
    return both.select(*df.columns, *SESSION_COLUMNS)


def sessionize_by_ranges(
    df: DataFrame,
    rule: GapRule,
    ranges: int,
    state: DataFrame | None = None,
    few_keys: bool = False,
) -> DataFrame:
    """Number sessions with the rows cut into about equal ranges of the full sort order.

    The cut points come from a sample of the complete order, down to the single row, so neither a
    hot key, a hot instant nor many copies of one row end up in one task.  ``state`` has the open
    sessions to continue (see ``incremental``).  ``few_keys`` promises no more keys than
    ``hot.BROADCAST_ROWS`` in it, which lets a short edge table be broadcast.
    """
    return _by_ranges(df, rule, ranges, state, few_keys).select(*df.columns, *SESSION_COLUMNS)


def _by_ranges(
    df: DataFrame,
    rule: GapRule,
    ranges: int,
    state: DataFrame | None = None,
    few_keys: bool = False,
) -> DataFrame:
    cut = hot_keys.cut_into_ranges(df, rule, ranges)
    # Only keys that reach over the end of a range, or that a state continues, have edges to carry:
    # at most two rows per range, and those of the state.
    small_edges = (few_keys or state is None) and 2 * ranges <= hot_keys.BROADCAST_ROWS
    return _stitch(cut, rule, state, small_edges, written=True)


def _stitch(
    df: DataFrame,
    rule: GapRule,
    state: DataFrame | None = None,
    small_edges: bool = False,
    written: bool = False,
) -> DataFrame:
    """Number rows per (key, ``_chunk``), then carry sessions over the chunk edges.

    The edge table has one row per (key, chunk).  What it carries is joined to the rows, by broadcast
    if it is short (``small_edges``), else where they lie.  With ``written`` the rows are read,
    shuffled and sorted once and written with their numbers inside the chunk, and the edges come from
    the written rows.  Without, a second pass reads keys, times and ties for the edges: that is
    cheaper than writing and reading wide rows, but only for input that is the same each time.
    """
    keyed = _with_part(df, rule)
    part = [c for c in keyed.columns if c.startswith("_part")]
    w = Window.partitionBy(*part).orderBy(*rule.order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t, opened = F.col(rule.time), F.col("_opens") == 1

    positioned = keyed.withColumns(
        {"_previous": F.lag(rule.time, 1).over(w), "_pos": F.row_number().over(w).cast("long")}
    ).withColumn("_opens", rule.opens(F.col("_previous")))
    numbered = positioned.withColumns(
        {
            "_seq": F.sum("_opens").over(run),
            "_start": F.last(F.when(opened, t), True).over(run),
            "_base": F.last(F.when(opened, F.col("_pos") - 1), True).over(run),
        }
    ).drop("_opens")
    local = materialize(numbered, "numbered") if written else numbered
    # Inside a chunk the numbers and starts only grow.
    edges = local.groupBy(*part).agg(
        F.min(t).alias("_first"),
        F.max(t).alias("_last"),
        F.max("_seq").alias("_opened"),
        F.max("_pos").alias("_rows"),
        F.max("_start").alias("_last_start"),
        F.max("_base").alias("_last_base"),
    )
    if state is not None:
        edges = _state_edges(state, rule, keyed).unionByName(edges)
    carried = _carry_over_edges(edges, rule.gap_seconds)
    # Keys with one chunk carry nothing and have no row here.
    joined = local.join(F.broadcast(carried) if small_edges else carried, part, "left")
    merged = F.coalesce("_merged", F.lit(0))
    rows_before = F.coalesce("_rows_before", F.lit(0).cast("long"))
    inherits = (F.col("_seq") == 1) & (merged == 1)
    base = F.when(inherits, F.col("_carry_base")).otherwise(rows_before + F.col("_base"))
    first_of_chunk = F.col("_pos") == 1
    return joined.withColumns(
        {
            "previous_time": F.when(first_of_chunk, F.col("_previous_last")).otherwise(
                F.col("_previous")
            ),
            "session_seq": F.coalesce("_seq_before", F.lit(0).cast("long")) + F.col("_seq") - merged,
            "session_start": F.when(inherits, F.col("_carry_start")).otherwise(F.col("_start")),
            "session_event_seq": rows_before + F.col("_pos") - base,
        }
    ).select(
        *[c for c in df.columns if c != "_chunk"], "previous_time", *SESSION_COLUMNS
    )


def _with_part(df: DataFrame, rule: GapRule) -> DataFrame:
    """Add non-null copies of the keys and the chunk, and flags for the NULLs they replace.

    NULL is a key like any other; with plain equality on these columns the rows stay where the
    windows put them when the edge table is joined, which a null-safe join would not do.
    """
    nulls = sum((F.col(k).isNull().cast("int") * 2**i for i, k in enumerate(rule.keys)), F.lit(0))
    chunk_type = df.schema["_chunk"].dataType
    columns = {
        f"_part_key{i}": F.coalesce(F.col(k), _filler(df.schema[k].dataType))
        for i, k in enumerate(rule.keys)
    }
    columns["_part_nulls"] = nulls
    columns["_part_has_chunk"] = F.col("_chunk").isNotNull()
    columns["_part_chunk"] = F.coalesce(F.col("_chunk"), _filler(chunk_type))
    return df.withColumns(columns).drop("_chunk")


def _filler(kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(kind)
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.lit(0).cast(kind)
    raise TypeError(f"cannot split by a key of type {kind.simpleString()}")


def _state_edges(state: DataFrame, rule: GapRule, keyed: DataFrame) -> DataFrame:
    """An open session kept from earlier input, as the edge of a chunk before all chunks."""
    no_chunk = F.lit(None).cast(keyed.schema["_part_chunk"].dataType)
    seeded = _with_part(state.withColumn("_chunk", no_chunk), rule)
    return seeded.select(
        *[c for c in seeded.columns if c.startswith("_part")],
        F.lit(None).cast(keyed.schema[rule.time].dataType).alias("_first"),
        F.col("last_time").alias("_last"),
        F.col("session_seq").alias("_opened"),
        F.col("session_event_seq").alias("_rows"),
        F.col("session_start").alias("_last_start"),
        F.lit(0).cast("long").alias("_last_base"),
    )


def _carry_over_edges(edges: DataFrame, gap_seconds: int) -> DataFrame:
    """For each chunk: is its first session the previous chunk's last one, and what came before.

    Input has one row per (key, chunk): small, whatever the number of events.  Chunks that are alone
    have nothing before them and are left out.
    """
    part = [c for c in edges.columns if c.startswith("_part")]
    key = [c for c in part if c not in ("_part_has_chunk", "_part_chunk")]
    by_key = Window.partitionBy(*key).orderBy("_part_has_chunk", "_part_chunk")
    so_far = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    near = gap_in_seconds(F.col("_previous_last"), F.col("_first")) < gap_seconds
    # A chunk owns its last session unless that session came in from the chunk before.
    owns = (F.col("_merged") == 0) | (F.col("_opened") > 1)
    added = F.col("_opened") - F.col("_merged")
    return (
        edges.withColumns(
            {
                "_previous_last": F.lag("_last", 1).over(by_key),
                "_rows_before": F.sum("_rows").over(so_far) - F.col("_rows"),
            }
        )
        .withColumn("_merged", F.when(F.coalesce(near, F.lit(False)), 1).otherwise(0))
        .withColumns(
            {
                "_seq_before": F.sum(added).over(so_far) - added,
                "_carry_start": F.last(F.when(owns, F.col("_last_start")), True).over(before),
                "_carry_base": F.last(
                    F.when(owns, F.col("_rows_before") + F.col("_last_base")), True
                ).over(before),
            }
        )
        .filter(F.col("_previous_last").isNotNull() | (F.col("_rows_before") > 0))
        .drop("_first", "_last", "_opened", "_rows", "_last_start", "_last_base")
    )
