"""Keys that hold more rows than one task should sort: find them, cut them into ranges."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from math import ceil
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.scratch import materialize

if TYPE_CHECKING:
    from gapwise.operators.sessions import GapRule

# Most rows of one key that one task sorts; about half a gigabyte of wide event rows.
HOT_ROWS = 2_000_000
# Rows that a key at the limit has in the sample of keys: a size is off by a few percent at most.
SAMPLED_ROWS = 2_000
# Key lists and range summaries up to this many rows are broadcast, longer ones are joined.
BROADCAST_ROWS = 100_000
# Tasks that the rows of one key are spread over where such a longer list is joined.
SALTS = 64


@dataclass(frozen=True)
class HotKeys:
    """Keys over the limit (columns ``_hot_<key>``) and about how many rows they have together."""

    keys: tuple[str, ...]
    table: DataFrame
    rows: int
    short: bool

    def ranges(self, hot_rows: int) -> int:
        # Two ranges more than the rows need, so that a sampled cut stays below the limit.
        return ceil(self.rows / hot_rows) + 2


def find_hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> HotKeys | None:
    """Keys with about more than ``hot_rows`` rows, or None.

    Reads only the key columns.  Key sizes are taken from a sample in which a key at the limit still
    has SAMPLED_ROWS rows, so one well over it is practically never missed, and little is shuffled.
    Only the way a key is computed rests on this, not one row of the result.  There are
    about rows / ``hot_rows`` such keys; a short list comes to the driver and is broadcast, a longer
    one stays a table and is joined with the rows of each key spread over many tasks.
    """
    fraction = min(1.0, SAMPLED_ROWS / hot_rows)
    seen = df.select(*keys)
    if fraction < 1.0:
        seen = seen.sample(fraction, seed=1)
    counts = seen.groupBy(*keys).agg(F.count("*").alias("_n"))
    counts = counts.filter(F.col("_n") > hot_rows * fraction)
    listed = counts.limit(BROADCAST_ROWS + 1).collect()
    if not listed:
        return None
    short = len(listed) <= BROADCAST_ROWS
    if short:
        counts = df.sparkSession.createDataFrame(listed, counts.schema)
        rows = sum(row["_n"] for row in listed)
    else:
        counts = materialize(counts, "hot-keys")
        rows = counts.agg(F.sum("_n")).first()[0]
    table = counts.select([F.col(k).alias(f"_hot_{k}") for k in keys])
    if short:
        table = F.broadcast(table)
    return HotKeys(tuple(keys), table, ceil(rows / fraction), short)


def with_hot_part(df: DataFrame, keys: Sequence[str], part: str, hot_rows: int) -> HotKeys | None:
    """Keys that have more than ``hot_rows`` rows within one value of the column ``part``."""
    parts = find_hot_keys(df, (*keys, part), hot_rows)
    if parts is None:
        return None
    table = parts.table.select([f"_hot_{k}" for k in keys]).distinct()
    hot = HotKeys(tuple(keys), F.broadcast(table) if parts.short else table, 0, parts.short)
    return replace(hot, rows=split(df, hot)[0].count())


def split(df: DataFrame, hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """Rows of hot keys, and all other rows.  NULL keys compare as equal."""
    same = None
    for key in hot.keys:
        one = F.col(key).eqNullSafe(F.col(f"_hot_{key}"))
        same = one if same is None else same & one
    if hot.short:
        return df.join(hot.table, same, "left_semi"), df.join(hot.table, same, "left_anti")
    return spread_join(df, hot.table, same, "left_semi"), spread_join(df, hot.table, same, "left_anti")


def spread_join(df: DataFrame, table: DataFrame, same: Column, how: str) -> DataFrame:
    """Join of ``df`` to ``table``, which has one row per key, with each key's rows in many tasks."""
    salted = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    copies = table.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return _salted_join(salted, copies, same, how)


def _salted_join(salted: DataFrame, copies: DataFrame, same: Column, how: str) -> DataFrame:
    # Spark takes the copies for as small as the file they are made from, and would broadcast them.
    both = same & (F.col("_salt") == F.col("_copy"))
    return salted.join(copies.hint("merge"), both, how).drop("_salt", "_copy")


def long_join(df: DataFrame, table: DataFrame, same: Column, how: str, named: str, hot: HotKeys | None) -> DataFrame:
    """Join of ``df`` to a ``table`` too long to broadcast, whose key columns begin with ``named``.

    Only the rows of ``hot`` keys of ``df`` are spread over tasks, so only rows of these are copied;
    all others meet by a plain shuffle.
    """
    if hot is None:
        return df.join(table.hint("merge"), same, how)
    if not hot.short:
        return spread_join(df, table, same, how)
    columns = [f"_hot_{k}" for k in hot.keys]
    listed = F.broadcast(hot.table.withColumn("_is_hot", F.lit(True)))

    def marked(side: DataFrame, prefix: str) -> DataFrame:
        on = F.lit(True)
        for key, column in zip(hot.keys, columns):
            on = on & F.col(f"{prefix}{key}").eqNullSafe(F.col(column))
        return side.join(listed, on, "left").drop(*columns)

    is_hot = F.coalesce("_is_hot", F.lit(False))
    salt = F.when(is_hot, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).otherwise(0)
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted = marked(df, "").withColumn("_salt", salt).drop("_is_hot")
    copies = marked(table, named).withColumn("_copy", F.explode(every)).drop("_is_hot")
    return _salted_join(salted, copies, same, how)


def cut_into_ranges(df: DataFrame, rule: GapRule, ranges: int) -> DataFrame:
    """Place the rows into ordered ranges (``_chunk``) of about equal size.

    The range order ends with a number of the row, so even equal rows can be cut apart.  The
    numbered rows are written out first: a task that is run again after a loss reads the same
    numbers, and sampling the cut points does not scan the whole source again.  The cut points are
    sampled anew whenever the plan runs again, so the result is to be evaluated in one job only.
    """
    numbered = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "hot-rows")
    order = [F.col(c).asc_nulls_first() for c in (*rule.keys, rule.time, *rule.ties, "_row")]
    placed = numbered.repartitionByRange(ranges, *order)
    return placed.withColumn("_chunk", F.spark_partition_id()).drop("_row")
