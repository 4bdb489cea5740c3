"""Helpers on DataFrames: text columns, checked broadcasts, ranks over many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwise.scratch import materialize

BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, row_bytes: int | Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its rows fit the bound; else it is joined by shuffles.

    ``row_bytes`` is the size of every row, or a column with the size of each.
    """
    if isinstance(row_bytes, int):
        size = row_bytes * df.limit(limit // row_bytes + 1).count()
    else:
        size = df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def array_bytes(name: str) -> Column:
    """Size of a row with a key and an array of integers."""
    return F.lit(32) + F.size(name) * 4


def free_name(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have yet."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def compact(df: DataFrame, rows: int, per_task: int = 200_000) -> DataFrame:
    """``df`` in tasks of about ``per_task`` rows, where at most ``rows`` rows would be spread
    over more: a small step of an iteration then writes few files."""
    return df.coalesce(max(1, min(parts(df), -(-rows // per_task))))


def ranked(df: DataFrame, by: list[str], order: list[str], weight: str | None = None) -> DataFrame:
    """``df`` with ``_rank``, its place (from 0) among the rows of ``by`` in ``order``, and with
    ``weight`` also ``_before``, the sum of the weights of the rows before it.

    Rows are range-partitioned, so rows of one ``by`` may lie in many tasks; counts per (task, by)
    carry the ranks over. Rows equal in all of ``by`` and ``order`` get any order among themselves.
    """
    placed = (
        df.repartitionByRange(parts(df), *by, *order)
        .sortWithinPartitions(*by, *order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.spark_partition_id())
    )
    placed = materialize(placed, "ranked")
    totals = placed.groupBy(*by, "_part").agg(
        F.count("*").alias("_n"),
        F.min("_at").alias("_from"),
        *([F.sum(weight).alias("_w")] if weight else []),
    )
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = totals.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col("_part").alias("_in"),
        "_from",
        F.coalesce(F.sum("_n").over(earlier), zero).alias("_n_before"),
        *([F.coalesce(F.sum("_w").over(earlier), zero).alias("_w_before")] if weight else []),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    out = placed.join(starts, [F.col("_part") == F.col("_in"), *same])
    out = out.withColumn("_rank", F.col("_at") - F.col("_from") + F.col("_n_before"))
    if weight:
        within = Window.partitionBy("_part", *by).orderBy("_at")
        out = out.withColumn(
            "_before", F.sum(weight).over(within) - F.col(weight) + F.col("_w_before")
        )
    return out.select(*df.columns, "_rank", *(["_before"] if weight else []))


def utf8(text: Column) -> Column:
    return text.cast("binary")
