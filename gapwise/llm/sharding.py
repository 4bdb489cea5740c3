"""Shards of equal size that keep linked documents together, by balanced label propagation."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwise.llm.tables import broadcast_if_small, ranked
from gapwise.scratch import materialize

SHARDS = 24
ROUNDS = 100  # bound; rounds end when no row moves
SLACK = 1.2


def text_group(text: Column) -> Column:
    """128 bits that stand for a text; null for null."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _capacities(spark, rows: int, shards: int) -> DataFrame:
    """Rows that each shard holds in the end: counts at most one apart."""
    return spark.range(shards).select(
        F.col("id").cast("int").alias("_shard"),
        (F.lit(rows // shards) + (F.col("id") < rows % shards).cast("int")).alias("room"),
    )


def propagate(cells: DataFrame, room: DataFrame, rounds: int = ROUNDS, slack: float = SLACK) -> DataFrame:
    """``cells`` (``grp``, ``shard``, ``n`` rows) after moves towards each group's best shards.

    In a round each group keeps its largest cells, as few as have space for all its rows, and its
    other cells ask to move to those of them with space. A group of more rows than a shard names as
    many shards at once as it needs, and never more of its rows for one than the shard's ``room``.
    Larger gains go first, up to the free rows of the shard; a cell may move in part. Shards may
    exceed their ``room`` by ``slack`` during the rounds, so that full shards can exchange rows.

    Rounds end when no row moves. Rows only go to cells at least as large as their own, so the sum
    of squares of a group's cells grows with every move and the rounds do end; if ``rounds`` of
    them do not suffice, a warning tells so.
    """
    largest = Window.partitionBy("grp").orderBy(F.desc("n"), F.desc("h"), "shard")
    before = largest.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy("grp")
    sum_before = lambda n: F.coalesce(F.sum(n).over(before), F.lit(0))
    for _ in range(rounds):
        used = cells.groupBy(F.col("shard").alias("_at")).agg(F.sum("n").alias("used"))
        free = room.join(used, F.col("_shard") == F.col("_at"), "left").select(
            "_shard", "room", (F.ceil(F.col("room") * slack) - F.coalesce("used", F.lit(0))).alias("free")
        )
        asked = (
            cells.join(F.broadcast(free), F.col("shard") == F.col("_shard"))  # one row per shard
            .withColumn("h", F.xxhash64("grp", "shard"))
            .withColumn("take", F.greatest(F.lit(0), F.least("free", F.col("room") - F.col("n"))))
            .withColumn("leaves", sum_before(F.col("n") + F.col("take")) >= F.sum("n").over(group))
            .withColumn("goes", F.when(F.col("leaves"), F.col("n")).otherwise(0))
            .withColumn("take", F.when(F.col("leaves"), 0).otherwise(F.col("take")))
            .withColumn("first", sum_before(F.col("goes")))
            .withColumn("begin", sum_before(F.col("take")))
        )
        target = F.struct(F.col("shard").alias("to"), "begin", "take", "free", (-F.col("n")).alias("gain"))
        targets = F.collect_list(F.when(F.col("take") > 0, target)).over(group)
        asked = materialize(asked.select("grp", "shard", "n", "goes", "first", targets.alias("targets")), "asked")
        last = F.least(F.col("first") + F.col("goes"), F.col("target.begin") + F.col("target.take"))
        wanted = (
            asked.where("goes > 0")
            .select("grp", "shard", "goes", "first", F.explode("targets").alias("target"))
            .select("grp", "shard", "target.*", (last - F.greatest("first", "target.begin")).alias("want"))
            .where("want > 0")
        )
        moving = ranked(wanted, ["to"], ["gain", "grp", "shard"], "want")
        go = F.least("want", F.col("free") - F.col("_before"))
        moving = materialize(moving.select("grp", "shard", "to", go.alias("go")).where("go > 0"), "moving")
        if moving.isEmpty():
            return cells
        gone = moving.select("grp", F.col("to").alias("shard"), F.col("go").alias("n"))
        left = moving.select("grp", "shard", (-F.col("go")).alias("n"))
        cells = asked.select("grp", "shard", "n").union(gone).union(left)
        cells = materialize(cells.groupBy("grp", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "cells")
    warnings.warn(f"label propagation has not settled after {rounds} rounds", stacklevel=2)
    return cells


def balanced_shards(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, rounds: int = ROUNDS
) -> DataFrame:
    """Every document with ``shard`` and ``slot``; equal texts are links.

    The shards' counts differ by one at most, and slots are gapless from 0. Columns: ``doc_id``,
    ``size`` (UTF-8 bytes and 8), ``text_crc32`` (0 for a null text), ``law``, ``shard``, ``slot``,
    ``grown_shard`` (null, as this law keeps no documents in place when shards are added). A null
    text has no links; each repeated row takes a slot of its own.

    Linked documents are first dealt round-robin, then move by label propagation. The state of the
    rounds has one row per group and shard, as the rows of a group are alike; a group larger than a
    shard fills several. Rounds go on until no row moves; more than ``rounds`` are warned of. What exceeds a shard in the end, the smallest of its groups as a whole, and then the
    documents without links fill the space that is left, the largest spaces first.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text)), F.lit(0)).cast("long").alias("text_crc32"),
        text_group(F.col(text)).alias("content"),
    )
    rows = materialize(rows, "rows")
    room = _capacities(spark, rows.count(), shards)
    groups = rows.where("content IS NOT NULL").groupBy(F.col("content").alias("grp")).count()
    groups = materialize(groups.where("count > 1").select("grp"), "groups")
    marked = materialize(
        rows.join(broadcast_if_small(groups, 40), F.col("content") == F.col("grp"), "left").drop("content"), "marked"
    )
    linked = materialize(ranked(marked.where("grp IS NOT NULL"), [], ["grp", "doc_id"]), "linked")
    cells = linked.groupBy("grp", (F.col("_rank") % shards).cast("int").alias("shard")).agg(F.count("*").alias("n"))
    cells = propagate(materialize(cells, "cells"), room, rounds)
    # Where each cell lies in its shard, and which ranks of its group it takes.
    placed = ranked(cells.withColumn("small", -F.col("n")), ["shard"], ["small", "grp"], "n")
    within = Window.partitionBy("grp").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select(
        F.col("grp").alias("_grp"),
        "shard",
        "n",
        F.col("_before").alias("base"),
        F.coalesce(F.sum("n").over(within), F.lit(0)).alias("from"),
    )
    starts = linked.groupBy(F.col("grp").alias("_start")).agg(F.min("_rank").alias("start"))
    placed = placed.join(starts, F.col("_grp") == F.col("_start")).withColumn("from", F.col("from") + F.col("start"))
    placed = broadcast_if_small(materialize(placed.drop("_start", "start"), "placed"), 64)
    inside = (
        (F.col("grp") == F.col("_grp"))
        & (F.col("_rank") >= F.col("from"))
        & (F.col("_rank") < F.col("from") + F.col("n"))
    )
    dealt = linked.join(placed, inside).withColumn("slot", F.col("base") + F.col("_rank") - F.col("from"))
    dealt = materialize(
        dealt.join(F.broadcast(room), F.col("shard") == F.col("_shard")).select(
            "doc_id",
            "size",
            "text_crc32",
            "grp",
            "shard",
            "slot",
            (F.col("base") + F.col("n") <= F.col("room")).alias("fits"),
        ),
        "dealt",
    )
    columns = ["doc_id", "size", "text_crc32", "grp"]
    pool = dealt.where("NOT fits").select(*columns).union(marked.where("grp IS NULL").select(*columns))
    used = dealt.where("fits").groupBy(F.col("shard").alias("_at")).agg(F.count("*").alias("used"))
    spaces = room.join(used, F.col("_shard") == F.col("_at"), "left").select(
        F.col("_shard").alias("shard"), F.coalesce("used", F.lit(0)).alias("used"), "room"
    )
    order = Window.orderBy(F.desc(F.col("room") - F.col("used")), "shard").rowsBetween(Window.unboundedPreceding, -1)
    spaces = spaces.withColumn("from", F.coalesce(F.sum(F.col("room") - F.col("used")).over(order), F.lit(0)))
    fills = (F.col("_rank") >= F.col("from")) & (F.col("_rank") < F.col("from") + F.col("room") - F.col("used"))
    pool = pool.withColumn("alone", F.col("grp").isNull())
    filled = ranked(pool, [], ["alone", "grp", "doc_id"]).join(F.broadcast(spaces), fills)
    filled = filled.withColumn("slot", F.col("used") + F.col("_rank") - F.col("from"))
    columns = ["doc_id", "size", "text_crc32", "shard", "slot"]
    out = dealt.where("fits").select(*columns).union(filled.select(*columns))
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int"),
        F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
