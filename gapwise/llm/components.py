"""Connected components of links that no single machine could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.llm.tables import compact
from gapwise.scratch import materialize

ROUNDS = 60


def _on_lowest(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The links (node, other) with the lowest of the node's neighbourhood, and that per node."""
    lowest = links.groupBy(F.col("node").alias("_node")).agg(F.min("other").alias("low"))
    lowest = lowest.select("_node", F.least("_node", "low").alias("low"))
    return links.join(lowest, F.col("node") == F.col("_node")), lowest


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours move to the lowest of the neighbourhood."""
    both = links.union(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    moved, _ = _on_lowest(both)
    return moved.where("other > node").select(F.col("other").alias("node"), F.col("low").alias("other")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours, and the node itself, move to the lowest of them."""
    moved, lowest = _on_lowest(links)
    moved = moved.select(F.col("other").alias("node"), F.col("low").alias("other"))
    own = lowest.select(F.col("_node").alias("node"), F.col("low").alias("other"))
    return moved.union(own).where("node <> other").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the lowest identifier that links (``a``, ``b``) lead to, for every
    linked node. Self-links and repeated links change nothing.

    Stars: each round hangs every larger neighbour, then every smaller one, on the lowest of its
    neighbourhood, until a round changes nothing. The rows never outnumber the links, rounds grow
    with the logarithm of the longest path, and each round is written to the shared folder.
    """
    links = links.where("a <> b").select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")
    )
    links = materialize(links.distinct(), "links")
    rows = links.count()
    now, before = links, None
    for _ in range(ROUNDS):
        now = materialize(compact(_small_star(_large_star(now)), 2 * rows), "stars")
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("the components did not settle")
    heads = now.select(F.col("other").alias("node"), F.col("other").alias("label")).distinct()
    labels = now.select("node", F.col("other").alias("label")).union(heads)
    return materialize(compact(labels, 2 * rows), "labels")
