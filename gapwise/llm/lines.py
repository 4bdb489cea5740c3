"""Lines that many sites share."""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.llm.tables import array_bytes, broadcast_if_small, free_name
from gapwise.scratch import materialize

MIN_SITES = 12
MAX_SHARE = 0.5
LG_REGISTERS = 12


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def site_spread(lines: DataFrame, min_sites: int, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """Hashes (``hash``) of the lines on at least ``min_sites`` distinct sites, of rows (hash, site).

    Lines on fewer rows than that are out by their count. The others get a HyperLogLog sketch of
    their sites, merged by the aggregation; where the estimate is near the limit the distinct sites
    are counted. A null site is none.
    """
    often = lines.groupBy("hash").agg(F.count("site").alias("n")).where(F.col("n") >= min_sites)
    often = broadcast_if_small(materialize(often.select("hash"), "often"), 16)
    seen = lines.where("site IS NOT NULL").join(often, "hash", "left_semi")
    spread = materialize(
        seen.groupBy("hash").agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_registers)).alias("sites")
        ),
        "spread",
    )
    margin = max(1.0, 4 * 1.04 / sqrt(1 << lg_registers) * min_sites)
    near = spread.where(F.col("sites").between(min_sites - margin, min_sites + margin))
    counted = (
        seen.join(broadcast_if_small(near.select("hash"), 16), "hash", "left_semi")
        .select("hash", "site")
        .distinct()
        .groupBy("hash")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_sites)
    )
    return spread.where(F.col("sites") > min_sites + margin).select("hash").union(counted.select("hash"))


def remove_boilerplate(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
    max_share: float = MAX_SHARE,
    lg_registers: int = LG_REGISTERS,
) -> DataFrame:
    """``docs`` with the lines that ``min_sites`` sites or more share cut out of ``text``, and with
    ``n_lines`` and ``n_removed``.

    Lines are compared in lower case without white space at the ends. Blank lines stay; a line
    without site counts for none. A document with more than ``max_share`` of its characters in such
    lines is a copy of others rather than a page around boilerplate and stays whole: copies are
    the work of the near-duplicate operators. A null text stays null and has no lines. Clashing
    columns ``n_lines`` and ``n_removed`` get a leading underscore in the result. Rows count as
    one document when identifier and text are equal.
    """
    marked = docs.select(
        F.col(key).alias("id"),
        F.xxhash64(text).alias("print"),
        F.col(site).cast("string").alias("site"),
        F.char_length(text).alias("total"),
        F.posexplode(_lines(F.col(text))).alias("at", "line"),
    )
    bare = F.trim(F.col("line"), F.lit(" \t\r\x0b\x0c"))
    lines = materialize(
        marked.where(F.length(bare) > 0).select(
            "id",
            "print",
            "site",
            "total",
            "at",
            F.xxhash64(F.lower(bare)).alias("hash"),
            F.char_length("line").alias("n"),
        ),
        "lines",
    )
    shared = materialize(site_spread(lines, min_sites, lg_registers), "shared")
    cut, n_lines, n_removed = free_name(docs, "cut", "n_lines", "n_removed")
    gone = (
        lines.join(broadcast_if_small(shared, 16), "hash", "left_semi")
        .groupBy(F.col("id").alias("_id"), F.col("print").alias("_print"))
        .agg(
            F.collect_set("at").alias(cut),
            F.avg("n").alias("_mean"),
            F.max("total").alias("_total"),
        )
        .where(F.col("_mean") * F.size(cut) <= F.col("_total") * max_share)
        .select("_id", "_print", cut)
    )
    gone = broadcast_if_small(materialize(gone, "gone"), array_bytes(cut))
    same = F.col(key).eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_print"))
    # The places that stay, by hash, then their lines: a look through the cut ones for every line
    # would take the square of a long text's lines.
    def kept(every: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(cut))
        return F.transform(places, lambda at: F.get(every, at))

    left = F.get(F.transform(F.array(_lines(F.col(text))), kept), F.lit(0))
    return (
        docs.join(gone, same, "left")
        .withColumn(n_lines, F.when(F.col(text).isNull(), 0).otherwise(F.size(_lines(F.col(text)))).cast("long"))
        .withColumn(n_removed, F.when(F.col(cut).isNull(), 0).otherwise(F.size(cut)).cast("long"))
        .withColumn(text, F.when(F.col(cut).isNull(), F.col(text)).otherwise(F.array_join(left, "\n")))
        .select(*docs.columns, n_lines, n_removed)
    )
