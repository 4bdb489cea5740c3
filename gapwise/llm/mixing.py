"""Sources mixed to target weights by weighted sampling without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwise.llm.tables import broadcast_if_small, free_name
from gapwise.llm.words import WORD
from gapwise.scratch import materialize

RATES = (3, 1, 2)
SHARE = 1.5
CAP = 2
BUCKET_ROWS = 10_000


def _row_bytes(source: str) -> Column:
    """Size of a row of a source with its name and a few numbers."""
    return F.lit(80) + F.coalesce(F.octet_length(F.col(source).cast("string")), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sampling_key(key: Column, weight: Column) -> Column:
    """An exponential variable with rate ``weight``, drawn from the identifier: sorted upwards, the
    rows come in the order of weighted sampling without replacement. Weights are above 0."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 13)
    drawn = F.conv(digits, 16, 10).cast("double")
    return -F.ln((drawn + 0.5) / F.lit(float(1 << 52))) / weight


def targets(sizes: DataFrame, rates: tuple = RATES, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``sizes`` (``source``, ``source_size``), one row per source, with its ``target``.

    The sources' weights repeat ``rates`` in code point order, null last. All targets together are
    ``share`` times all sizes; none is above ``cap`` times its source's size. Sources in order of
    the level at which they reach their cap: the first ones are capped, the others share by weight
    what those leave over. One row per source passes through one window.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rate = F.element_at(F.array(*[F.lit(r) for r in rates]), (place % len(rates) + 1).cast("int"))
    caps = sizes.withColumn("_rate", rate.cast("long")).withColumn("_cap", F.col("source_size") * cap)
    order = Window.orderBy(F.col("_cap") / F.col("_rate"), F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(0, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # The level if all earlier sources are capped; the first that stays below its cap is the level.
    left = F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("_cap").over(earlier), F.lit(0))
    levels = caps.withColumn("_level", left / F.sum("_rate").over(later))
    fits = F.when(F.col("_level") * F.col("_rate") <= F.col("_cap"), F.col("_level"))
    levels = levels.withColumn("_level", F.first(fits, ignorenulls=True).over(every))
    cap_ = F.col("_cap").cast("double")
    shared = F.least(F.coalesce(F.col("_level") * F.col("_rate"), cap_), cap_)
    return levels.select("source", "source_size", shared.alias("target"))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    size: str = "size",
    weight: str | None = None,
    rates: tuple = RATES,
    share: float = SHARE,
    cap: int = CAP,
) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``copies``, the times the mix takes each row.

    A source's target holds complete epochs of all its rows first. The rest is filled by weighted
    sampling without replacement (``weight``, above 0, the same for all if not given): rows in the
    order of their exponential keys, up to the row that brings the sum nearest to the target. Rows
    with one identifier and weight, such as repeated rows, are sampled together. A null size
    counts as 0, a null or not positive weight as the smallest double. Input columns named
    ``source_size``, ``target`` or ``copies`` are replaced.

    Sums over key ranges find the range where each source's budget ends, and only the rows of that
    range are sorted; every row then compares its key with its source's last one.
    """
    docs = docs.drop("source_size", "target", "copies")
    drawn, origin, epochs, last = free_name(docs, "drawn", "origin", "epochs", "last")
    counted = F.coalesce(F.col(size), F.lit(0)).cast("long")
    rate = F.col(weight).cast("double") if weight else F.lit(1.0)
    rate = F.when(rate > 0, rate).otherwise(F.lit(5e-324))
    keyed = docs.withColumn(drawn, F.struct(sampling_key(F.col(key), rate).alias("draw"), F.col(key).alias("id")))
    rows = keyed.select(F.col(source).alias("source"), counted.alias("n"), F.col(drawn).alias("drawn"))
    rows = materialize(rows, "drawn")
    totals = rows.groupBy("source").agg(
        F.sum("n").alias("source_size"), F.count("*").alias("rows"), F.percentile_approx("drawn.draw", 0.5).alias("middle")
    )
    plan = targets(totals.select("source", "source_size"), rates, share, cap).join(
        totals.select(F.col("source").alias("_of"), "rows", "middle"), F.col("source").eqNullSafe(F.col("_of"))
    )
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("epochs", full.cast("long"))
    plan = materialize(
        plan.select(
            F.col("source").alias("_source"),
            "source_size",
            "target",
            "epochs",
            (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest"),
            F.ceil(F.col("rows") / BUCKET_ROWS).alias("buckets"),
            "middle",
        ),
        "plan",
    )
    # Keys lie about evenly between 0 and 1 when they are measured by their source's middle one,
    # whatever the weights are measured in.
    at = F.floor((1 - F.pow(F.lit(0.5), F.col("drawn.draw") / F.col("middle"))) * F.col("buckets"))
    dealt = rows.join(
        broadcast_if_small(plan.select("_source", "rest", "buckets", "middle"), _row_bytes("_source")), F.col("source").eqNullSafe(F.col("_source"))
    ).withColumn("bucket", F.least(at, F.col("buckets") - 1))
    sums = dealt.groupBy("_source", "rest", "bucket").agg(F.sum("n").alias("n"))
    running = Window.partitionBy("_source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0)))
    # The first range that the budget does not pass; all earlier rows are taken.
    ends = sums.where(F.col("before") + F.col("n") >= F.col("rest")).groupBy(
        F.col("_source").alias("_end"), F.col("rest").alias("_rest")
    )
    ends = materialize(ends.agg(F.min_by(F.struct("bucket", "before"), "bucket").alias("end")), "ends")
    within = Window.partitionBy("source", "bucket").orderBy("drawn")
    reach = F.col("end.before") + F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n") / 2
    tail = (
        dealt.join(
            broadcast_if_small(ends, _row_bytes("_end")),
            F.col("source").eqNullSafe(F.col("_end")) & (F.col("bucket") == F.col("end.bucket")),
        )
        .withColumn("reach", reach)
        .where(F.col("reach") <= F.col("_rest"))
        .groupBy(F.col("source").alias("_end"))
        .agg(F.max("drawn").alias("tail"))
    )
    # Without a row of that range, the last of the ranges before it.
    head = (
        dealt.join(
            broadcast_if_small(ends, _row_bytes("_end")),
            F.col("source").eqNullSafe(F.col("_end")) & (F.col("bucket") < F.col("end.bucket")),
        )
        .groupBy(F.col("source").alias("_end"))
        .agg(F.max("drawn").alias("tail"))
    )
    cuts = tail.union(head).groupBy("_end").agg(F.max("tail").alias("tail"))
    plan = plan.join(cuts, F.col("_source").eqNullSafe(F.col("_end")), "left").select(
        F.col("_source").alias(origin), "source_size", "target", F.col("epochs").alias(epochs), F.col("tail").alias(last)
    )
    plan = materialize(plan, "cuts")
    copies = F.col(epochs) + F.coalesce((F.col(drawn) <= F.col(last)).cast("long"), F.lit(0))
    # Rows of size 0 fit into a budget of nothing, too.
    copies = F.least(copies, F.lit(cap).cast("long"))
    return (
        keyed.join(broadcast_if_small(plan, _row_bytes(origin)), F.col(source).eqNullSafe(F.col(origin)))
        .withColumn("copies", copies)
        .drop(drawn, origin, epochs, last)
    )


def quality_weight(quality: Column) -> Column:
    """Labelled good documents are four times as likely as bad ones, unlabelled ones in between."""
    return F.when(quality == 1, 2.0).when(quality == 0, 0.5).otherwise(1.0)


def with_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with ``weight`` from their best quality label, of any number of labels."""
    docs = docs.drop("weight")
    labelled, quality = free_name(docs, "labelled", "quality")
    best = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(labelled)).agg(F.max("quality").alias(quality))
    best = broadcast_if_small(materialize(best, "quality"), 12)
    out = docs.join(best, F.col(key) == F.col(labelled), "left")
    return out.withColumn("weight", quality_weight(F.col(quality))).drop(labelled, quality)
