"""Exact copies by sorting contents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.llm.tables import parts, utf8
from gapwise.llm.words import WHITE_SPACE, in_slices
from gapwise.scratch import materialize

LEADING = 48  # characters of the content that splitters hold

_RUNS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_sha256", T.StringType()),
        T.StructField("keep_id", T.LongType()),
        T.StructField("group_size", T.LongType()),
        T.StructField("n_points", T.LongType()),
        T.StructField("head", T.BooleanType()),
        T.StructField("edge", T.BooleanType()),
    ]
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_sha256", pa.string()),
        ("keep_id", pa.int64()),
        ("group_size", pa.int64()),
        ("n_points", pa.int64()),
        ("head", pa.bool_()),
        ("edge", pa.bool_()),
    ]
)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each content of a sorted partition with the one before it; one row per document.

    A run's identifiers are held until it ends; a partition bounds them, as equal contents are
    also cut by identifier. The first and the last run may go on in a neighbouring partition.
    """
    content, ids, points, first = None, [], 0, True
    done: list[tuple] = []

    def close(edge: bool) -> None:
        n, sha = len(ids), hashlib.sha256(content).hexdigest()
        done.extend((i, sha, ids[0], n, points, k == 0, edge) for k, i in enumerate(ids))

    def closed() -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*done), _ARROW)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    for batch in batches:
        for rows in in_slices(batch):
            for doc_id, n_points, text in zip(*rows):
                if content is not None and text == content:
                    ids.append(doc_id)
                    continue
                if content is not None:
                    close(edge=first)
                    first = False
                content, ids, points = text, [doc_id], n_points
        if done:
            yield closed()
    if content is not None:
        close(edge=True)
        yield closed()


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with the copy that stays of its group of equal contents.

    Contents are equal when identical without white space; a null text counts as empty, and all
    empty texts are one group. The row with the most code points stays, then the smallest
    identifier; of fully repeated rows one is ``kept``. A null identifier sorts first. Other
    columns of ``docs`` are ignored.

    Rows are range-partitioned and sorted by content; sampled splitters hold the leading characters
    and a hash, so that the driver's sample stays small. Equal contents come next to each other and
    are compared in full. The identifier is part of the order, so a group may fill many partitions;
    its pieces meet through one row per partition edge.
    """
    given = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = given.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_points"),
        F.translate("text", WHITE_SPACE, "").alias("content"),
    )
    order = [
        F.substring("content", 1, LEADING),
        F.xxhash64("content"),
        F.col("n_points").desc(),
        F.col("doc_id"),
    ]
    placed = (
        rows.repartitionByRange(parts(docs), *order)
        .sortWithinPartitions(*order[:2], "content", *order[2:])
        .select("doc_id", "n_points", utf8(F.col("content")).alias("content"))
    )
    runs = materialize(placed.mapInArrow(_runs, _RUNS), "runs")
    # At most two rows per partition.
    edges = (
        runs.where("edge AND head")
        .groupBy(F.col("text_sha256").alias("sha"))
        .agg(
            F.sum("group_size").alias("whole_size"),
            F.min(F.struct((-F.col("n_points")).alias("n"), F.col("doc_id"))).alias("best"),
            F.count("*").alias("pieces"),
        )
        .where("pieces > 1")
    )
    out = runs.join(F.broadcast(edges), F.col("edge") & (F.col("text_sha256") == F.col("sha")), "left")
    keep = F.when(F.col("sha").isNotNull(), F.col("best.doc_id")).otherwise(F.col("keep_id"))
    stays = F.col("head") & (
        F.col("sha").isNull()
        | (F.col("best.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("best.n") == -F.col("n_points")))
    )
    return out.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("whole_size", "group_size").alias("group_size"),
        stays.alias("kept"),
        "text_sha256",
    )


