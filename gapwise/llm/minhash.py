"""Near copies by ProbMinHash signatures, banding and exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.llm.blocks import chunk, dealt, every, lowest_reached, whole_blocks
from gapwise.llm.components import components
from gapwise.llm.tables import broadcast_if_small, compact, free_name, parts, utf8
from gapwise.llm.words import giving_back, in_chunks, joined, mixed, window_hashes, word_hashes
from gapwise.scratch import materialize

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 20, 6
BLOCK = 256  # documents of a bucket that one comparison takes on each side
SLICE = 4096  # shingles that are compared at a time

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPARE = np.uint64(0xD6E8FEB86659FD93)


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """One hash per run of ``words`` words; a shorter text is one shingle, an empty one none."""
    found = word_hashes(text)
    return window_hashes(found, min(words, len(found))) if len(found) else found


def signatures(
    owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, registers: int
) -> np.ndarray:
    """ProbMinHash of ``n`` weighted sets, given as rows (owner, element, weight).

    Each element arrives at random registers as a Poisson process with its weight as rate; a
    register keeps the element that came first, so two sets agree in a register with their
    probability Jaccard. All elements take their first arrival, then those whose next one may still
    be early enough for their set take it, until none may.
    """
    earliest = np.full(n * registers, np.inf)
    first = np.zeros(n * registers, np.uint64)
    time, turn = np.zeros(len(element)), np.zeros(1, np.uint64)
    while len(element):
        turn += _STEP
        draw = mixed(element + turn)
        time = time - np.log((draw >> np.uint64(11)).astype(float) * 2**-53 + 2**-54) / weight
        at = owner * registers + (mixed(draw ^ _SPARE) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(earliest, at, time)
        won = time == earliest[at]
        first[at[won]] = element[won]
        latest = earliest.reshape(n, registers).max(axis=1)
        live = time < latest[owner]
        owner, element, weight, time = owner[live], element[live], weight[live], time[live]
    return first.reshape(n, registers)


def _signed(words: int, bands: int, rows: int):
    """Per document its number of shingles, a hash of their set, and one hash per band."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, texts in in_chunks(batch):
                sets = [np.unique(shingles(t, words)) for t in texts]
                sizes = np.array([len(s) for s in sets])
                full = np.flatnonzero(sizes)
                if not len(full):
                    continue
                owner = np.repeat(np.arange(len(full)), sizes[full])
                element = np.concatenate([sets[i] for i in full])
                # Links are by sets, so a shingle weighs the same however often a text repeats it.
                signed = signatures(owner, element, np.ones(len(element)), len(full), bands * rows)
                keyed = signed.reshape(len(full), bands, rows)
                band = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(full), bands))
                for r in range(rows):
                    band = joined(band, keyed[:, :, r])
                band = mixed(band).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([keys[i] for i in full], pa.int64()),
                        pa.array(sizes[full], pa.int32()),
                        pa.array([hashlib.md5(sets[i].tobytes()).digest() for i in full]),
                        pa.array(list(band), pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n", "set_id", "bands"],
                )

    return giving_back(of)


def _sets(words: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, texts in in_chunks(batch):
                sets = [np.unique(shingles(t, words)).tobytes() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], names=["id", "set"]
                )

    return giving_back(of)


def _verified(threshold: float):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[i] = both >= threshold * (len(x) + len(y) - both)
            yield batch.select([0, 1]).filter(pa.array(good))

    return of


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Elements that each two of the sets have in common."""
    found, column, owners = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    useful = owners[column] > 1
    column, owner = (np.cumsum(owners > 1) - 1)[column[useful]], owner[useful]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, SLICE):
        a, b = np.searchsorted(column, [first, first + SLICE])
        has = np.zeros((len(sets), SLICE), np.float32)
        has[owner[a:b], column[a:b] - first] = 1
        shared += has @ has.T
    return shared


def _compared(threshold: float):
    """Per block the links between documents of different classes, as (a, lowest that a reaches)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in whole_blocks(batches):
            part, ids, kind = (block.column(c).to_numpy() for c in ("part", "id", "class"))
            other = kind[:, None] != kind
            if block.column("i")[0] != block.column("j")[0]:
                other &= part[:, None] != part
            if not other.any():
                continue
            sets = [np.frombuffer(s, np.uint64) for s in block.column("set").to_pylist()]
            sizes = np.array([len(s) for s in sets])
            shared = _shared_counts(sets)
            low = lowest_reached(ids, other & (shared >= threshold * (sizes[:, None] + sizes - shared)))
            if (low < ids).any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[low < ids]), pa.array(low[low < ids])], names=["a", "b"]
                )

    return giving_back(of)


def near_classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Documents that have a near copy: ``doc_id`` and ``class_id``, the smallest identifier that
    links lead to. Two documents are linked when the Jaccard similarity of their sets of shingles
    (``words`` consecutive words) is at least ``threshold``. Documents without near copies have no
    row, nor have those with a null identifier or without words; texts of fewer words than a
    shingle are compared as a whole. Identifiers are unique, but for fully repeated rows.

    Candidates share a band of their ProbMinHash signatures, in which every shingle of a set weighs
    1, so that registers agree with the Jaccard similarity that links are defined by; they are
    verified on whole sets. Equal sets are one class from the start. In each bucket all members are
    compared with its lowest. Where that leaves a bucket with several classes, all its members of
    different classes are compared, those of a full bucket in blocks that many tasks share, so no
    link among candidates is lost.
    """
    given = docs.select(F.col(key).cast("long").alias("doc_id"), utf8(F.col(text)).alias("text")).where(
        "doc_id IS NOT NULL AND text IS NOT NULL"
    )
    signed = materialize(
        given.mapInArrow(
            _signed(words, bands, rows), "doc_id long, n int, set_id binary, bands array<long>"
        ),
        "signed",
    )
    sets = signed.groupBy("set_id").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"))
    sets = materialize(compact(sets, signed.count()), "sets")
    heads = signed.join(sets.select("id"), F.col("doc_id") == F.col("id"), "left_semi")
    banded = heads.select(F.col("doc_id").alias("id"), F.explode("bands").alias("bucket")).distinct()
    shared = (
        banded.groupBy(F.col("bucket").alias("_bucket"))
        .agg(F.min("id").alias("lowest"), F.max("id").alias("highest"))
        .where("lowest < highest")
    )
    members = banded.join(shared, F.col("bucket") == F.col("_bucket")).select("bucket", "id", "lowest")
    members = materialize(compact(members, bands * sets.count()), "members")
    rows_left = members.count()
    wanted = members.select(F.col("id").alias("doc_id")).distinct()
    wanted = materialize(compact(wanted, rows_left), "wanted")
    whole = materialize(
        given.join(broadcast_if_small(wanted, 16), "doc_id", "left_semi")
        .mapInArrow(_sets(words), "id long, set binary")
        .dropDuplicates(["id"]),
        "whole",
    )

    def links(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that hold, compared on their whole sets."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        compared = (
            pairs.join(whole.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
            .join(whole.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
            .select("a", "b", "set_a", "set_b")
        )
        return compared.mapInArrow(_verified(threshold), "a long, b long")

    first = members.where("id <> lowest").select(F.col("id").alias("a"), F.col("lowest").alias("b"))
    labels = components(links(first))
    classed = members.join(labels, F.col("id") == F.col("node"), "left").select(
        "bucket", "id", F.coalesce("label", "id").alias("class")
    )
    classed = materialize(compact(classed, rows_left), "classed")
    split = (
        classed.groupBy(F.col("bucket").alias("_bucket"))
        .agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("n"))
        .where("low < high")
        .select("_bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("chunks"))
    )
    split = materialize(compact(split, rows_left), "split")
    mine, others = F.col("part"), every(F.col("chunks"))
    open_ = (
        classed.join(split, F.col("bucket") == F.col("_bucket"))
        .withColumn("part", chunk("part", "id", F.col("chunks")))
        .withColumn("other", others)
        .select("bucket", F.least(mine, "other").alias("i"), F.greatest(mine, "other").alias("j"), "part", "id", "class")
        .join(whole.select(F.col("id").alias("_id"), "set"), F.col("id") == F.col("_id"))
        .drop("_id")
    )
    more = dealt(open_, "bucket", parts(docs)).mapInArrow(_compared(threshold), "a long, b long")
    labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(more))
    joined_sets = sets.join(labels, F.col("id") == F.col("node"), "left").where("copies > 1 OR label IS NOT NULL")
    joined_sets = joined_sets.select("set_id", F.coalesce("label", "id").alias("class_id"))
    return signed.join(joined_sets, "set_id").select("doc_id", "class_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with ``class_id`` and ``kept``: of each class of near copies the document with the
    smallest identifier is kept, and every document without near copies, which is its own class.

    Rows with a null identifier are kept and have no class; rows with one identifier stay or go
    together. Input columns named ``class_id`` or ``kept`` are replaced.
    """
    docs = docs.drop("class_id", "kept")
    (own,) = free_name(docs, "own")
    classes = near_classes(docs, key, text, **options).distinct()
    classes = materialize(classes.select(F.col("doc_id").alias(own), "class_id"), "classes")
    return (
        docs.join(broadcast_if_small(classes, 16), F.col(key) == F.col(own), "left")
        .withColumn("class_id", F.coalesce("class_id", F.col(key).cast("long")))
        .withColumn("kept", F.col(key).isNull() | (F.col("class_id") == F.col(key)))
        .drop(own)
    )
