"""Passages that repeat across documents, found by windows of doubled length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.llm.tables import array_bytes, broadcast_if_small, utf8
from gapwise.llm.words import in_chunks, in_slices, mixed, window_hashes, word_hashes
from gapwise.scratch import discard, materialize

WINDOW = 50

_PLACE = "doc_id long, hash long, at int"
_PLACES = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64()), ("at", pa.int32())])
# Whole windows are told apart by two hashes: among the windows of 100 TB one of 64 bits would call
# tens of thousands of different ones equal.
_WIDE_PLACE = f"{_PLACE}, more long"
_WIDE_PLACES = _PLACES.append(pa.field("more", pa.int64()))
_OTHER = np.uint64(0x8CB92BA72F3D8DD7)


def _lowest(hashes: np.ndarray, span: int) -> np.ndarray:
    """For every run of ``span`` windows the place of its lowest hash, the last one of equals."""
    view = sliding_window_view(hashes, span)
    return np.arange(len(view)) + (span - 1) - np.argmin(view[:, ::-1], axis=1)


def _anchors(half: int, span: int):
    """Places of the half-length windows that stand for the windows of twice their length.

    Equal windows choose equal half-length windows at equal places within them, so a window can
    only repeat where its chosen half-length window repeats. Every place is judged, but only about
    two of ``span`` are sent on.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, texts in in_chunks(batch):
                ids, found, places = [], [], []
                for key, text in zip(keys, texts):
                    hashes = window_hashes(word_hashes(text), half)
                    if len(hashes) >= span:
                        at = np.unique(_lowest(hashes, span))
                        ids.append(np.full(len(at), key, np.int64))
                        found.append(hashes[at])
                        places.append(at.astype(np.int32))
                if ids:
                    yield _places(ids, found, places)

    return of


def _places(ids: list, found: list, places: list, more: list | None = None) -> pa.RecordBatch:
    columns = [
        pa.array(np.concatenate(ids)),
        pa.array(np.concatenate(found).view(np.int64)),
        pa.array(np.concatenate(places)),
    ]
    if more is None:
        return pa.RecordBatch.from_arrays(columns, schema=_PLACES)
    return pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(more).view(np.int64))], schema=_WIDE_PLACES)


def _doubled(half: int, span: int):
    """Windows of twice the length whose chosen half-length window survived, with two hashes."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in in_slices(batch):
                ids, found, places, more = [], [], [], []
                for key, text, kept in zip(*rows):
                    words = word_hashes(text)
                    halves = window_hashes(words, half)
                    if len(halves) < span:
                        continue
                    live = np.zeros(len(halves), bool)
                    live[[k for k in kept if k < len(halves)]] = True
                    at = np.flatnonzero(live[_lowest(halves, span)])
                    ids.append(np.full(len(at), key, np.int64))
                    found.append(window_hashes(words, 2 * half)[at])
                    more.append(window_hashes(mixed(words ^ _OTHER), 2 * half)[at])
                    places.append(at.astype(np.int32))
                if ids:
                    yield _places(ids, found, places, more)

    return of


def _runs(length: int):
    """Covered words of a document, from the starts of its repeated windows, as start, end, …"""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for starts in batch.column(1).to_pylist():
                at = np.unique(np.array(starts, np.int64))
                cut = np.flatnonzero(np.diff(at) > length)
                first = at[np.concatenate(([0], cut + 1))]
                last = at[np.concatenate((cut, [len(at) - 1]))] + length
                spans.append(np.stack([first, last], axis=1).ravel().tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, pa.list_(pa.int32()))], names=["doc_id", "spans"]
            )

    return of


def _repeated(places: DataFrame, *hashes: str, alike: str | None = None) -> DataFrame:
    """``hashes`` (renamed with a leading underscore) that occur in two documents or more, with the smallest identifier.

    With ``alike`` also ``differs``: whether that column is not the same in all places of a hash.
    Written out, so that a small table can be sent to all tasks and the join to a large one can
    split the places of a hash that very many documents have.
    """
    low, high = F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    differs = [] if alike is None else [(F.min(alike) != F.max(alike)).alias("differs")]
    found = places.groupBy(*[F.col(h).alias(f"_{h}") for h in hashes]).agg(low, high, *differs)
    return materialize(found.where("first_id < last_id").drop("last_id"), "repeated")


def _where(places: DataFrame, repeated: DataFrame, *hashes: str) -> DataFrame:
    found = broadcast_if_small(repeated, 16 + 8 * len(hashes))
    return places.join(found, [F.col(h) == F.col(f"_{h}") for h in hashes])


def _wide_repeated(places: DataFrame) -> DataFrame:
    """Places of windows that repeat, told apart by ``hash`` and ``more`` together.

    Nearly all windows that share the first hash share both, so the second one is not shuffled along
    with the places; where it differs, places are grouped again by both.
    """
    found = _repeated(places, "hash", alike="more")
    columns = ["doc_id", "at", "first_id"]
    plain = _where(places, found.where("NOT differs").drop("differs"), "hash").select(*columns)
    mixed_up = found.where("differs").select("_hash")
    if mixed_up.isEmpty():
        return plain
    unclear = materialize(_where(places, mixed_up, "hash").drop("_hash"), "unclear")
    both = ("hash", "more")
    return plain.unionByName(_where(unclear, _repeated(unclear, *both), *both).select(*columns))


def repeated_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = WINDOW
) -> DataFrame:
    """Words of each document that are covered by a window of ``length`` words which also starts in
    a document with a smaller identifier: ``doc_id`` and ``spans``, an array start, end, start, ….

    Windows are counted at half the length first; only windows around repeated ones are extended
    to twice that and counted again, told apart by 128 bits. Documents without such words have no row; null texts, null
    identifiers and texts of fewer words have none. Repeats within one document do not count.
    Identifiers are unique, but for fully repeated rows, which get the same spans.
    """
    if length % 2 or length < 2:
        raise ValueError("length must be even: windows are doubled once")
    half, span = length // 2, length // 2 + 1
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), utf8(F.col(text)).alias("text")).where(
        "doc_id IS NOT NULL AND text IS NOT NULL"
    )
    anchors = materialize(rows.mapInArrow(_anchors(half, span), _PLACE), "anchors")
    twice = _repeated(anchors, "hash")
    live = (
        _where(anchors, twice, "hash")
        .groupBy("doc_id")
        .agg(F.collect_list("at").alias("kept"))
    )
    live = materialize(live, "candidates")
    discard(anchors)
    discard(twice)
    doubled = (
        rows.join(broadcast_if_small(live, array_bytes("kept")), "doc_id")
        .select("doc_id", "text", "kept")
        .mapInArrow(_doubled(half, span), _WIDE_PLACE)
    )
    doubled = materialize(doubled, "doubled")
    later = (
        _wide_repeated(doubled)
        .where("doc_id > first_id")
        .groupBy("doc_id")
        .agg(F.collect_list("at").alias("starts"))
    )
    return later.mapInArrow(_runs(length), "doc_id long, spans array<int>")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts, spans, ids in in_slices(batch):
            count, gone, kept = [], [], []
            for text, cut in zip(texts, spans):
                words = text.split() if text else []
                rest = words
                if cut:
                    edges = [0, *cut, len(words)]
                    rest = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
                count.append(len(words))
                gone.append(len(words) - len(rest))
                kept.append(b" ".join(rest))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = WINDOW
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed`` and ``kept``, the UTF-8 text of
    the words left by ``repeated_spans``, joined by one space (a null text has no words)."""
    spans = materialize(repeated_spans(docs, key, text, length), "spans")
    return (
        docs.select(F.col(key).cast("long").alias("doc_id"), utf8(F.col(text)).alias("text"))
        .join(broadcast_if_small(spans, array_bytes("spans")), "doc_id", "left")
        .select("text", "spans", "doc_id")
        .mapInArrow(
            _kept,
            T.StructType()
            .add("doc_id", "long")
            .add("n_words", "long")
            .add("n_removed", "long")
            .add("kept", "binary"),
        )
    )
