"""Documents as tokens, packed best-fit into sequences of one size."""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.llm.tables import ranked
from gapwise.llm.words import giving_back, in_slices
from gapwise.scratch import materialize

CAPACITY = 2048
END_ID = 0

# Characters whose classes are alike in both tokenizer libraries.
_PLAIN = re.compile("[\t\n\r -~¡-ɏ]*")

_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)
_IDS = pa.field("ids", pa.list_(pa.int32()))


@cache
def _encoders(name: str):
    """Ids of a text by the vocabulary ``name``: a fast coder for plain texts, and one for all."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    whole.encode_special_tokens = True
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding(
        name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return plain, whole


def _forget_encoders() -> None:
    _encoders.cache_clear()


def token_ids(text: str | None, vocabulary: str = "byte_bpe_50k") -> np.ndarray:
    """Ids of the whole text without special tokens.

    Both libraries hold one vocabulary and give equal ids; the faster one takes the texts of
    Latin letters only, where their character classes cannot differ.
    """
    plain, whole = _encoders(vocabulary)
    if text and _PLAIN.fullmatch(text):
        return np.array(plain.encode_ordinary(text), np.uint32)
    return np.array(whole.encode(text or "", add_special_tokens=False).ids, np.uint32)


def _pieces(capacity: int, vocabulary: str, with_ids: bool):
    schema = _PIECES.append(_IDS) if with_ids else _PIECES

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in in_slices(batch):
                rows = []
                for doc_id, text in zip(*columns):
                    ids = np.append(token_ids(text, vocabulary), np.uint32(END_ID)).astype("<u4")
                    first = len(ids) % capacity or capacity
                    starts = [0, *range(first, len(ids), capacity)]
                    for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                        row = (doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                        rows.append((*row, ids[a:b]) if with_ids else row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                )

    return giving_back(of, _forget_encoders)


def token_pieces(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str = "byte_bpe_50k",
    with_ids: bool = False,
) -> DataFrame:
    """Documents as token ids closed by id 0, cut where longer than ``capacity``; the first piece
    takes the remainder. A null text is an empty one. ``with_ids`` adds the ids themselves."""
    schema = (
        T.StructType()
        .add("doc_id", "long")
        .add("piece", "integer")
        .add("start", "long")
        .add("length", "long")
        .add("ids_crc32", "long")
    )
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(
        _pieces(capacity, vocabulary, with_ids), schema
    )


def fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit of ``counts`` pieces by length, as runs (length, first rank, count, first sequence,
    offset): the pieces of a length with consecutive ranks go to consecutive sequences.

    One superstep per length, longest first. Its pieces and the open gaps are in order of size, so
    pieces take the smallest gaps that hold them, by rank; each gap takes one piece, is updated,
    and the rest of the pieces go round again. Sequences with equal gaps are kept as one run, so
    the state depends on the capacity, not on the number of documents.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # runs of (first sequence, count) by open space
    sizes: list[int] = []
    found, opened = [], 0

    def leave(size: int, first: int, count: int) -> None:
        if size not in gaps:
            gaps[size] = []
            insort(sizes, size)
        gaps[size].append((first, count))

    for length in sorted(counts, reverse=True):
        rank, rest = 0, counts[length]
        while rest:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                new = -(-rest // (capacity // length))
                leave(capacity, opened, new)
                opened += new
                continue
            size = sizes[at]
            first, count = gaps[size].pop()
            taken = min(rest, count)
            if taken < count:
                gaps[size].append((first + taken, count - taken))
            elif not gaps[size]:
                del gaps[size], sizes[at]
            found.append((length, rank, taken, first, capacity - size))
            leave(size - length, first, taken)
            rank, rest = rank + taken, rest - taken
    return found


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (``doc_id``, ``piece``, ``length`` from 1 to ``capacity``, any other columns)
    with ``sequence_id`` and ``offset``: best-fit by decreasing length.

    Spark counts and ranks the pieces of each length. The driver sees one count per length, at most
    ``capacity`` numbers, and sends back the runs of the match, which every piece looks up by its
    length and rank. A row without identifier or a repeated row is a piece of its own.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    schema = "_length long, _first long, _count long, _sequence long, offset long"
    runs = spark.createDataFrame(fit(counts, capacity), schema)
    inside = (
        (F.col("length") == F.col("_length"))
        & (F.col("_rank") >= F.col("_first"))
        & (F.col("_rank") < F.col("_first") + F.col("_count"))
    )
    return (
        ranked(pieces, ["length"], ["doc_id", "piece"])
        .join(F.broadcast(runs), inside)
        .withColumn("sequence_id", F.col("_sequence") + F.col("_rank") - F.col("_first"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def packed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places in sequences, the digest form of ``pack``."""
    pieces = materialize(token_pieces(docs, key, text, capacity), "pieces")
    return pack(pieces, capacity)
