"""Tokens and packing: round trips and invariants."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gapwise.llm import packing
from gapwise.llm.queries import op10_packing

TEXTS = ["", None, "plain words", "été <|endoftext|> ñ", "漢字 and й \u0085", " x", "a\x0b\x0cb", "😀" * 9]


def encoder():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_ids(text):
    assert packing.token_ids(text).tolist() == encoder()(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x24F, min_codepoint=9), max_size=60))
def test_ids_of_any_latin_text(text):
    assert packing.token_ids(text).tolist() == encoder()(text)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), min_size=1, max_size=40))
@example({22: 17})
def test_fit_is_a_packing(counts):
    fill, placed = defaultdict(int), Counter()
    for length, first, count, sequence, offset in packing.fit(counts, 64):
        assert first == placed[length]
        placed[length] += count
        for k in range(count):
            assert fill[sequence + k] == offset
            fill[sequence + k] += length
    assert placed == Counter(counts)
    assert all(f <= 64 for f in fill.values())
    # About as many sequences as when pieces are put in place one by one: where several of a length go
    # into a new sequence, the pieces are spread over the new ones here, and gaps differ.
    plain = one_by_one(counts, 64)
    assert abs(len(fill) - len(plain)) <= 1 + len(plain) // 50
    # No packing takes fewer than the volume does, or than pieces over half a sequence are; and no
    # two sequences of a best fit would go into one.
    volume = sum(a * b for a, b in counts.items())
    least = max(-(-volume // 64), sum(n for a, n in counts.items() if a > 32))
    assert least <= len(fill) <= max(1, -(-2 * volume // 64))


def one_by_one(counts, capacity):
    """Gaps left when each piece, longest first, goes into the smallest gap that holds it."""
    gaps = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            at = bisect_left(gaps, length)
            gap = gaps.pop(at) if at < len(gaps) else capacity
            insort(gaps, gap - length)
    return gaps


def test_fit_grows_with_lengths_only():
    counts = {length: 1_000_000_007 for length in range(1, 2049)}
    runs = packing.fit(counts, 2048)
    assert len(runs) < 50_000
    opened = max(sequence + count for _, _, count, sequence, _ in runs)
    assert opened <= 1.001 * sum(a * b for a, b in counts.items()) / 2048


def checked(rows, texts, capacity=2048):
    """Rows of ``pack`` hold every id of every text once, in place."""
    ids_of, by_doc, by_sequence = encoder(), defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert sorted(by_doc) == sorted(texts)
    for doc_id, text in texts.items():
        ids = np.array([*ids_of(text), 0], "<u4")
        pieces = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        at = 0
        for k, r in enumerate(pieces):
            assert r["start"] == at
            at += r["length"]
            assert r["length"] == capacity or k == 0
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids) and len(pieces) == -(-len(ids) // capacity)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence), -(-sum(r["length"] for r in rows) // capacity)


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    used, least = checked(op10_packing(spark, sf_dir).collect(), texts)
    assert used <= least * 1.01 + 1


def test_cases(spark):
    texts = {i: t for i, t in enumerate(TEXTS)} | {50: "word " * 30_000, 51: "x" * 5000}
    texts |= {100 + i: "same text" for i in range(300)}
    rows = [(i, t, 1, 2) for i, t in texts.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int, offset int")
    checked(packing.packed_documents(df).collect(), texts)
    checked(packing.packed_documents(df, capacity=64).collect(), texts, 64)
    assert packing.packed_documents(df.limit(0)).collect() == []


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    rows = packing.packed_documents(df).collect()
    assert len(rows) == 3 and {r.sequence_id for r in rows} == {0}
    assert sorted(r.offset for r in rows)[0] == 0 and len({r.offset for r in rows}) == 3


def test_ids_are_kept_on_request(spark):
    df = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    (row,) = packing.token_pieces(df, with_ids=True).collect()
    assert row.ids == [*encoder()("one two three"), 0]


def test_lengths_are_checked(spark):
    df = spark.createDataFrame([(1, 0, 70)], "doc_id long, piece int, length long")
    with pytest.raises(ValueError):
        packing.pack(df, 64)
