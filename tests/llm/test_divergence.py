"""Source divergence against plain counting."""

from __future__ import annotations

import re
import string
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gapwise.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows, min_docs=3, top=200):
    """Sorted result rows of (text, lang, source)."""
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        groups.add((lang or "", source or ""))
        n[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, d in docs[lang].items() if d >= min_docs]

        def p(sources):
            size = sum(n[lang, s][t] for s in sources for t in kept)
            return {t: 1 + 10**9 * (sum(n[lang, s][t] for s in sources) + 1) // (size + len(kept)) for t in kept}

        siblings = [s for g, s in groups if g == lang]
        own, whole = p([source]), p(siblings)
        pairs = []
        for other in siblings:
            if other != source:
                q = p([other])
                pairs.append((sum((own[t] - q[t]) ** 2 // q[t] for t in kept), other))
        terms = [
            ((own[t] - whole[t]) ** 2 // whole[t], t) for t in kept if n[lang, source][t] and own[t] > whole[t]
        ]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda v: (-v[0], v[1].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(found[:most])]
    return sorted(out)


def audit(spark, rows, **options):
    df = spark.createDataFrame([(i, *r, "x", 1) for i, r in enumerate(rows)], SCHEMA)
    return sorted(tuple(r) for r in divergence.source_divergence(df, **options).collect())


def some_rows(n=300, seed=5, sources=6):
    rng = np.random.default_rng(seed)
    words = [f"w{c}{d}" for c in "abcdefgh" for d in "éxyzÉ"] + ["The", "THE", "ß", "日本"]
    weights = rng.dirichlet(np.ones(len(words)) * 0.4, size=sources)
    rows = []
    for _ in range(n):
        s = int(rng.integers(sources))
        rows.append((" ".join(rng.choice(words, size=int(rng.integers(0, 40)), p=weights[s])), f"l{s % 2}", f"s{s}"))
    return rows


def test_terms_are_runs_of_letters():
    text = "Don't STOP_me1now ÄÖ x éE@[`{\x7f\u0080z"
    assert [t.decode() for t in divergence.text_terms(text.encode())] == TERM.findall(text.translate(LOWER))


@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
@settings(max_examples=200, deadline=None)
def test_terms_of_any_text(text):
    assert [t.decode() for t in divergence.text_terms(text.encode())] == TERM.findall(text.translate(LOWER))


def test_equals_plain_counting(spark):
    rows = some_rows()
    assert audit(spark, rows) == brute(rows)


def test_small_blocks_give_the_same(spark):
    rows = some_rows(120)
    assert audit(spark, rows, block_bytes=2_000) == brute(rows)


def test_more_than_two_hundred_terms(spark):
    words = [a + b for a in string.ascii_lowercase for b in string.ascii_lowercase]
    rows = [(" ".join(words), "en", "a")] * 3 + [("zz", "en", "b")]
    got = audit(spark, rows)
    assert got == brute(rows)
    assert sum(r[1] == "a" and r[2] == "term" for r in got) == 200


def test_odd_rows(spark):
    rows = some_rows(60)
    odd = [(None, None, None), ("", None, "a"), ("wax waé", None, None), ("12 34", "l0", "only digits"), (None, "l9", "lonely")]
    rows += odd + odd + [("wax " * 5000 + "y" * 100_000, "l0", None)] * 4
    assert audit(spark, rows) == brute(rows)
    assert audit(spark, []) == []
    assert audit(spark, [("rare words", "en", "a"), ("only here", "en", "b")]) == [
        ("en", "a", "pair", "b", 0, 1),
        ("en", "b", "pair", "a", 0, 1),
    ]


def test_broadcast_is_not_needed(spark, monkeypatch):
    """Group tables beyond the bound are joined by shuffles, with the same result."""
    rows = some_rows(150)
    monkeypatch.setattr(divergence, "broadcast_if_small", lambda df, size: df)
    assert audit(spark, rows) == brute(rows)


def test_runs_are_sorted_and_blocks_bounded():
    texts = [(" ".join(f"t{k}x{'abc'[k % 3]}{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(j, j + 50))) for j in range(0, 500, 50)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en"] * 10), pa.array(["s"] * 10), pa.array([t.encode() for t in texts])], names=["lang", "source", "text"]
    )
    whole = list(divergence._runs(1 << 30)([batch]))
    cut = list(divergence._runs(20_000)([batch]))
    assert len(whole) == 1 and len(cut) > 1
    for run in whole + cut:
        terms = run.column("term").to_pylist()
        assert terms == sorted(terms) and len(set(terms)) == len(terms) and terms[0] == b""
    for name in ("n", "docs"):
        assert sum(sum(r.column(name).to_pylist()) for r in whole) == sum(sum(r.column(name).to_pylist()) for r in cut)


@pytest.mark.parametrize("dense", [0, 1 << 14])
def test_meetings_over_batches(monkeypatch, dense):
    """Sums do not depend on where batches end, within a term or between terms."""
    monkeypatch.setattr(divergence, "_DENSE", dense)
    rng = np.random.default_rng(2)
    rows = [("en", f"t{t:02}".encode(), f"s{s}", int(rng.integers(1, 99)), 1) for t in range(20) for s in range(5) if rng.random() < 0.7]
    names, types = ["lang", "term", "source", "p", "p0"], [pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64()]

    def sums(size):
        batches = [
            pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + size]), types)], names=names)
            for k in range(0, len(rows), size)
        ]
        out = Counter()
        for found in divergence._meetings(iter(batches)):
            for lang, a, b, value in zip(*(c.to_pylist() for c in found.columns)):
                out[a, b] += value
        return out

    assert sums(1) == sums(7) == sums(1000) and len(sums(7)) == 20
