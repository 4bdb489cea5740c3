"""The pipeline's stages on documents whose fate is known, and its whole result."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gapwise.llm import packing
from gapwise.scratch import materialize

from . import brute
from .test_packing import encoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Name and result of every stage over the test documents."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        found.append((name, docs := materialize(stage(spark, docs, FOLDER), name)))
    return found


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_columns(stages):
    assert all(df.dtypes == stages[0][1].dtypes for _, df in stages[1:-1])


def test_language_id_keeps_clean_documents(stages):
    (_, before), (_, after) = stages[0], stages[1]
    kept = {r["doc_id"] for r in rows(after)}
    lost = [r for r in rows(before) if r["doc_id"] not in kept]
    assert all(not any(c.isalpha() for c in r["text"] or "") for r in lost)


def test_line_dedup_cuts_only_shared_lines(stages):
    before, after = (rows(df) for _, df in stages[1:3])
    sites = {}
    for r in before:
        for line in (r["text"] or "").split("\n"):
            sites.setdefault(line.strip(" \t\r\x0b\x0c").lower(), set()).add(r["source"])
    old = {r["doc_id"]: r for r in before}
    assert sorted(old) == sorted(r["doc_id"] for r in after)
    changed = 0
    for r in after:
        text, was = r["text"], old[r["doc_id"]]["text"]
        left = [x for x in was.split("\n") if not x.strip() or len(sites[x.strip(" \t\r\x0b\x0c").lower()]) < 12]
        cut = len(was.replace("\n", "")) - sum(map(len, left))
        assert text == ("\n".join(left) if cut <= len(was) / 2 else was)
        assert r["n_chars"] == len(text)
        changed += text != was
    assert changed > 100


def test_near_dedup_keeps_one_of_each_class(stages):
    before, after = (rows(df) for _, df in stages[2:4])
    texts = [(r["doc_id"], r["text"]) for r in before]
    want = set(brute.classes([i for i, _ in texts], brute.near_links(texts)).values())
    assert sorted(r["doc_id"] for r in after) == sorted(want)


def test_mix_repeats_whole_documents(stages):
    before, after = (rows(df) for _, df in stages[3:5])
    old, times = {r["doc_id"]: r for r in before}, Counter(r["doc_id"] for r in after)
    assert all(r == old[r["doc_id"]] for r in after)
    assert max(times.values()) <= 2
    words = {i: len(brute.WORD.findall(r["text"])) for i, r in old.items()}
    taken = sum(words[r["doc_id"]] for r in after)
    assert taken == pytest.approx(1.5 * sum(words.values()), rel=0.02)


def test_packing_holds_every_token(stages):
    ids, docs, pieces = encoder(), rows(stages[4][1]), rows(stages[5][1])
    want = Counter()
    for r in docs:
        n = len(ids(r["text"])) + 1
        starts = [0, *range(n % packing.CAPACITY or packing.CAPACITY, n, packing.CAPACITY)]
        want.update((r["doc_id"], a, b - a) for a, b in zip(starts, [*starts[1:], n]))
    assert Counter((r["doc_id"], r["start"], r["length"]) for r in pieces) == want
    fill = Counter()
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill[r["sequence_id"]]
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= packing.CAPACITY
    assert len(fill) <= sum(fill.values()) / packing.CAPACITY * 1.01 + 1


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER)
    columns = [c for c in got.columns if c != "sequence_id"]
    assert Counter(got.select(*columns).drop("offset").collect()) == Counter(
        stages[-1][1].select(*columns).drop("offset").collect()
    )


def test_odd_documents(spark, tmp_path):
    """Nulls everywhere, empty and long texts, repeated rows, no rows at all."""
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    odd = [
        (1, "the first text of all", "en", "a", 21),
        (1, "the first text of all", "en", "a", 21),
        (2, None, None, None, None),
        (3, "", "en", "b", 0),
        (None, "a text without number", None, None, 5),
        (5, "word " * 100_000, "en", "a", 500_000),
        (6, "12 34", "en", "c", 5),
    ]
    for given in (odd, []):
        docs = spark.createDataFrame(given, SCHEMA)
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, str(tmp_path)), name)
        left = {r.doc_id for r in docs.collect()}
        assert left <= {1, None, 5}
    clean = spark.createDataFrame(odd, SCHEMA)
    kept = corpus_pipeline.language_id(spark, clean, str(tmp_path))
    assert kept.select(F.count("*")).first()[0] == 4
