"""Quality: held-out accuracy, the ranking by hand, odd texts."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapwise.llm import quality
from gapwise.llm.queries import op12_quality_classifier

DOCS = "doc_id long, text string, lang string, quality int, score double, held_out int"
GOOD = "Plain words make a sentence. Another one follows, with other words in it."
BAD = "WORDS!! ARE!! SHOUTED!! HERE!! $$$ %%% &&&"


def tables(spark, rows):
    """Documents and labels of (doc_id, text, label); a label None has no row."""
    docs = spark.createDataFrame([(i, t, "en", 1, 0.5, 1) for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows if q is not None], "doc_id long, quality int, toxic int")
    return docs, labels


def scores(spark, docs, labels):
    out = quality.classified(docs, quality.fit(docs, labels))
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    return {r.doc_id: (r.score, r.predicted) for r in out.collect()}


def test_query_is_accurate_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    out = op12_quality_classifier(spark, folder).collect()
    assert sorted(r.doc_id for r in out) == list(range(len(out)))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    held = [(r.score, r.predicted, label[r.doc_id]) for r in out if r.held_out and r.doc_id in label]
    good, bad = ([s for s, _, q in held if q == n] for n in (1, 0))
    assert len(good) > 500 and len(bad) > 80
    assert np.mean([a > b for a in good for b in bad]) > 0.995
    assert np.mean([p == q for _, p, q in held]) > 0.985


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows = [(i, f"{GOOD} {i}" if i % 2 else f"{BAD} {i}", i % 2) for i in range(200)]
    docs, labels = tables(spark, rows)
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert scores(spark, docs, labels) == scores(spark, docs, turned)


def test_odd_texts_and_rows(spark):
    rows = [(i, f"{GOOD} {i}" if i % 2 else f"{BAD} {i}", i % 2) for i in range(100)]
    odd = [(200, None, 1), (201, "", 0), (202, " \n\t ", 1), (203, "é", None), (204, GOOD * 20_000, None), (None, BAD, 0)]
    docs, labels = tables(spark, rows + odd + rows[:4] + [(3, GOOD, 0)])
    labels = labels.union(spark.createDataFrame([(5, None, 1), (None, 1, 1)], labels.schema))
    out = quality.classified(docs, quality.fit(docs, labels)).collect()
    assert len(out) == docs.count()
    assert all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in out if r.doc_id in (200, 201, 202)} == {out[-1].score for out in [[r for r in out if r.doc_id == 200]]}
    assert [r.held_out for r in out if r.doc_id is None] == [False]
    assert scores(spark, docs, labels) == scores(spark, docs, labels)


@pytest.mark.parametrize("label, score", [(1, 1.0), (0, 0.0), (None, 0.5)])
def test_without_pairs(spark, label, score):
    docs, labels = tables(spark, [(i, GOOD, label) for i in range(1, 20)])
    assert set(scores(spark, docs, labels).values()) == {(score, int(score >= 0.3))}


def test_empty_tables(spark):
    docs, labels = tables(spark, [])
    assert scores(spark, docs, labels) == {}


def test_ranking_orders_and_cuts_at_the_quantile():
    rng = np.random.default_rng(4)
    names = len(quality.FEATURES)
    good, bad = rng.normal(1, 1, (900, names)), rng.normal(-1, 1, (100, names))
    ranking = quality.learned(good, bad, 0.1)
    assert (np.median(ranking.worth(good)) > ranking.threshold > np.median(ranking.worth(bad)))
    below = np.mean(np.concatenate([ranking.score(good), ranking.score(bad)]) < quality.CUT)
    assert below == pytest.approx(0.1, abs=0.002)
    order = np.argsort(ranking.worth(good))
    assert (np.diff(ranking.score(good[order])) >= 0).all()


def test_sample_is_bounded(spark):
    rows = [(i, f"{GOOD} {i}" if i % 2 else f"{BAD} {i}", i % 2) for i in range(400)]
    docs, labels = tables(spark, rows)
    ranking = quality.fit(docs, labels, train_rows=20)
    assert ranking.only is None
    out = {r.doc_id: r.predicted for r in quality.classified(docs, ranking).collect()}
    assert np.mean([out[i] == q for i, _, q in rows]) > 0.97


def test_features_by_hand():
    found = dict(zip(quality.FEATURES, quality.text_features(b"Ab ab!! 12\nab!! X$$ AB")))
    assert found["log_words"] == pytest.approx(np.log1p(6))
    assert found["upper_words"] == pytest.approx(1 / 6)
    assert found["words_without_letter"] == pytest.approx(1 / 6)
    assert found["words_ending_in_symbol"] == pytest.approx(1 / 6)
    assert found["distinct_words"] == pytest.approx(5 / 6)
    assert found["lines"] == pytest.approx(1 / 22)
    assert quality.text_features(None) == quality.text_features(b" \n") == [0.0] * len(quality.FEATURES)
