"""Languages: held-out accuracy, backoff by hand, odd texts."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from gapwise.llm import langid
from gapwise.llm.queries import op1_language_id

SCHEMA = "doc_id long, text string, lang string, score double, found int"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, 0.0, 1) for r in rows], SCHEMA)


TRAIN = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)]


def predict(spark, train, texts):
    model = langid.fit(rows_of(spark, train))
    docs = rows_of(spark, [(i, t, None) for i, t in enumerate(texts)])
    from pyspark.sql import functions as F

    out = docs.select("doc_id", langid.predicted(spark, model, F.col("text")).alias("p")).collect()
    return model, [(r.p.lang_pred, r.p.score) for r in sorted(out, key=lambda r: r.doc_id)]


def test_query_is_accurate_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = op1_language_id(spark, folder).collect()
    assert sorted(r.doc_id for r in out) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert len(held) > 150
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.98


def test_known_and_unseen_words(spark):
    texts = ["THE dog", "und", "hunde katzen", "dogs cats", None, "", "12 ²³ _ !", "привет мир", "the " * 200_000]
    model, got = predict(spark, TRAIN, texts)
    assert model.langs == ["de", "en"]
    assert [g[0] for g in got[:4]] == ["en", "de", "de", "en"]
    assert got[4:7] == [("und", 0.0)] * 3
    assert got[7][1] == pytest.approx(0.5)
    assert got[8] == ("en", 1.0)


def test_backoff_by_hand(spark):
    model, _ = predict(spark, TRAIN, [])
    seen = model.words
    assert np.array_equal(model.of("the"), seen.logs[seen.place["the"]])
    longest = model.grams[4]
    known = [longest.logs[longest.place[g]] for g in ("\x02the",)]
    assert np.allclose(model.of("thexx"), np.mean(known, axis=0))
    assert np.allclose(model.of("qtq"), model.grams[1].logs[model.grams[1].place["t"]])
    assert not model.of("ж").any()


def test_rows_without_language_teach_nothing(spark):
    _, got = predict(spark, [(1, "a b", None), (2, None, "en"), (3, "x", "und")], ["a b"])
    assert got == [("und", 0.0)]
    _, got = predict(spark, [], ["a b"])
    assert got == [("und", 0.0)]


def test_sample_is_bounded(spark):
    rows = [(i, f"w{i}x", "en") for i in range(3000)] + [(9000 + i, "drei", "de") for i in range(20)]
    model = langid.fit(rows_of(spark, [(i, t.replace("0", "o"), lang) for i, t, lang in rows]), train_rows=100, entries=50)
    assert len(model.words.place) <= 50
    assert model.langs == ["de", "en"]


def test_accepted_keeps_columns_and_clean_rows(spark):
    model = langid.fit(rows_of(spark, TRAIN))
    docs = rows_of(spark, [(1, "the cat", None), (2, None, "en"), (3, "...", "en"), (3, "der", "xx"), (3, "der", "xx")])
    out = langid.accepted(docs, model)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 3]
    assert langid.accepted(docs.limit(0), model).collect() == []


FOREIGN = [
    "Bugün hava çok güzel olduğu için arkadaşlarımla birlikte parkta uzun bir yürüyüş yaptık.",
    "Dzisiaj rano poszedłem do sklepu, żeby kupić świeży chleb i mleko dla całej rodziny.",
    "Tänään aamulla kävelin metsässä ja näin monta kaunista lintua puiden oksilla.",
    "aGVsbG8gd29ybGQgdGhpcyBpcyBhIHRlc3Qgb2YgYmFzZTY0IGVuY29kZWQganVuayB0ZXh0IGZvciB0aGUgbW9kZWw",
    "xqzv jkwq zzxv qqkj wvxz kqjz vxqw",
    "привет мир как дела",
]


@pytest.mark.parametrize("langs", [["en"], ["en", "fr"], ["de", "en", "es"], ["de", "en", "es", "fr"]])
def test_accepted_rejects_other_languages(spark, langs):
    """However many languages are learned; clean documents that no model learned from all stay."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(F.col("lang").isin(langs))
    held_out = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~held_out))
    clean = docs.where(held_out).select("doc_id", "text")
    foreign = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(FOREIGN)], "doc_id long, text string")
    short = spark.createDataFrame([(10**9, "Èviçle çréan. Ouchément oneuxque.")], "doc_id long, text string")
    clean = clean.union(short) if "fr" in langs else clean
    kept = [r.doc_id for r in langid.accepted(clean.union(foreign), model).collect()]
    letters = [r.doc_id for r in clean.collect() if any(c.isalpha() for c in r.text or "")]
    assert model.langs == langs and len(letters) > 10
    assert sorted(kept) == sorted(letters)


def test_held_out_of_null(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(None,), (1,)], "doc_id long")
    got = [r.h for r in df.select(langid.held_out(F.col("doc_id")).alias("h")).collect()]
    assert got == [False, zlib.crc32(b"1") % 4 == 2]
