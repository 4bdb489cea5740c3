"""Languages of texts: known words first, then ever shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.llm.tables import free_name
from gapwise.llm.words import giving_back, in_slices
from gapwise.scratch import materialize

TRAIN_ROWS = 2_000  # labelled rows per language, about
ENTRIES = 50_000  # most frequent words, and n-grams of each length, that a model keeps
LONGEST = 4  # characters of an n-gram, word ends included
SMOOTHING = 0.5
UNKNOWN = "und"
MIN_SCORE = 0.3
MIN_KNOWN = 0.1
SHORT = 40  # letters of a text whose words may all be new by chance

_WORD = re.compile(r"[^\W\d_]+")
_REMEMBERED = 200_000


def text_words(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    return _WORD.findall(text.lower()) if text else []


def _has_letter(words: list[str]) -> bool:
    """Word characters that are no letters, such as superscript digits, may form words too."""
    return any(c.isalpha() for w in words for c in w)


def grams(word: str, n: int) -> list[str]:
    """The word's runs of ``n`` characters with its ends marked; single letters without the marks."""
    if n == 1:
        return list(word)
    marked = f"\x02{word}\x03"
    return [marked[k : k + n] for k in range(len(marked) - n + 1)]


@dataclass
class Table:
    """Log frequencies by language, one row per item."""

    place: dict[str, int]
    logs: np.ndarray
    floor: np.ndarray | None = None  # what an item has in a language that does not know it
    typical: np.ndarray | None = None  # share of letters in known items, in a new text by language

    def of(self, items: list[str]) -> np.ndarray | None:
        """Mean over the known ones of ``items``, None if none is."""
        known = [k for k in map(self.place.get, items) if k is not None]
        return self.logs[known].mean(axis=0) if known else None


@dataclass
class Model:
    """Frequencies of words, and of n-grams by length."""

    langs: list[str]
    words: Table
    grams: dict[int, Table]

    def of(self, word: str) -> np.ndarray:
        """Log frequencies of a word: its own if known, else the mean of the longest n-grams of it
        that are known; no evidence at all weighs all languages alike."""
        found = self.words.of([word])
        for n in range(LONGEST, 0, -1):
            if found is None:
                found = self.grams[n].of(grams(word, n))
        return np.zeros(len(self.langs)) if found is None else found

    def known(self, word: str) -> np.ndarray:
        """The word's letters, by language, where the language has the word; 0 elsewhere."""
        place = self.words.place.get(word)
        if place is None:
            return np.zeros(len(self.langs))
        return len(word) * (self.words.logs[place] > self.words.floor)


class _Places(dict):
    """Row of each word in a growing table of scores; starts anew when it has grown to its limit."""

    def __init__(self, model: Model, known: bool):
        super().__init__()
        self.model = model
        self.known = known  # also the letters known by language, and all letters
        self.table = np.empty((1024, len(model.langs) * (1 + known) + known))

    def __missing__(self, word: str) -> int:
        place = len(self)
        if place == len(self.table):
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
        found = self.model.of(word)
        self.table[place] = np.concatenate([found, self.model.known(word), [len(word)]]) if self.known else found
        self[word] = place
        return place


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[str, Counter] = {}
        for rows in in_slices(batch):
            for lang, text in zip(*rows):
                found.setdefault(lang, Counter()).update(text_words(text))
        for lang, counts in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counts)), pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())],
                names=["lang", "item", "n"],
            )


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[tuple[str, int], Counter] = {}
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            for size in range(1, LONGEST + 1):
                counts = found.setdefault((lang, size), Counter())
                for gram in grams(word, size):
                    counts[gram] += n
        for (lang, size), counts in found.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(counts)),
                    pa.array([size] * len(counts), pa.int32()),
                    pa.array(list(counts)),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["lang", "size", "item", "n"],
            )


def _frequencies(counts: DataFrame, langs: list[str], entries: int) -> Table:
    """Log frequencies by language of the ``entries`` most frequent items of (lang, item, n)."""
    sums = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{k}") for k, lang in enumerate(langs)]
    table = counts.groupBy("item").agg(*sums, F.sum("n").alias("n"))
    rows = table.orderBy(F.col("n").desc(), "item").limit(entries).toArrow()
    whole = counts.groupBy("lang").agg(
        F.sum("n").alias("n"),
        F.count_distinct("item").alias("kinds"),
        F.sum(F.col("n") * F.char_length("item")).alias("letters"),
    ).collect()
    total = {r.lang: r.n for r in whole}
    kinds = max((r.kinds for r in whole), default=1)
    n = np.stack([rows.column(f"n{k}").to_numpy() for k in range(len(langs))], axis=1)
    whole_n = np.array([total.get(lang, 0) for lang in langs], float)
    log = np.log((n + SMOOTHING) / (whole_n + SMOOTHING * kinds))
    floor = np.log(SMOOTHING / (whole_n + SMOOTHING * kinds))
    items = rows.column("item").to_pylist()
    # Items seen once stand for those that a new text has and the sample does not.
    letters = {r.lang: r.letters for r in whole}
    again = np.where(n > 1, n, 0) * np.array([len(item) for item in items]).reshape(-1, 1)
    typical = again.sum(axis=0) / np.array([letters.get(lang) or 1 for lang in langs], float)
    return Table({item: k for k, item in enumerate(items)}, log, floor, typical)


def fit(
    labelled: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    train_rows: int = TRAIN_ROWS,
    entries: int = ENTRIES,
) -> Model:
    """A model of the languages in ``labelled``; rows without text or language are left out.

    Of each language about ``train_rows`` rows are learned from, chosen by a hash of their
    identifier; the model holds at most ``entries`` words and as many n-grams of each length, so
    it has a fixed size whatever the corpus has.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.col(lang) != UNKNOWN))
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], Table({}, np.empty((0, 0))), {})
    place = F.pmod(F.xxhash64(F.lit("langid"), F.col(key)), F.lit(1 << 31)) / F.lit(float(1 << 31))
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col(lang) == name, train_rows / n).otherwise(share)
    sample = rows.where(place < share).select(lang, text)
    words = materialize(
        sample.mapInArrow(giving_back(_counts), "lang string, item string, n long").groupBy("lang", "item").agg(F.sum("n").alias("n")),
        "words",
    )
    pieces = words.mapInArrow(giving_back(_gram_counts), "lang string, size int, item string, n long")
    pieces = materialize(pieces.groupBy("lang", "size", "item").agg(F.sum("n").alias("n")), "grams")
    return Model(
        langs,
        _frequencies(words, langs, entries),
        {
            n: _frequencies(pieces.where(F.col("size") == n).drop("size"), langs, entries)
            for n in range(1, LONGEST + 1)
        },
    )


def predicted(spark: SparkSession, model: Model, text: Column, known: bool = False) -> Column:
    """A struct of ``lang_pred`` and ``score``, the probability of the predicted language given the
    whole text, all languages being as likely before.

    ``und`` with score 0 if the text is null or has no letter, or if no language was learned; ties
    go to the first language in order of name. With ``known`` the struct also has ``known``: the
    share of the text's letters in words that the predicted language has, as a part of the share
    that a new text of that language typically has (1 where every word of it is new, and for a
    text under ``SHORT`` letters with an n-gram of the longest kind that the model knows).
    """
    shared = spark.sparkContext.broadcast(model)

    def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model: Model = shared.value
        places = _Places(model, known)
        for column in texts:
            langs, scores, shares = [], [], []
            for text in (t for k in range(0, len(column), 200) for t in column.slice(k, 200).to_pylist()):
                words = text_words(text)
                if not model.langs or not _has_letter(words):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    shares.append(0.0)
                    continue
                at = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
                sums = places.table[at].sum(axis=0)
                total = sums[: len(model.langs)]
                odds = np.exp(total - total.max())
                best = int(odds.argmax())
                langs.append(model.langs[best])
                scores.append(float(odds[best] / odds.sum()))
                if known:
                    usual = model.words.typical[best] * sums[-1]
                    share = float(sums[len(model.langs) + best] / usual) if usual else 1.0
                    if share < 1 and sums[-1] < SHORT and any(
                        g in model.grams[LONGEST].place for w in words for g in grams(w, LONGEST)
                    ):
                        share = 1.0
                    shares.append(share)
                if len(places) > _REMEMBERED:
                    places = _Places(model, known)
            columns = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            if known:
                columns.append(pa.array(shares, pa.float64()))
            yield pa.StructArray.from_arrays(columns, ["lang_pred", "score", "known"][: len(columns)])

    @F.arrow_udf("lang_pred string, score double" + (", known double" if known else ""))
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from giving_back(found)(texts)

    return scored(text)


def held_out(key: Column) -> Column:
    """The fourth of the documents that no model learns from."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def accepted(
    docs: DataFrame, model: Model, text: str = "text", min_score: float = MIN_SCORE, min_known: float = MIN_KNOWN
) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language: others have no letter, or no
    language is likelier than ``min_score``, or the likeliest knows too few of the text's words.

    The score says which of the learned languages is likeliest, not that the text is in one of
    them. That is told by the share of letters in words that the language has: at least
    ``min_known`` of the share in a new text of the language, whatever their number is.
    """
    (found,) = free_name(docs, "found")
    marked = docs.withColumn(found, predicted(docs.sparkSession, model, F.col(text), known=True))
    good = (F.col(f"{found}.lang_pred") != UNKNOWN) & (F.col(f"{found}.score") >= min_score)
    return marked.where(good & (F.col(f"{found}.known") >= min_known)).drop(found)
