"""Document quality from preference pairs (Bradley-Terry)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.llm.tables import utf8
from gapwise.llm.words import mixed, word_hashes

TRAIN_ROWS = 4_000  # labelled documents of each label, at most
PAIRS = 40_000  # preference pairs made of them
ROUNDS = 300
PENALTY = 1e-4
CUT = 0.3  # the score that a document at the threshold has
SEED = 12

# Kinds of bytes: bytes beyond ASCII belong to letters.
_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _PUNCTUATION, _SYMBOL = range(7)
_KIND = np.full(256, _SYMBOL, np.uint8)
_KIND[0x80:] = _LOWER
_KIND[ord("a") : ord("z") + 1] = _LOWER
_KIND[ord("A") : ord("Z") + 1] = _UPPER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[list(b" \t\x0b\x0c\r")] = _SPACE
_KIND[ord("\n")] = _LINE
_KIND[list(b".,;:'\"-()!?")] = _PUNCTUATION

FEATURES = (
    "log_words",
    "lower",
    "upper",
    "digits",
    "spaces",
    "lines",
    "punctuation",
    "symbols",
    "mean_word",
    "spread_of_word",
    "distinct_words",
    "top_word",
    "word_again",
    "distinct_pairs",
    "words_without_letter",
    "words_ending_in_symbol",
    "upper_words",
)


def text_features(text: bytes | None) -> list[float]:
    """Figures of the whole text, one per name of ``FEATURES``; all 0 for a text without words."""
    raw = np.frombuffer(text or b"", np.uint8)
    kind = _KIND[raw]
    blank = (kind == _SPACE) | (kind == _LINE)
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    words = len(begin)
    if not words:
        return [0.0] * len(FEATURES)
    shares = np.bincount(kind, minlength=7) / len(raw)
    length = end - begin

    def inside(mask: np.ndarray) -> np.ndarray:
        """How many bytes of each word have the property."""
        before = np.concatenate([[0], np.cumsum(mask)])
        return before[end] - before[begin]

    letters = inside((kind == _LOWER) | (kind == _UPPER))
    hashes = word_hashes(text)
    counts = np.unique(hashes, return_counts=True)[1]
    pairs = mixed(hashes[:-1]) + hashes[1:]
    return [
        float(np.log1p(words)),
        *shares,
        float(length.mean()),
        float(length.std()),
        len(counts) / words,
        counts.max() / words,
        float((hashes[:-1] == hashes[1:]).sum()) / words,
        len(np.unique(pairs)) / max(1, len(pairs)),
        float((letters == 0).mean()),
        float((kind[end - 1] >= _SYMBOL).mean()),
        float(((inside(kind == _UPPER) == letters) & (letters > 1)).mean()),
    ]


@dataclass
class Ranking:
    """Worth of a document: a weighted sum of its features, scaled to the sample."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float  # the worth that the cut stands for
    slope: float
    only: float | None = None  # the score of every text, where there were no pairs to learn from

    def _scaled(self, features: np.ndarray) -> np.ndarray:
        x = np.clip((features - self.centre) / self.spread, -5, 5)
        return np.hstack([x, x * x])

    def worth(self, features: np.ndarray) -> np.ndarray:
        return self._scaled(features) @ self.weights

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.only is not None:
            return np.full(len(features), self.only)
        return _logistic(self.slope * (self.worth(features) - self.threshold) + _ODDS)


_ODDS = float(np.log(CUT / (1 - CUT)))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def learned(good: np.ndarray, bad: np.ndarray, share_bad: float, pairs: int = PAIRS) -> Ranking:
    """A ranking from the features of documents with label 1 and of those with label 0.

    Each pair says that a good document is worth more than a bad one, and the chance of that is the
    logistic function of the difference of their worths; the weights make the pairs likeliest.  The
    threshold is the quantile of the worths that as many documents lie below as are bad: all labelled
    documents taken, ``share_bad`` of them.
    """
    both = np.concatenate([good, bad])
    if not len(good) or not len(bad):
        only = 0.5 if not len(both) else float(len(good) > 0)
        none = np.zeros(len(FEATURES))
        return Ranking(none, none + 1, np.zeros(2 * len(FEATURES)), 0.0, 1.0, only)
    ranking = Ranking(both.mean(axis=0), both.std(axis=0) + 1e-9, np.zeros(2 * len(FEATURES)), 0.0, 1.0)
    rng = np.random.default_rng(SEED)
    better, worse = (ranking._scaled(x)[rng.integers(0, len(x), pairs)] for x in (good, bad))
    away = better - worse
    for _ in range(ROUNDS):
        doubt = _logistic(-(away @ ranking.weights))
        ranking.weights = ranking.weights + 0.5 * (away.T @ doubt / len(away) - PENALTY * ranking.weights)
    worth = ranking.worth(both)
    weight = np.concatenate([np.full(len(good), (1 - share_bad) / len(good)), np.full(len(bad), share_bad / len(bad))])
    order = np.argsort(worth, kind="stable")
    below = np.cumsum(weight[order])
    # Half way between the last document of the lower part and the first above it.
    last = min(int(np.searchsorted(below, share_bad - 1e-9)), len(order) - 2)
    ranking.threshold = float(worth[order[last]] + worth[order[last + 1]]) / 2
    ranking.slope = _slope(worth - ranking.threshold, np.arange(len(both)) < len(good), weight)
    return ranking


def _slope(above: np.ndarray, good: np.ndarray, weight: np.ndarray) -> float:
    """The steepness that makes the labels likeliest, the cut being where it is."""
    tried = np.geomspace(0.05, 5, 60)
    chance = _logistic(np.where(good, 1, -1) * (tried[:, None] * above + _ODDS))
    return float(tried[(np.log(np.maximum(chance, 1e-300)) * weight).sum(axis=1).argmax()])


def held_out(key: Column) -> Column:
    """The fifth of the documents that nothing is learned from; false without identifier."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    train_rows: int = TRAIN_ROWS,
    pairs: int = PAIRS,
) -> Ranking:
    """A ranking learned from labelled documents outside ``held_out``.

    Of each label the ``train_rows`` documents with the lowest hash of their identifier are learned
    from, so the features that reach the driver are bounded (8,000 rows of 17 numbers).
    Documents whose labels disagree or are null are left out; of documents with one identifier the
    one with the lowest features counts.
    """
    known = labels.where(F.col(key).isNotNull() & ~held_out(F.col(key))).groupBy(F.col(key).alias("_key")).agg(
        F.min(label).alias("_low"), F.max(label).alias("_high")
    )
    known = known.where("_low = _high AND _low IN (0, 1)").select("_key", F.col("_low").alias("_label"))
    sizes = {r[0]: r[1] for r in known.groupBy("_label").count().collect()}  # two rows
    place = F.xxhash64(F.lit("quality"), "_key")
    chosen = [known.where(F.col("_label") == n).orderBy(place, "_key").limit(train_rows) for n in (0, 1)]
    sample = docs.join(F.broadcast(chosen[0].union(chosen[1])), F.col(key) == F.col("_key"))
    lists = sample.select("_key", "_label", _features(F.col(text)).alias("_x"))
    rows = lists.groupBy("_key", "_label").agg(F.min("_x").alias("_x")).orderBy("_key").collect()
    good, bad = (
        np.array([r["_x"] for r in rows if r["_label"] == n], float).reshape(-1, len(FEATURES)) for n in (1, 0)
    )
    share_bad = sizes.get(0, 0) / max(1, sum(sizes.values()))
    return learned(good, bad, share_bad, pairs)


def _feature_rows(texts: pa.Array) -> np.ndarray:
    found = [
        text_features(text) for k in range(0, len(texts), 50) for text in texts.slice(k, 50).to_pylist()
    ]
    return np.array(found, float).reshape(-1, len(FEATURES))


def _features(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(_feature_rows(column).tolist(), pa.list_(pa.float64()))

    return of(utf8(text))


def scored(spark: SparkSession, ranking: Ranking, text: Column) -> Column:
    """The score of a whole text, 0 to 1: higher for what label 1 is likelier for, ``CUT`` at the
    threshold.  Null and empty texts have the score of a text whose figures are all 0; without
    pairs to learn from all texts have the score of the only label, 0.5 if there is none.
    """
    shared = spark.sparkContext.broadcast(ranking)

    @F.arrow_udf("double")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(shared.value.score(_feature_rows(column)), pa.float64())

    return of(utf8(text))


def classified(
    docs: DataFrame, ranking: Ranking, key: str = "doc_id", text: str = "text", cut: float = CUT
) -> DataFrame:
    """Every document with ``held_out``, its ``score`` and ``predicted``: 1 from ``cut`` on."""
    found = docs.select(
        F.col(key).alias("doc_id"),
        held_out(F.col(key)).alias("held_out"),
        scored(docs.sparkSession, ranking, F.col(text)).alias("score"),
    )
    return found.withColumn("predicted", (F.col("score") >= cut).cast("int"))
