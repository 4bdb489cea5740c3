"""The registered queries of the training-data operators over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.llm import (
    divergence,
    exact,
    langid,
    lattice,
    lines,
    minhash,
    mixing,
    nsbounds,
    packing,
    quality,
    sharding,
    substrings,
    toolcalls,
)
from gapwise.scratch import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three fourths of them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~held_out))
    found = langid.predicted(spark, model, F.col("text"))
    return docs.select("doc_id", held_out.alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score"
    )


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of all conversations as linked, ordered and checked tool calls in canonical JSON."""
    turns = _table(spark, sf_dir, "conversations")
    calls, results, messages = toolcalls.read_as_calls(turns, mixing.word_count(F.col("text")))
    tools = spark.createDataFrame(toolcalls.TOOLS, "name string, parameters string")
    linked = toolcalls.link_calls(calls, results, tools, messages)
    return linked.withColumn("problems", F.concat_ws(",", "problems"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal counts, equal texts together where they fit."""
    return sharding.balanced_shards(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of the sources takes of every document."""
    docs = _table(spark, sf_dir, "documents")
    sized = materialize(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "sized")
    mixed = mixing.mix(mixing.with_quality(sized, _table(spark, sf_dir, "labels")), weight="weight")
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of near-equal vectors with equal labels, cosine 0.93 or more."""
    return lattice.near_vectors(_table(spark, sf_dir, "embeddings"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies of every document, five words and similarity 0.8."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that twelve of the sources or more share."""
    left = lines.remove_boilerplate(_table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.char_length("text").cast("long").alias("kept_chars"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copy that stays of each group of equal contents."""
    return exact.exact_duplicates(_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left when passages of 50 words that an earlier document has are removed."""
    return substrings.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as tokens in sequences of 2048."""
    return packing.packed_documents(_table(spark, sf_dir, "documents"))


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the words of each source are from other sources and from its language."""
    return divergence.source_divergence(_table(spark, sf_dir, "documents"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from four fifths of the labels."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classified(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors by the nearest of sixteen centroids after three rounds."""
    return nsbounds.clustered(_table(spark, sf_dir, "embeddings"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_language_id,
        op2_chat_formatting,
        op3_sharding,
        op4_mixing,
        op5_embedding_dedup,
        op6_minhash_dedup,
        op7_line_dedup,
        op8_exact_dedup,
        op9_substring_dedup,
        op10_packing,
        op11_divergence_audit,
        op12_quality_classifier,
        op13_centroid_clustering,
    )
    return {f.__name__: f for f in found}
