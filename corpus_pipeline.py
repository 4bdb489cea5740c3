"""From raw documents to packed training sequences.

Five stages, each over all documents that the one before it kept; every stage is written as Parquet
and read again by the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.llm import langid, lines, minhash, mixing, packing
from gapwise.scratch import materialize

# Language models, sketches and iterative labels have no SQL counterpart.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts in no language that the labelled documents teach."""
    return langid.accepted(docs, langid.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that twelve sources or more share, out of pages that have more than them."""
    left = lines.remove_boilerplate(docs).select(*docs.columns)
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest identifier of each class of near copies."""
    return minhash.near_duplicates(docs).where("kept").select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes every document as often as its source's share of the mix asks: not at all, once, or
    twice as two rows."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    sized = mixing.with_quality(docs.withColumn("size", mixing.word_count(F.col("text"))), labels)
    mixed = mixing.mix(sized, weight="weight").where("copies > 0")
    return mixed.select(*docs.columns, F.explode(F.sequence(F.lit(1), "copies"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of all documents in sequences of 2048; a document taken twice is packed twice."""
    return packing.packed_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
