"""Adapters from the driver's test tables to the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.functions.timeops import utc_instant, utc_text
from gapwise.sources.events import CANONICAL_COLUMNS, RAW_EVENT_SCHEMA


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sample_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table in canonical columns; its id is unique, so the row order is total."""
    columns = {
        "event_time_utc": utc_instant(F.col("ts")),
        "product_id": F.col("event_id"),
        "price": F.col("value").cast("decimal(18,2)"),
        "source_user_session": F.col("props"),
        "category_id": F.lit(None).cast("long"),
        "category_code": F.lit(None).cast("string"),
        "brand": F.lit(None).cast("string"),
    }
    return table(spark, sf_dir, "events").select(
        *[columns.get(c, F.col(c)).alias(c) for c in CANONICAL_COLUMNS]
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as raw rows: text times to the second, source session by its old name."""
    time_text = F.concat(utc_text(F.col("event_time_utc")), F.lit(" UTC"))
    return (
        sample_events(spark, sf_dir)
        .withColumn("event_time", time_text)
        .withColumnRenamed("source_user_session", "user_session")
        .select(*RAW_EVENT_SCHEMA.fieldNames())
    )
