"""Event input: schemas, typed CSV scans, lookback, duplicate removal, reject rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.functions.timeops import parse_event_time

# Column names, types and order of the raw CSV files.
RAW_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DecimalType(18, 2)),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_session", T.StringType()),
    ]
)

CANONICAL_COLUMNS = (
    "event_time_utc",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "source_user_session",
)


def split_paths(*path_lists: str | None) -> list[str]:
    """Paths of comma separated lists in the given order, blanks dropped.

    Each may be a glob.  A path named twice is read twice, as a bag union would.
    """
    parts = [p.strip() for paths in path_lists if paths for p in paths.split(",")]
    return [p for p in parts if p]


# The line of a row that did not parse as the schema says; NULL for all other rows.
UNPARSED = "unparsed_line"


def read_raw_events(
    spark: SparkSession, paths: Sequence[str], rescue: bool = False, header: bool = True
) -> DataFrame:
    """Typed CSV scan with a header row; a number that does not parse becomes NULL.

    With ``rescue`` the column ``UNPARSED`` has the whole line of rows with such a number, or with
    more or fewer fields than the schema, so that nothing of the text is lost.
    """
    reader = spark.read.option("header", header)
    if not rescue:
        return reader.schema(RAW_EVENT_SCHEMA).csv(list(paths))
    schema = T.StructType([*RAW_EVENT_SCHEMA, T.StructField(UNPARSED, T.StringType())])
    return reader.schema(schema).option("columnNameOfCorruptRecord", UNPARSED).csv(list(paths))


def canonical_events(raw: DataFrame, strict_time: bool = False) -> DataFrame:
    """Raw rows with a real event time and the source's own session id set aside; the lines of
    ``read_raw_events`` stay, if there."""
    kept = [UNPARSED] if UNPARSED in raw.columns else []
    return (
        raw.withColumn("event_time_utc", parse_event_time(F.col("event_time"), strict_time))
        .withColumnRenamed("user_session", "source_user_session")
        .drop("event_time")
        .select(*CANONICAL_COLUMNS, *kept)
    )


def with_lookback(target: DataFrame, history: DataFrame | None) -> DataFrame:
    """History rows in front of the target rows; all of them shape sessions."""
    return target if history is None else history.unionByName(target)


def drop_copies(events: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """One row per event key (default: the whole row), for inputs that overlap.

    Copies combine on the map side, so a large group of copies shuffles one row per task.
    """
    return events.dropDuplicates(list(key) if key else None)


# Copies of one row that one task makes.
_COPIES_AT_ONCE = 10_000


def reconcile_union(target: DataFrame, history: DataFrame) -> DataFrame:
    """Union of inputs that overlap: every distinct row as often as the input that has it oftener.

    A row that is in both once is the same event, told twice; a row that is in one of them three
    times is three events.  So neither overlaps count double, as in ``with_lookback``, nor are real
    repeats lost, as in ``drop_copies``.  Columns are matched by name; NULLs are equal.

    Copies are counted on the map side, so a large group of them shuffles one row per task, and are
    made again in many tasks.
    """
    columns = target.columns
    sides = target.withColumn("_of", F.lit(1)).unionByName(history.withColumn("_of", F.lit(0)))
    in_target = F.count_if(F.col("_of") == 1)
    counted = sides.groupBy(*columns).agg(F.greatest(in_target, F.count("*") - in_target).alias("_copies"))
    many = F.col("_copies") > _COPIES_AT_ONCE
    # Rows by the ten thousand are dealt out before they are made; all others are made where they are.
    few = counted.filter(~many).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    runs = F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(_COPIES_AT_ONCE).cast("long"))
    dealt = counted.filter(many).withColumn("_from", F.explode(runs)).repartition("_from", *columns)
    left = F.least(F.col("_copies") - F.col("_from"), F.lit(_COPIES_AT_ONCE).cast("long"))
    made = dealt.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), left)))
    return few.select(*columns).unionByName(made.select(*columns))


def is_reject() -> Column:
    """True for rows that cannot belong to a user's timeline."""
    return F.col("user_id").isNull() | F.col("event_time_utc").isNull()
