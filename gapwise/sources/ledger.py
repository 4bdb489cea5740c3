"""Run ledger: one row per state change of a run, and what the rows say about days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.scratch import materialize

# States of a run, and names, types and order of the ledger fields.
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("application", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("lookback_input", T.StringType()),
        T.StructField("input_paths", T.ArrayType(T.StringType())),
        T.StructField("output", T.StringType()),
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("session_gap_minutes", T.IntegerType()),
        T.StructField("repartition_by_dt", T.BooleanType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("partitions", T.ArrayType(T.StringType())),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("error_class", T.StringType()),
        T.StructField("error_message", T.StringType()),
        # Own additions, after the fixed fields.
        T.StructField("rejected_rows", T.LongType()),
        T.StructField("sessions_at_edge", T.LongType()),
        T.StructField("late_rows", T.LongType()),
        T.StructField("state_from", T.StringType()),
        T.StructField("publish_mode", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("before_range_rows", T.LongType()),
        T.StructField("after_range_rows", T.LongType()),
        T.StructField("removed_rows", T.LongType()),
        T.StructField("unparsed_rows", T.LongType()),
        # Of a compaction: the run whose rows each day has.
        T.StructField("origins", T.MapType(T.StringType(), T.StringType())),
    ]
)


def ledger_path(root: str) -> str:
    return f"{root.rstrip('/')}/_runs"


def append_state(spark: SparkSession, root: str, fields: dict) -> None:
    """Add one state row; earlier rows of the run stay."""
    row = [_literal(fields.get(f.name)).cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA]
    append_rows(spark.range(0, 1, 1, 1).select(row), root)


def append_rows(rows: DataFrame, root: str) -> None:
    """Add state rows with any of the ledger's fields."""
    writer = rows.write.mode("append").option("ignoreNullFields", "false")
    writer.option("timestampFormat", TIME_PATTERN).json(ledger_path(root))


def _literal(value: object) -> Column:
    if isinstance(value, dict):
        return F.create_map(*[F.lit(x) for pair in value.items() for x in pair])
    return F.lit(value)


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """All state rows; none when no run was ever started here."""
    try:
        reader = spark.read.schema(LEDGER_SCHEMA).option("timestampFormat", TIME_PATTERN)
        return reader.json(ledger_path(root))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def latest_states(ledger: DataFrame) -> DataFrame:
    """The last state row of every run.  At equal times a final state wins over RUNNING."""
    at = F.coalesce("completed_at", "started_at")
    final = F.when(F.col("status") == RUNNING, 0).otherwise(1)
    rest = [c for c in ledger.columns if c != "run_id"]
    last = F.max_by(F.struct(*rest), F.struct(at, final))
    return ledger.groupBy("run_id").agg(last.alias("_last")).select("run_id", "_last.*")


def outcome(status: Column) -> Column:
    """What a run's last state means for its days."""
    return (
        F.when(status == SUCCESS, "done")
        .when(status == FAILED, "failed")
        .when(status == RUNNING, "incomplete")
        .otherwise("not done")
    )


def run_outcomes(planned: DataFrame, ledger: DataFrame) -> DataFrame:
    """``planned`` (run_id) with each run's outcome; a run without any row is not done."""
    states = latest_states(ledger).select("run_id", "status")
    return planned.join(states, "run_id", "left").select(
        *planned.columns, outcome(F.col("status")).alias("outcome")
    )


def covered_days(ledger: DataFrame, lake: Sequence[str] = ()) -> DataFrame:
    """Per day asked of a finished run: the last such run (``origin``), the version that has its
    rows (``run_id``: the run itself or its last compaction), and whether there are rows.

    A run answers for every day of its range, so a day that came out empty hides older versions.
    A compaction answers for nothing: it only stands in for the run that it copied, so one that
    ends after a re-run of its days does not hide the re-run's rows. ``lake`` names ledger columns
    that tell several lakes apart, e.g. ``output``.
    """
    done = latest_states(ledger).filter(F.col("status") == SUCCESS)
    origins = F.map_filter("origins", lambda _, run: run.isNotNull())
    copied = F.coalesce(F.size(origins), F.lit(-1)) > 0
    last_day = F.date_sub(F.to_date("end_date"), 1)
    days = F.explode(F.sequence(F.to_date("start_date"), last_day))
    kept = ["run_id", "completed_at", "partitions"]
    asked = (
        done.filter(~copied)
        .select(*lake, *kept, days.alias("_day"))
        .select(*lake, *kept, F.col("_day").cast("string").alias("dt"))
    )
    last = F.max_by(F.struct("run_id", "partitions"), F.struct("completed_at", "run_id"))
    answers = (
        asked.groupBy(*lake, "dt")
        .agg(last.alias("_run"))
        .select(
            *lake,
            "dt",
            F.col("_run.run_id").alias("origin"),
            F.array_contains("_run.partitions", F.col("dt")).alias("has_rows"),
        )
    )
    copies = (
        done.filter(copied)
        .select(*lake, "run_id", "completed_at", F.explode("origins").alias("dt", "origin"))
        .groupBy(*lake, "dt", "origin")
        .agg(F.max_by("run_id", F.struct("completed_at", "run_id")).alias("_copy"))
    )
    return answers.join(copies, [*lake, "dt", "origin"], "left").select(
        *lake, "dt", F.coalesce("_copy", "origin").alias("run_id"), "origin", "has_rows"
    )


def current_versions(ledger: DataFrame) -> DataFrame:
    """Pointer (dt, run_id, origin) to the version each day is read from.

    It is derived from SUCCESS rows alone, so the one small ledger write that ends a run moves all
    its days together.
    """
    return covered_days(ledger).filter("has_rows").select("dt", "run_id", "origin")


def redo_days(planned: DataFrame, ledger: DataFrame, lake: Sequence[str] = ()) -> DataFrame:
    """Planned days (``lake`` columns and dt) that no finished run answers for."""
    return planned.join(covered_days(ledger, lake), [*lake, "dt"], "left_anti")


ASKED, SAME_RUN, LOOKBACK, STATE = "asked", "same run", "lookback", "state"


def redo_closure(asked: DataFrame, ledger: DataFrame, lake: Sequence[str] = ()) -> DataFrame:
    """All days that are outdated when the days ``asked`` (``lake`` columns and dt) are redone
    because their input changed: (``lake``, dt, run_id, because, steps).

    ``run_id`` is the run that answers for the day, and ``because`` tells why it must run again:

    * ``asked``: the day itself.
    * ``same run``: a later day of that run; sessions that reach into it, and session numbers, change.
    * ``lookback``: the run read an input of an asked run as history, under the same path text.
    * ``state``: the run continued the sessions of an outdated run, directly or over ``steps`` runs.

    Only raw files are read as history, and running again does not change a run's own files: so only
    inputs of asked runs outdate by lookback, while states do so however long the chain is.  Days
    that a later run answers for are not outdated, but chains go through replaced runs, whose states
    others may have continued.  Asked days that no run answers for are left to ``redo_days``.

    Chains are followed by pointer doubling: rounds grow with the logarithm of the longest chain, and
    each writes one row per run.
    """
    covered = materialize(covered_days(ledger, lake).select(*lake, "dt", "origin"), "covered")
    runs = materialize(
        latest_states(ledger)
        .filter(F.col("status") == SUCCESS)
        .select(*lake, "run_id", "state_from", "input", "lookback_input"),
        "runs",
    )
    wanted = asked.select(*lake, "dt").distinct().join(covered, [*lake, "dt"])
    wanted = materialize(wanted.select(*lake, "dt", F.col("origin").alias("run_id")), "asked")
    starts = wanted.groupBy("run_id").agg(F.min("dt").alias("_first"))

    def paths(of: str) -> Column:
        return F.explode(F.filter(F.transform(F.split(of, ","), lambda path: F.trim(path)), lambda path: path != ""))

    changed = runs.join(starts, "run_id", "left_semi").select(*lake, paths("input").alias("_path"))
    readers = (
        runs.select(*lake, "run_id", paths("lookback_input").alias("_path"))
        .join(changed.distinct(), [*lake, "_path"], "left_semi")
        .select("run_id")
        .distinct()
        .withColumn("_reads", F.lit(1))
    )
    runs = runs.select("run_id", F.col("state_from").alias("_from")).join(starts, "run_id", "left")
    runs = materialize(runs.join(readers, "run_id", "left"), "read-by")
    own = F.when(F.col("_first").isNotNull(), 0).otherwise(F.col("_reads"))
    nodes = materialize(runs.select("run_id", F.col("_from").alias("_up"), own.alias("_steps")), "chains")
    # After so many rounds every pointer has left its chain; one that has not is in a ring, all of
    # which it has seen then.
    for k in range(nodes.count().bit_length()):
        if nodes.filter(F.col("_up").isNotNull()).isEmpty():
            break
        above = nodes.select(F.col("run_id").alias("_up"), F.col("_up").alias("_next"), F.col("_steps").alias("_far"))
        nearest = F.least("_steps", F.col("_far") + F.lit(2**k))
        nodes = nodes.join(above, "_up", "left").select(
            "run_id", F.col("_next").alias("_up"), nearest.alias("_steps")
        )
        nodes = materialize(nodes, "chains")
    above = nodes.select(F.col("run_id").alias("_from"), (F.col("_steps") + 1).alias("_above"))
    outdated = runs.join(above, "_from", "left").select(
        F.col("run_id").alias("origin"), "_first", "_reads", "_above"
    )
    is_asked = wanted.select(
        F.col("dt").alias("_dt"), *[F.col(c).alias(f"_{c}") for c in lake], F.lit(True).alias("_asked")
    )
    same_day = [F.col("dt") == F.col("_dt"), *[F.col(c) == F.col(f"_{c}") for c in lake]]
    days = covered.join(outdated, "origin").join(is_asked, same_day, "left")
    because = (
        F.when(F.col("_asked"), ASKED)
        .when(F.col("dt") >= F.col("_first"), SAME_RUN)
        .when(F.col("_reads") == 1, LOOKBACK)
        .when(F.col("_above").isNotNull(), STATE)
    )
    steps = F.when(because.isin(ASKED, SAME_RUN), 0).when(because == LOOKBACK, 1).otherwise(F.col("_above"))
    return days.filter(because.isNotNull()).select(
        *lake, "dt", F.col("origin").alias("run_id"), because.alias("because"), steps.cast("int").alias("steps")
    )
