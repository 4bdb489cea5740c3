"""Time sessions over a multiple of the events table: ``python tests/scale.py [sf_dir] [copies]``.

Each copy has users of its own, so the number of rows and of users grows together. Prints seconds
for the one-window sessions, with and without the pass that looks for hot users, and for the usual
three window specifications. With 200 copies of the sf0.1 table there are 20 million rows.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gapwise.operators.event_sessions import event_rule  # noqa: E402
from gapwise.operators.hot import HOT_ROWS  # noqa: E402
from gapwise.operators.sessions import sessionize  # noqa: E402
from gapwise.sources.samples import sample_events  # noqa: E402


def three_windows(events: DataFrame, gap: int) -> DataFrame:
    by_user = Window.partitionBy("user_id").orderBy("event_time_utc", "source_user_session", "product_id")
    before = F.unix_timestamp(F.lag("event_time_utc").over(by_user))
    opens = F.coalesce(F.unix_timestamp("event_time_utc") - before >= gap, F.lit(True)).cast("int")
    so_far = by_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    session = Window.partitionBy("user_id", "session_seq")
    return (
        events.withColumn("opens", opens)
        .withColumn("session_seq", F.sum("opens").over(so_far))
        .withColumn("session_start", F.min("event_time_utc").over(session))
        .withColumn("session_event_seq", F.row_number().over(session.orderBy("event_time_utc", "product_id")))
    )


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 200
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "32")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    path = f"{tempfile.mkdtemp(prefix='run-')}/events"
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    rows = sample_events(spark, sf_dir).withColumn("copy", copy)
    rows = rows.withColumn("user_id", F.col("user_id") * copies + F.col("copy")).drop("copy")
    rows.write.parquet(path)
    events, rule = spark.read.parquet(path), event_rule()
    timed = {
        "warm up": sessionize(events, rule, None),
        "one window": sessionize(events, rule, None),
        "one window, hot users looked for": lambda: sessionize(events, rule, HOT_ROWS),
        "three windows": three_windows(events, rule.gap_seconds),
    }
    print(f"{events.count()} rows")
    for name, df in timed.items():
        began = time.perf_counter()
        (df() if callable(df) else df).write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.perf_counter() - began:.1f} s", flush=True)


if __name__ == "__main__":
    main()
