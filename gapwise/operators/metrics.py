"""Weekly figures and audits over published rows.

A session belongs to one user and has one start, so sessions and users are counted by grouping by
user first. Rows that come from a sessionizer already lie by user: only the last step, with one row
per (task, group), is shuffled, and the session ids need not be computed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.functions.timeops import week_start

_SESSION = ("user_id", "session_start_at_utc")


def wau_users(
    published: DataFrame, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """Distinct users per Monday week."""
    by_user = _by_week(published, start_date, end_date).select("user_id", "week_start").distinct()
    return (
        by_user.groupBy("week_start").agg(F.count("user_id").alias("wau_users")).orderBy("week_start")
    )


def wau_sessions(
    published: DataFrame, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """Distinct sessions per Monday week; one that crosses a week edge counts in both weeks."""
    return weekly_engagement(published, start_date, end_date).drop("wau_users")


def weekly_engagement(
    published: DataFrame, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """Distinct users and sessions per Monday week, from one read."""
    sessions = _by_week(published, start_date, end_date).select(*_SESSION, "week_start").distinct()
    by_user = sessions.groupBy("user_id", "week_start").agg(F.count("*").alias("n"))
    return (
        by_user.groupBy("week_start")
        .agg(F.count("user_id").alias("wau_users"), F.sum("n").alias("wau_sessions"))
        .orderBy("week_start")
    )


def _by_week(published: DataFrame, start_date: str | None, end_date: str | None) -> DataFrame:
    # Day bounds compare the stored text, so they prune partitions of a lake.
    if start_date is not None:
        published = published.filter(F.col("dt") >= start_date)
    if end_date is not None:
        published = published.filter(F.col("dt") < end_date)
    return published.withColumn("week_start", week_start(F.col("dt")))


def mark_complete_weeks(weekly: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """Add ``complete_week``: all seven days lie in the half-open range of published days."""
    first = F.col("week_start") >= F.to_date(F.lit(start_date))
    last = F.date_add("week_start", 7) <= F.to_date(F.lit(end_date))
    return weekly.withColumn("complete_week", first & last)


def daily_audit(published: DataFrame) -> DataFrame:
    by_user = _session_days(published).groupBy("user_id", "dt").agg(
        F.sum("n").alias("n"), F.count("*").alias("sessions")
    )
    return (
        by_user.groupBy("dt")
        .agg(
            F.sum("n").alias("row_count"),
            F.count("user_id").alias("users"),
            F.sum("sessions").alias("sessions"),
        )
        .orderBy("dt")
    )


def global_audit(published: DataFrame) -> DataFrame:
    """One row: rows, days, users and sessions, each counted once however many days it is on.

    Hash aggregates by session, then by user, so a user of any size is one row per task in the
    shuffle.  Days are counted beside them from the day column alone, which needs no sessions.
    """
    sessions = published.groupBy(*_SESSION).agg(F.count("*").alias("n"))
    users = sessions.groupBy("user_id").agg(F.sum("n").alias("n"), F.count("*").alias("sessions"))
    counted = users.select(
        F.col("n").alias("row_count"), F.col("user_id").isNotNull().cast("long").alias("users"), "sessions"
    )
    days = published.select("dt").distinct().filter(F.col("dt").isNotNull())
    both = counted.unionByName(days.select(F.lit(1).cast("long").alias("days")), allowMissingColumns=True)
    return both.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("row_count", "users", "sessions", "days")]
    )


def _session_days(published: DataFrame) -> DataFrame:
    return published.groupBy(*_SESSION, "dt").agg(F.count("*").alias("n"))


def day_provenance(published: DataFrame) -> DataFrame:
    """Per day: rows, the runs that wrote them, and the price span (shows a replaced day)."""
    return (
        published.groupBy("dt")
        .agg(
            F.count("*").alias("row_count"),
            F.sort_array(F.collect_set("run_id")).alias("run_ids"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
        )
        .orderBy("dt")
    )


def daily_users(published: DataFrame) -> DataFrame:
    """The users of each day as bitmaps: (``dt``, ``bucket``, ``users``), one row per day and 32,768
    neighbouring user numbers.

    A stored table of these answers for distinct users over any days without reading events; a day
    that is published again replaces its own rows.  Bitmaps combine on the map side.  They are small
    where user numbers are dense; text or hashed users want a numbering first.  Rows without a user
    or day do not count.
    """
    user = F.col("user_id")
    return (
        published.filter(user.isNotNull() & F.col("dt").isNotNull())
        .groupBy("dt", F.bitmap_bucket_number(user).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("users"))
    )


def rolling_users(daily: DataFrame, days: int = 7) -> DataFrame:
    """Exact distinct users of the ``days`` days up to and including each day, from ``daily_users``.

    One row per calendar day from the first day to the last, also for days without rows.  A bitmap
    takes part in ``days`` windows; those are merged on the map side first.
    """
    if days < 1:
        raise ValueError("a window has one day or more")
    bounds = daily.agg(F.min("dt").alias("_first"), F.max("dt").alias("_last"))
    first, last = bounds.first()
    if first is None:
        return daily.select("dt", F.lit(0).cast("long").alias("users"))
    end = F.to_date(F.lit(last))
    windows = F.sequence(F.to_date("dt"), F.least(F.date_add(F.to_date("dt"), days - 1), end))
    merged = (
        daily.select(F.explode(windows).alias("_day"), "bucket", "users")
        .groupBy("_day", "bucket")
        .agg(F.bitmap_or_agg("users").alias("users"))
    )
    counted = merged.groupBy("_day").agg(F.sum(F.bitmap_count("users")).alias("_users"))
    calendar = daily.sparkSession.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(first)), end)).alias("_each")
    )
    return calendar.join(F.broadcast(counted), F.col("_each") == F.col("_day"), "left").select(
        F.col("_each").cast("string").alias("dt"), F.coalesce("_users", F.lit(0)).cast("long").alias("users")
    )
