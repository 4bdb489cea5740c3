"""Time expressions shared by every operator: parse, shift to local time, day, week.

None of them depends on the session time zone.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats that stored data must keep.
RAW_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss 'UTC'"

_DAY_SECONDS = 86_400


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def utc_instant(clock: Column) -> Column:
    """The instant at which a UTC clock shows ``clock`` (a time without zone)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), clock))


def utc_clock(instant: Column) -> Column:
    """What a UTC clock shows at ``instant``, as a time without zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())


def utc_text(instant: Column) -> Column:
    """What a UTC clock shows, as text to the second."""
    return F.substring(utc_clock(instant).cast("string"), 1, 19)


def parse_event_time(text: Column, strict: bool = False) -> Column:
    """Instant of a raw time text, whose suffix is a literal.

    Bad text raises when ``strict`` (under ANSI mode), else becomes NULL for the reject list.
    """
    zoned, pattern = F.concat(text, F.lit("Z")), f"{RAW_TIME_PATTERN}XXX"
    if strict:
        return F.to_timestamp(zoned, pattern)
    return F.try_to_timestamp(zoned, F.lit(pattern))


def local_time(utc: Column, zone: str) -> Column:
    """Wall-clock time in ``zone``; for days and display, never for ordering or gaps."""
    return F.from_utc_timestamp(utc, zone)


def local_day(utc: Column, zone: str) -> Column:
    """Local calendar day as text, the value of the ``dt`` partition column."""
    seconds = F.unix_seconds(local_time(utc, zone))
    return F.date_from_unix_date(F.floor(seconds / _DAY_SECONDS).cast("int")).cast("string")


def day_start(day: str, zone: str) -> Column:
    """First instant of a local day: a constant, so a comparison with it reaches the scan."""
    midnight = F.timestamp_seconds(F.lit((date.fromisoformat(day) - date(1970, 1, 1)).days * _DAY_SECONDS))
    return F.to_utc_timestamp(midnight, zone)


def week_start(day: Column) -> Column:
    """Monday of the week that holds ``day`` (text or date)."""
    return F.trunc(F.to_date(day), "week")


def gap_in_seconds(earlier: Column, later: Column) -> Column:
    """Distance of two instants, each cut to its whole second first."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)
