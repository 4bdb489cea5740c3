"""Stable session identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gapwise.functions.timeops import utc_text


def session_id(user: Column, start_utc: Column) -> Column:
    """SHA-256 hex over user and session start to the second.

    The running session number is no part of it, so reading more history renames a session only
    when it really moves the session's start.  A NULL user is skipped by ``concat_ws``.
    """
    return F.sha2(F.concat_ws("|", user.cast("string"), utc_text(start_utc)), 256)
