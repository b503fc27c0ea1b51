"""Time expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(col: str | Column) -> Column:
    """Whole seconds since 1970 of a DATE or TIMESTAMP_NTZ, rounded down.

    Built from the calendar fields: a difference of timestamps would pass through the session
    zone and its clock changes.
    """
    at = (F.col(col) if isinstance(col, str) else col).cast("timestamp_ntz")
    days = F.unix_date(at.cast("date")).cast("bigint")
    return days * 86_400 + F.hour(at) * 3_600 + F.minute(at) * 60 + F.second(at)


def time_slice(seconds_col: str | Column, width: float) -> Column:
    """Number of the ``width``-wide slice that a number (epoch seconds, say) falls in."""
    col = F.col(seconds_col) if isinstance(seconds_col, str) else seconds_col
    return F.floor(col / width).cast("bigint")
