"""Time expressions. All instants are UTC; text renderings use ``+00:00``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ssxxx"
# Strict comment timestamp as delivered by the video platform.
PLATFORM_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_to_utc(col) -> Column:
    """Epoch seconds (may be fractional) -> timestamp."""
    c = _c(col)
    return F.timestamp_seconds(c)


def parse_utc(col) -> Column:
    """Strict ``yyyy-MM-ddTHH:mm:ssZ`` parse; a bad value gives null
    (the row is then quarantined as ``bad_time``, siblings unaffected)."""
    return F.try_to_timestamp(_c(col), F.lit(PLATFORM_FORMAT))


def iso_utc(col) -> Column:
    """Render a timestamp as ISO-8601 with ``+00:00`` (session zone UTC)."""
    return F.date_format(_c(col), ISO_FORMAT)


def observed_at(ts: str | None = None) -> Column:
    """P5: one observation instant shared by all rows of a collection run.

    A fixed instant (ISO text) for batch runs; the micro-batch clock otherwise.
    """
    if ts is None:
        return F.current_timestamp()
    return F.to_timestamp(F.lit(ts))
