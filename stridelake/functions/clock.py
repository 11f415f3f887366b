"""Timestamps as numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970; timestamps without a zone count in the session's."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def seconds(ts: str | Column) -> Column:
    """Seconds since 1970, with fractions."""
    return micros(ts) / F.lit(1e6)
