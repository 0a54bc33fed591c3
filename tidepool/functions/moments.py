"""Points in time without the driver's time zone."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(x: Column | datetime | int) -> Column:
    """A timestamp literal: wall time is read in the session's zone, microseconds since 1970 are exact."""
    if isinstance(x, Column):
        return x
    if isinstance(x, int):
        return F.timestamp_micros(F.lit(x))
    if x.tzinfo is not None:
        since = x - datetime(1970, 1, 1, tzinfo=timezone.utc)
        return F.timestamp_micros(F.lit((since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds))
    return F.lit(x.isoformat(sep=" ")).cast("timestamp")


def micros(x: Column) -> Column:
    """What ``moment`` takes back after a collect; a collected datetime would be in the driver's zone."""
    return F.unix_micros(x)
