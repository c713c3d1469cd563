"""Zone-free time conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_ms_to_ntz(ms: Column | str) -> Column:
    """Unix milliseconds -> TIMESTAMP_NTZ, keeping the milliseconds.

    Independent of ``spark.sql.session.timeZone`` (a cast of timestamp_millis to
    NTZ would shift by the session zone).
    """
    return F.timestamp_add("MILLISECOND", F.col(ms) if isinstance(ms, str) else ms, _epoch())


def day_of_week_sunday0(ts: Column | str) -> Column:
    """0 = Sunday ... 6 = Saturday (Spark's dayofweek starts at 1)."""
    return F.dayofweek(ts) - 1
