"""Run parameters. Library code never reads the wall clock; callers pass these."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunParams:
    """Explicit dates for one build or one dashboard read.

    ``as_of`` stands for CURRENT_DATE, ``as_of_ts`` for the clock the dashboard's
    "last 24 hours" compares against, ``run_ts`` for CURRENT_TIMESTAMP()/now()
    in audit stamps.
    """

    as_of: dt.date
    as_of_ts: dt.datetime
    run_ts: dt.datetime
    days: int = 30  # dashboard look-back slider (1..365)
    min_magnitude: float = 2.0  # dashboard magnitude slider (0..7)

    @classmethod
    def at(cls, now: dt.datetime, **sliders) -> "RunParams":
        """All three dates from one reading of the clock."""
        return cls(now.date(), now, now, **sliders)

    def as_of_col(self) -> Column:
        return F.lit(self.as_of).cast("date")

    def as_of_ts_col(self) -> Column:
        return ts_lit(self.as_of_ts)

    def run_ts_col(self) -> Column:
        return ts_lit(self.run_ts)

    def with_run_ts(self, run_ts: dt.datetime) -> "RunParams":
        """The same dates with another audit stamp."""
        return replace(self, run_ts=run_ts)


def ts_lit(value: dt.datetime) -> Column:
    """A zone-free timestamp literal (TIMESTAMP_NTZ)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
