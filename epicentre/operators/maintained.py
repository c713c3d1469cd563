"""Aggregates kept up to date by the rows that changed.

A table of parts holds counts and sums for each (region, date, magnitude), another one for each
(weekday, hour, magnitude).  A change of the fact adds the parts of its new rows and takes off
those of the rows they replace; maxima, percentiles and the counts of the last 30 and 7 days
come from parts whose count isn't zero.  Sums are decimals, so what is taken off is exactly what
was added.  The marts built from parts equal those rebuilt from the whole fact.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epicentre.operators.marts import SIGNIFICANT_MAG, named_heatmap, risk_of_stats, stats_of_cells
from epicentre.params import RunParams

#: Digits after the point that a sum keeps of each value.
EXACT = "decimal(38,9)"


@dataclass(frozen=True)
class Parts:
    """``keys`` name a part; ``measures`` give what one row adds to it."""

    keys: tuple[str, ...]
    measures: tuple[str, ...]

    def of(self, rows: DataFrame, sign: int = 1) -> DataFrame:
        """part, keys and measures of these rows, each counted ``sign`` times."""
        made = [F.sum(F.lit(sign) * m).alias(n) for n, m in _measures(self.measures).items()]
        return rows.groupBy(*self.keys).agg(*made).withColumn("part", self.name())

    def name(self) -> Column:
        """One text for the keys, null apart from any value."""
        return F.to_json(F.array(*[F.coalesce(F.to_json(F.array(F.col(k).cast("string"))), F.lit("")) for k in self.keys]))

    def changed(self, stored: DataFrame, new: DataFrame, old: DataFrame) -> DataFrame:
        """The new state of the parts that fact rows ``new`` enter and ``old`` leave."""
        delta = self.of(new).unionByName(self.of(old, -1)).groupBy("part", *self.keys).agg(*[F.sum(m).alias(m) for m in self.measures])
        delta = delta.where(" or ".join(f"{m} <> 0" for m in self.measures))
        hits = stored.join(delta.select("part"), "part", "left_semi").select("part", *[F.col(m).alias(f"__{m}") for m in self.measures])
        both = delta.join(hits, "part", "left")
        kinds = dict(stored.dtypes)
        sums = [(F.col(m) + F.coalesce(F.col(f"__{m}"), F.lit(0))).cast(kinds[m]).alias(m) for m in self.measures]
        return both.select("part", *self.keys, *sums)


def _measures(names: tuple[str, ...]) -> Mapping[str, Column]:
    def total(c: str) -> Column:
        return F.coalesce(F.col(c).cast(EXACT), F.lit(0).cast(EXACT))

    def known(c: str) -> Column:
        return F.col(c).isNotNull().cast("bigint")

    every = {
        "n": F.lit(1).cast("bigint"),
        "felt": F.coalesce(F.col("felt_reports"), F.lit(0)).cast("bigint"),
        "tsunami": F.coalesce(F.col("has_tsunami_warning"), F.lit(False)).cast("bigint"),
    }
    for c in ("depth_km", "latitude", "longitude"):
        every |= {f"{c}_sum": total(c), f"{c}_n": known(c)}
    return {n: every[n] for n in names}


REGION_PARTS = Parts(
    ("region", "event_date", "magnitude"),
    ("n", "felt", "tsunami", "depth_km_sum", "depth_km_n", "latitude_sum", "latitude_n", "longitude_sum", "longitude_n"))
HOUR_PARTS = Parts(("day_of_week", "event_hour", "magnitude"), ("n",))


def risk_from_parts(parts: DataFrame, params: RunParams) -> DataFrame:
    """The regional risk mart from REGION_PARTS."""
    as_of, date, n = params.as_of_col(), F.col("event_date"), F.col("n")
    since = lambda days: F.coalesce(F.sum(F.when(date >= F.date_sub(as_of, days), n)), F.lit(0))
    cells = parts.where((n > 0) & F.col("region").isNotNull()).groupBy("region", "magnitude").agg(
        F.sum("n").alias("n"), since(30).alias("n_30"), since(7).alias("n_7"), F.min(date).alias("first_date"), F.max(date).alias("last_date"),
        *[F.sum(m).alias(m) for m in REGION_PARTS.measures if m != "n"])
    return risk_of_stats(stats_of_cells(cells), params)


def heatmap_from_parts(parts: DataFrame, params: RunParams) -> DataFrame:
    """The weekday and hour mart from HOUR_PARTS."""
    n, mag = F.col("n"), F.col("magnitude")
    agg = parts.where(n > 0).groupBy("day_of_week", "event_hour").agg(
        F.sum(n).alias("earthquake_count"),
        (F.sum(mag * n) / F.nullif(F.sum(F.when(mag.isNotNull(), n)), F.lit(0))).alias("avg_magnitude"),
        F.max(mag).alias("max_magnitude"),
        F.coalesce(F.sum(F.when(mag >= SIGNIFICANT_MAG, n)), F.lit(0)).alias("significant_count"),
    )
    return named_heatmap(agg, params)
