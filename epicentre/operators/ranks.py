"""Exact percentiles and deviations of groups, from counts of values, without a buffer for each group.

Spark's exact percentile keeps every distinct value of a group in one buffer.  Here the counts
of a group's values are sorted by value (a sort that spills), running counts say which ranks
each value has, and the group's aggregate picks two of them.  What is sorted is one row for
each distinct value of a group, pre-aggregated before the shuffle, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_IN, _UPTO, _ALL, _MEAN = "__in", "__upto", "__all", "__mean"


def with_ranks(cells: DataFrame, by: str, value: str, n: str = "n") -> DataFrame:
    """``cells`` (``by``, ``value``, ``n`` and more) with the running counts of each group's values.

    ``percentile`` and ``stddev_samp`` are aggregates over this, grouped by ``by``.  A value may have several
    cells; null values have no rank.
    """
    order = Window.partitionBy(by).orderBy(F.col(value).asc_nulls_last())
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = cells.withColumn(_IN, F.when(F.col(value).isNotNull(), F.col(n)).otherwise(F.lit(0)).cast("bigint"))
    return d.withColumns({_UPTO: F.sum(_IN).over(running), _ALL: F.sum(_IN).over(whole), _MEAN: F.sum(F.col(value) * F.col(_IN)).over(whole)})


def percentile(value: str, p: float) -> Column:
    """PERCENTILE_CONT: between the values of the ranks floor and ceil of p * (count - 1)."""
    at = F.lit(float(p)) * (F.col(_ALL) - 1)
    pick = lambda r: F.max(F.when((F.col(_UPTO) - F.col(_IN) <= r) & (r < F.col(_UPTO)), F.col(value).cast("double")))
    low, high = pick(F.floor(at)), pick(F.ceil(at))
    part = F.max(at - F.floor(at))
    return F.when(low == high, low).otherwise((1 - part) * low + part * high)


def stddev_samp(value: str) -> Column:
    """Sample deviation around the group's mean; null for fewer than two values."""
    off = F.col(value).cast("double") - F.col(_MEAN) / F.col(_ALL)
    return F.sqrt(F.sum(F.col(_IN) * off * off) / F.nullif(F.max(_ALL) - 1, F.lit(0)))
