"""Fact table and the three aggregate marts.

Each grouping has a map-side partial step, so a hot group key costs one partial row per task
in the shuffle, not its rows. Daily and regional marts first count cells of one magnitude, so
that exact percentiles rank counts (``ranks``) and no buffer grows with the values of a group;
the regional cells can also come from a maintained table of parts (``maintained``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epicentre.functions import (
    capped_risk_score,
    day_name,
    max_magnitude_points,
    risk_category,
)
from epicentre.operators.ranks import percentile, stddev_samp, with_ranks
from epicentre.params import RunParams
from epicentre.schemas import FACT_COLUMNS

# The marts' "significant" threshold and the other magnitude cut-offs.
SIGNIFICANT_MAG, STRONG_MAG, MAJOR_MAG = 4.0, 5.0, 6.0
# Risk-score weights.
W_FREQUENCY, W_AVG_MAG, W_LAST_30, W_TSUNAMI = 10, 5, 0.5, 15


def fct_events(stg: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Fact projection (31 of staging's 36 columns), and any further ones of staging."""
    return stg.select(*FACT_COLUMNS, *more)


def _mag(x: float):
    return F.count_if(F.col("magnitude") >= x)


def _sum_count(name: str) -> list[Column]:
    return [F.sum(name).alias(f"{name}_sum"), F.count(name).alias(f"{name}_n")]


def _mean(name: str) -> Column:
    return F.sum(f"{name}_sum").cast("double") / F.nullif(F.sum(f"{name}_n"), F.lit(0))


def _at_least(x: float) -> Column:
    return F.coalesce(F.sum(F.when(F.col("magnitude") >= x, F.col("n"))), F.lit(0))


def _mean_magnitude() -> Column:
    known = F.when(F.col("magnitude").isNotNull(), F.col("n"))
    return F.sum(F.col("magnitude") * F.col("n")) / F.nullif(F.sum(known), F.lit(0))


def daily_summary(fct: DataFrame, params: RunParams, more: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per date, 25 measures; ``more`` adds named counts (or other sums)."""
    cat, depth, more = F.col("magnitude_category"), F.col("depth_category"), more or {}
    counts = {f"{c}_count": cat == c for c in ("micro", "minor", "light", "moderate", "strong", "major", "great")}
    counts |= {f"{c}_count": depth == c for c in ("shallow", "intermediate", "deep")}
    counts |= {"tsunami_warnings": F.col("has_tsunami_warning"), "reviewed_count": F.col("status") == "reviewed"}
    cells = fct.groupBy(F.col("event_date").alias("summary_date"), "magnitude").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(c).alias(n) for n, c in counts.items()],
        *_sum_count("depth_km"),
        F.max("depth_km").alias("max_depth_km"),
        F.sum(F.coalesce(F.col("felt_reports"), F.lit(0))).alias("total_felt_reports"),
        F.sum(F.coalesce(F.col("significance"), F.lit(0))).alias("significance"),
        *_sum_count("station_count"),
        *[c.alias(n) for n, c in more.items()],
    )
    stats = with_ranks(cells, "summary_date", "magnitude").groupBy("summary_date").agg(
        F.sum("n").alias("total_earthquakes"),
        _at_least(SIGNIFICANT_MAG).alias("significant_earthquakes"),
        _at_least(STRONG_MAG).alias("strong_earthquakes"),
        _mean_magnitude().alias("avg_magnitude"),
        F.max("magnitude").alias("max_magnitude"),
        F.min("magnitude").alias("min_magnitude"),
        stddev_samp("magnitude").alias("stddev_magnitude"),
        percentile("magnitude", 0.5).alias("median_magnitude"),
        _mean("depth_km").alias("avg_depth_km"),
        F.max("max_depth_km").alias("max_depth_km"),
        F.sum("total_felt_reports").alias("total_felt_reports"),
        (F.sum("significance").cast("double") / F.sum("n")).alias("avg_significance"),
        _mean("station_count").alias("avg_station_count"),
        *[F.sum(n).alias(n) for n in (*counts, *more)],
    )
    return stats.select(
        "summary_date", "total_earthquakes", "significant_earthquakes", "strong_earthquakes", "tsunami_warnings",
        "avg_magnitude", "max_magnitude", "min_magnitude", "stddev_magnitude", "median_magnitude",
        "avg_depth_km", "max_depth_km", "total_felt_reports", "avg_significance",
        "micro_count", "minor_count", "light_count", "moderate_count", "strong_count", "major_count", "great_count",
        "shallow_count", "intermediate_count", "deep_count", "avg_station_count", "reviewed_count",
        *more, params.run_ts_col().alias("dbt_updated_at"),
    )


def region_cells(fct: DataFrame, params: RunParams) -> DataFrame:
    """Counts and sums for each region and magnitude; regions present only."""
    as_of = params.as_of_col()
    date = F.col("event_date")
    return fct.filter(F.col("region").isNotNull()).groupBy("region", "magnitude").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(date >= F.date_sub(as_of, 30)).alias("n_30"),
        F.count_if(date >= F.date_sub(as_of, 7)).alias("n_7"),
        *_sum_count("depth_km"),
        F.sum(F.coalesce(F.col("felt_reports"), F.lit(0))).cast("bigint").alias("felt"),
        F.count_if(F.col("has_tsunami_warning")).alias("tsunami"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        *_sum_count("latitude"),
        *_sum_count("longitude"),
    )


def regional_stats(fct: DataFrame, params: RunParams) -> DataFrame:
    """Per-region statistics (17 measures); regions present only."""
    return stats_of_cells(region_cells(fct, params))


def stats_of_cells(cells: DataFrame) -> DataFrame:
    """The regional statistics from the cells of ``region_cells``."""
    stats = with_ranks(cells, "region", "magnitude").groupBy("region").agg(
        F.sum("n").alias("total_earthquakes"),
        F.sum("n_30").alias("earthquakes_last_30_days"),
        F.sum("n_7").alias("earthquakes_last_7_days"),
        _mean_magnitude().alias("avg_magnitude"),
        F.max("magnitude").alias("max_magnitude"),
        percentile("magnitude", 0.95).alias("p95_magnitude"),
        _at_least(SIGNIFICANT_MAG).alias("significant_events"),
        _at_least(STRONG_MAG).alias("strong_events"),
        _at_least(MAJOR_MAG).alias("major_events"),
        _mean("depth_km").alias("avg_depth_km"),
        F.sum("felt").alias("total_felt_reports"),
        F.sum("tsunami").alias("tsunami_warnings"),
        F.min("first_date").alias("first_event_date"),
        F.max("last_date").alias("last_event_date"),
        _mean("latitude").alias("centroid_latitude"),
        _mean("longitude").alias("centroid_longitude"),
    )
    days = (F.datediff("last_event_date", "first_event_date") + 1).cast("bigint")
    return stats.withColumn("days_with_data", days).select(
        "region", "total_earthquakes", "earthquakes_last_30_days", "earthquakes_last_7_days",
        "avg_magnitude", "max_magnitude", "p95_magnitude", "significant_events",
        "strong_events", "major_events", "avg_depth_km", "total_felt_reports",
        "tsunami_warnings", "first_event_date", "last_event_date", "days_with_data",
        "centroid_latitude", "centroid_longitude",
    )


def regional_risk(fct: DataFrame, params: RunParams) -> DataFrame:
    """Regional statistics plus frequency, raw and capped risk score, category."""
    return risk_of_stats(regional_stats(fct, params), params)


def risk_of_stats(stats: DataFrame, params: RunParams) -> DataFrame:
    """The risk mart from regional statistics."""
    freq = F.col("total_earthquakes").cast("double") / F.nullif(F.col("days_with_data"), F.lit(0))
    raw = (
        freq * W_FREQUENCY
        + F.col("avg_magnitude") * W_AVG_MAG
        + max_magnitude_points("max_magnitude")
        + F.col("earthquakes_last_30_days") * W_LAST_30
        + F.col("tsunami_warnings") * W_TSUNAMI
    )
    return (
        stats.withColumn("daily_frequency", freq)
        .withColumn("raw_risk_score", raw)
        .withColumn("risk_score", capped_risk_score("raw_risk_score"))
        .withColumn("risk_category", risk_category("raw_risk_score"))
        .withColumn("dbt_updated_at", params.run_ts_col())
    )


def hourly_heatmap(fct: DataFrame, params: RunParams) -> DataFrame:
    """Day-of-week x hour pattern (8 columns)."""
    agg = fct.groupBy("day_of_week", "event_hour").agg(
        F.count(F.lit(1)).alias("earthquake_count"),
        F.avg("magnitude").alias("avg_magnitude"),
        F.max("magnitude").alias("max_magnitude"),
        _mag(SIGNIFICANT_MAG).alias("significant_count"),
    )
    return named_heatmap(agg, params)


def named_heatmap(agg: DataFrame, params: RunParams) -> DataFrame:
    """The heatmap mart from its aggregates."""
    return agg.select(
        "day_of_week",
        "event_hour",
        day_name("day_of_week").alias("day_name"),
        "earthquake_count",
        "avg_magnitude",
        "max_magnitude",
        "significant_count",
        params.run_ts_col().alias("dbt_updated_at"),
    )
