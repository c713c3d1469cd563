"""Dashboard result sets: filtered, ranked, pivoted reads of the marts.

Every ``limit`` here is a top-k the dashboard shows; each sort ends in the key so
ties are deterministic. Descending sorts put nulls first, as the warehouse did.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epicentre.functions import MONDAY_FIRST, epoch_ms_to_ntz
from epicentre.params import RunParams

# Columns of the dashboard's event reads.
RECENT_COLUMNS = [
    "event_id", "event_timestamp", "event_date", "magnitude", "magnitude_category",
    "depth_km", "depth_category", "latitude", "longitude", "region", "place",
    "felt_reports", "significance", "has_tsunami_warning", "alert_level",
    "source_network", "status",
]

# Dashboard "significant" threshold and histogram bin count.
DASHBOARD_SIGNIFICANT_MAG = 5.0
HISTOGRAM_BINS = 30

# Column names of the dashboard's recent-events table.
RECENT_TABLE_NAMES = {
    "event_timestamp": "Time",
    "place": "Location",
    "magnitude": "Magnitude",
    "depth_km": "Depth (km)",
    "magnitude_category": "Category",
    "region": "Region",
    "has_tsunami_warning": "Tsunami Warning",
}


def recent_events(fct: DataFrame, params: RunParams, ordered: bool = True) -> DataFrame:
    """Events on or after as_of - days with magnitude >= min; newest first."""
    df = fct.filter(
        (F.col("event_date") >= F.date_sub(params.as_of_col(), params.days))
        & (F.col("magnitude") >= params.min_magnitude)
    ).select(*RECENT_COLUMNS)
    return df.orderBy(F.col("event_timestamp").desc_nulls_first(), "event_id") if ordered else df


def daily_lookback(daily: DataFrame, params: RunParams, ordered: bool = True) -> DataFrame:
    df = daily.filter(F.col("summary_date") >= F.date_sub(params.as_of_col(), params.days))
    return df.orderBy(F.col("summary_date").desc_nulls_first()) if ordered else df


def latest_daily(daily: DataFrame, n: int = 10) -> DataFrame:
    return daily.orderBy(F.col("summary_date").desc_nulls_first()).limit(n)


def top_risk(risk: DataFrame, n: int = 50) -> DataFrame:
    return risk.orderBy(F.col("risk_score").desc_nulls_first(), "region").limit(n)


def risk_bar(risk: DataFrame, n: int = 15) -> DataFrame:
    """The bar chart's rows: the first n regions of the ranked risk list."""
    return top_risk(risk, n).select("region", "risk_score", "risk_category")


def recent_table(fct: DataFrame, params: RunParams, n: int = 20) -> DataFrame:
    """The n newest events, seven columns under display names."""
    top = recent_events(fct, params).limit(n)
    return top.select(*[F.col(c).alias(name) for c, name in RECENT_TABLE_NAMES.items()])


def raw_latest(raw: DataFrame, n: int = 10) -> DataFrame:
    """Newest raw rows by event time, as the setup script's check query shows them."""
    return (
        raw.orderBy(F.col("event_time").desc_nulls_first(), "event_id")
        .limit(n)
        .select(
            "event_id",
            epoch_ms_to_ntz("event_time").alias("event_time"),
            "magnitude",
            "place",
            "latitude",
            "longitude",
        )
    )


def kpi_row(recent: DataFrame, params: RunParams) -> DataFrame:
    """Total, last-24h count, max and mean magnitude (0 when empty), count >= 5."""
    since = params.as_of_ts_col() - F.expr("INTERVAL 1 DAY")
    return recent.agg(
        F.count(F.lit(1)).alias("total_earthquakes"),
        F.count_if(F.col("event_timestamp") >= since).alias("last_24h"),
        F.coalesce(F.max("magnitude"), F.lit(0.0)).alias("max_magnitude"),
        F.coalesce(F.avg("magnitude"), F.lit(0.0)).alias("avg_magnitude"),
        F.count_if(F.col("magnitude") >= DASHBOARD_SIGNIFICANT_MAG).alias("significant_count"),
    )


def magnitude_histogram(recent: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts per (bin, magnitude_category): ``bins`` equal widths over [min, max].

    The last bin is closed; when min == max every row falls in bin 0. Rows are
    first counted per (magnitude, category) with a map-side partial step, so a
    magnitude holding a third of all rows costs one partial row per task; the
    bounds (one struct scalar subquery) and the binning then run on that small
    count table, which the subquery shares with the main plan (exchange reuse).
    """
    m = F.col("magnitude")
    counts = recent.filter(m.isNotNull()).groupBy("magnitude", "magnitude_category").agg(
        F.count(F.lit(1)).alias("n")
    )
    bounds = counts.select(F.struct(F.min(m).alias("lo"), F.max(m).alias("hi"))).scalar()
    # one subquery instance: attach it once, then refer to the column
    counts = counts.withColumn("__b", bounds)
    lo, hi = F.col("__b.lo"), F.col("__b.hi")
    raw_bin = F.floor((m - lo) * bins / (hi - lo)).cast("int")
    b = F.when(hi == lo, F.lit(0)).otherwise(F.least(raw_bin, F.lit(bins - 1)))
    binned = counts.groupBy(b.alias("bin"), "magnitude_category", "__b").agg(F.sum("n").alias("earthquake_count"))
    width = (hi - lo) / bins
    return binned.select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_start"),
        (lo + (F.col("bin") + 1) * width).alias("bin_end"),
        "magnitude_category",
        "earthquake_count",
    )


def map_points(recent: DataFrame) -> DataFrame:
    return recent.select("latitude", "longitude", "magnitude", "place", "depth_km", "event_timestamp")


def timeline(daily_window: DataFrame) -> DataFrame:
    return daily_window.select("summary_date", "total_earthquakes", "avg_magnitude")


def depth_points(recent: DataFrame) -> DataFrame:
    return recent.select("depth_km", "magnitude", "depth_category", "significance", "place")


def heatmap_pivot(heatmap: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Seven rows (Monday first) x 24 hour columns h00..h23; absent cells null.

    The 24 pivot values are pinned, so the shape does not depend on the data.
    """
    hours = list(range(24))
    pivoted = (
        heatmap.filter(F.col("day_name").isNotNull())
        .groupBy("day_name")
        .pivot("event_hour", hours)
        .agg(F.first("earthquake_count"))
    )
    pivoted = pivoted.select("day_name", *[F.col(str(h)).alias(f"h{h:02d}") for h in hours])
    spark = spark or heatmap.sparkSession
    days = spark.createDataFrame([(i, d) for i, d in enumerate(MONDAY_FIRST)], "day_order int, day_name string")
    # both sides hold at most eight rows
    return days.join(pivoted, "day_name", "left").select(
        "day_order", "day_name", *[f"h{h:02d}" for h in hours]
    )
