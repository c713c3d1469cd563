"""Staging view: typed, renamed, classified events (36 columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epicentre.functions import (
    day_of_week_sunday0,
    depth_category,
    epoch_ms_to_ntz,
    magnitude_category,
    region_from_place,
    tsunami_warning,
)
from epicentre.params import RunParams

# Rows must carry these; event_time is deliberately not required (null dates pass).
REQUIRED = ["event_id", "magnitude", "latitude", "longitude"]


def stg_events(raw: DataFrame, params: RunParams) -> DataFrame:
    kept = raw.filter(F.col("event_id").isNotNull() & F.col("magnitude").isNotNull()
                      & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    ts = epoch_ms_to_ntz("event_time")
    return kept.select(
        "event_id",
        "magnitude",
        "mag_type",
        magnitude_category("magnitude").alias("magnitude_category"),
        "place",
        "longitude",
        "latitude",
        "depth_km",
        depth_category("depth_km").alias("depth_category"),
        region_from_place("place").alias("region"),
        ts.alias("event_timestamp"),
        F.to_date(ts).alias("event_date"),
        F.hour(ts).alias("event_hour"),
        day_of_week_sunday0(ts).alias("day_of_week"),
        epoch_ms_to_ntz("updated_time").alias("updated_timestamp"),
        "status",
        "significance",
        F.col("num_stations").alias("station_count"),
        F.col("rms").alias("travel_time_residual"),
        F.col("gap").alias("azimuthal_gap"),
        F.col("distance").alias("nearest_station_distance"),
        "felt_reports",
        F.col("cdi").alias("community_intensity"),
        F.col("mmi").alias("mercalli_intensity"),
        "alert_level",
        "tsunami_flag",
        tsunami_warning("tsunami_flag").alias("has_tsunami_warning"),
        F.col("network").alias("source_network"),
        "event_type",
        "event_code",
        "title",
        "detail_url",
        "ingested_at",
        "created_at",
        "updated_at",
        params.run_ts_col().alias("dbt_updated_at"),
    )
