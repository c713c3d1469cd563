"""Table schemas and column lists (the contract between layers)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I, TS = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.TimestampNTZType()

# The raw table's columns, 27 from the feed + two audit stamps (29). event_id is the key.
RAW_FIELDS: list[tuple[str, T.DataType]] = [
    ("event_id", S),
    ("magnitude", D),
    ("mag_type", S),
    ("place", S),
    ("event_time", L),  # Unix milliseconds
    ("updated_time", L),  # Unix milliseconds
    ("timezone_offset", I),
    ("felt_reports", I),
    ("cdi", D),
    ("mmi", D),
    ("alert_level", S),
    ("status", S),
    ("tsunami_flag", I),
    ("significance", I),
    ("network", S),
    ("event_code", S),
    ("num_stations", I),
    ("distance", D),
    ("rms", D),
    ("gap", D),
    ("event_type", S),
    ("title", S),
    ("longitude", D),
    ("latitude", D),
    ("depth_km", D),
    ("detail_url", S),
    ("ingested_at", TS),
    ("created_at", TS),
    ("updated_at", TS),
]
RAW_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_FIELDS])
RAW_COLUMNS = [n for n, _ in RAW_FIELDS]
FEED_COLUMNS = RAW_COLUMNS[:27]  # what one flattened feature carries
# Columns a raw upsert rewrites when the source row is newer (all but key and ingest stamp).
RAW_UPDATE_COLUMNS = [c for c in FEED_COLUMNS if c not in ("event_id", "ingested_at")]

# Declared VARCHAR lengths of the raw table (checked by dq_length).
RAW_VARCHAR_LIMITS = {
    "event_id": 50,
    "mag_type": 10,
    "place": 500,
    "alert_level": 20,
    "status": 20,
    "network": 10,
    "event_code": 20,
    "event_type": 50,
    "title": 500,
    "detail_url": 1000,
}

# GeoJSON FeatureCollection as the feed serves it.
PROPERTIES_SCHEMA = T.StructType(
    [
        T.StructField("mag", D),
        T.StructField("place", S),
        T.StructField("time", L),
        T.StructField("updated", L),
        T.StructField("tz", I),
        T.StructField("felt", I),
        T.StructField("cdi", D),
        T.StructField("mmi", D),
        T.StructField("alert", S),
        T.StructField("status", S),
        T.StructField("tsunami", I),
        T.StructField("sig", I),
        T.StructField("net", S),
        T.StructField("code", S),
        T.StructField("nst", I),
        T.StructField("dmin", D),
        T.StructField("rms", D),
        T.StructField("gap", D),
        T.StructField("magType", S),
        T.StructField("type", S),
        T.StructField("title", S),
        T.StructField("detail", S),
    ]
)
FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("type", S),
        T.StructField("id", S),
        T.StructField("properties", PROPERTIES_SCHEMA),
        T.StructField(
            "geometry",
            T.StructType([T.StructField("type", S), T.StructField("coordinates", T.ArrayType(D))]),
        ),
    ]
)
FEATURE_COLLECTION_SCHEMA = T.StructType(
    [T.StructField("type", S), T.StructField("features", T.ArrayType(FEATURE_SCHEMA))]
)

# Feed property name for each raw column it fills (raw column -> properties field).
PROPERTY_OF = {
    "magnitude": "mag",
    "mag_type": "magType",
    "place": "place",
    "event_time": "time",
    "updated_time": "updated",
    "timezone_offset": "tz",
    "felt_reports": "felt",
    "cdi": "cdi",
    "mmi": "mmi",
    "alert_level": "alert",
    "status": "status",
    "tsunami_flag": "tsunami",
    "significance": "sig",
    "network": "net",
    "event_code": "code",
    "num_stations": "nst",
    "distance": "dmin",
    "rms": "rms",
    "gap": "gap",
    "event_type": "type",
    "title": "title",
    "detail_url": "detail",
}
# coordinates[i] -> raw column
COORDINATE_COLUMNS = ["longitude", "latitude", "depth_km"]

# The staging view's and the fact's columns, in their order.
STAGING_COLUMNS = [
    "event_id", "magnitude", "mag_type", "magnitude_category", "place", "longitude",
    "latitude", "depth_km", "depth_category", "region", "event_timestamp", "event_date",
    "event_hour", "day_of_week", "updated_timestamp", "status", "significance",
    "station_count", "travel_time_residual", "azimuthal_gap", "nearest_station_distance",
    "felt_reports", "community_intensity", "mercalli_intensity", "alert_level",
    "tsunami_flag", "has_tsunami_warning", "source_network", "event_type", "event_code",
    "title", "detail_url", "ingested_at", "created_at", "updated_at", "dbt_updated_at",
]

FACT_COLUMNS = [
    "event_id", "event_date", "region", "magnitude_category", "depth_category",
    "source_network", "event_type", "status", "magnitude", "depth_km", "latitude",
    "longitude", "significance", "station_count", "travel_time_residual", "azimuthal_gap",
    "nearest_station_distance", "felt_reports", "community_intensity", "mercalli_intensity",
    "alert_level", "has_tsunami_warning", "event_timestamp", "event_hour", "day_of_week",
    "updated_timestamp", "place", "title", "detail_url", "ingested_at", "dbt_updated_at",
]

# The only fact columns an incremental run rewrites for an already known event.
FACT_MERGE_UPDATE_COLUMNS = [
    "magnitude", "updated_timestamp", "status", "felt_reports", "community_intensity",
    "alert_level", "dbt_updated_at",
]
