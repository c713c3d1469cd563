"""Seismic raw rows derived from the driver's ``events`` table.

The driver ships no seismic data, so every query starts from this projection of
``events(event_id, ts, user_id, event_type, value, props)``: each event becomes one
feed record with the raw table's 27 feed columns (plus audit stamps). The DuckDB
oracle (``epicentre.plans.oracle``) spells the same mapping in its dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epicentre.params import RunParams
from epicentre.schemas import RAW_COLUMNS, RAW_FIELDS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Spark SQL for each raw column; `k`, `ms` and `site` are defined in _base().
_RAW_EXPR = {
    "event_id": "concat('ev', cast(event_id as string))",
    "magnitude": "case when event_id % 97 = 0 then null when value >= 228 then cast(9.5 as double)"
    " else cast(floor(value / 6) as double) / 4 end",
    "mag_type": "case when event_id % 2 = 0 then 'ml' else 'mb' end",
    "place": "case when event_id % 41 = 0 then null when event_id % 10 = 1 then site"
    " when event_id % 10 = 2 then concat('north of Gulf of ', site)"
    " else concat(cast(k as string), ' km NNE of  ', site, ' ') end",
    "event_time": "case when event_id % 89 = 0 then null else ms end",
    "updated_time": "ms + user_id * 3600000",
    "timezone_offset": "cast(null as int)",
    "felt_reports": "case when event_id % 3 = 0 then null else k end",
    "cdi": "case when event_id % 3 = 0 then null else cast(k % 40 as double) / 4 end",
    "mmi": "case when event_id % 7 = 0 then null else cast(k % 36 as double) / 4 end",
    "alert_level": "case when event_id % 4 = 0 then 'green' when event_id % 31 = 0 then 'red' else null end",
    "status": "case when event_id % 2 = 0 then 'reviewed' else 'automatic' end",
    "tsunami_flag": "case when event_id % 29 = 0 then 1 when event_id % 23 = 0 then null else 0 end",
    "significance": "case when event_id % 5 = 0 then null else k * 10 end",
    "network": "substring(event_type, 1, 2)",
    "event_code": "cast(event_id as string)",
    "num_stations": "case when event_id % 11 = 0 then null else cast(event_id % 120 as int) end",
    "distance": "cast(k as double) / 4",
    "rms": "cast(k % 8 as double) / 4",
    "gap": "cast(event_id % 360 as double)",
    "event_type": "case when event_id % 13 = 0 then 'quarry blast' else 'earthquake' end",
    "title": "concat('Event ', cast(event_id as string))",
    "longitude": "cast((event_id * 104729) % 1441 as double) / 4 - 180",
    "latitude": "case when event_id % 101 = 0 then null else cast((event_id * 7919) % 721 as double) / 4 - 90 end",
    "depth_km": "case when event_id % 53 = 0 then null else cast((event_id * 37) % 2800 as double) / 4 end",
    "detail_url": "concat('https://example.com/event/', cast(event_id as string))",
}


def _base(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.expr("cast(get_json_object(props, '$.k') as int)").alias("k"),
        # whole seconds since the epoch, in ms, zone-free
        F.expr("cast(cast((ts - timestamp_ntz'1970-01-01 00:00:00') as interval second) as bigint) * 1000").alias("ms"),
        F.expr("concat('SITE_', cast(user_id * 7 + event_id % 7 as string))").alias("site"),
    )


def raw_from_events(events: DataFrame, params: RunParams) -> DataFrame:
    """29 raw columns; ingest/created/updated stamps all equal ``params.run_ts``."""
    base = _base(events)
    types = dict(RAW_FIELDS)
    cols = [F.expr(_RAW_EXPR[c]).cast(types[c]).alias(c) for c in RAW_COLUMNS[:26]]
    stamp = params.run_ts_col()
    cols += [stamp.alias("ingested_at"), stamp.alias("created_at"), stamp.alias("updated_at")]
    return base.select(*cols)


def feed_from_events(events: DataFrame, params: RunParams) -> DataFrame:
    """The 27 feed columns (what a flattened snapshot carries)."""
    return raw_from_events(events, params).drop("created_at", "updated_at")


def load_raw(spark: SparkSession, sf_dir: str, params: RunParams) -> DataFrame:
    return raw_from_events(read_table(spark, sf_dir, "events"), params)


# Two overlapping snapshots, as consecutive polls of a rolling feed see them.
# Snapshot A holds events before 2024-01-21 (and those without an
# origin time); snapshot B holds events from 2024-01-11 on. In the ten overlapping
# days B carries a revision chosen by the event's network: newer updates for
# 'cl' and 'vi', stale repeats (1 s older) for 'er', slightly late updates (1 s
# newer) for 'pu', unchanged repeats for 'si'. Together they hold every event.
A_BEFORE_MS = 1705795200000  # 2024-01-21 00:00:00 UTC
B_FROM_MS = 1704931200000  # 2024-01-11 00:00:00 UTC
NEWER_NETWORKS, STALE_NETWORK, LATE_NETWORK = ("cl", "vi"), "er", "pu"
C_FROM_MS = 1706227200000  # 2024-01-26 00:00:00 UTC
_REVISION_MS = 8_640_000_000  # 100 days, in ms


def batch_a(feed: DataFrame) -> DataFrame:
    return feed.filter(F.coalesce(F.col("event_time"), F.lit(0)) < A_BEFORE_MS)


def batch_b(feed: DataFrame) -> DataFrame:
    overlap = F.col("event_time") < A_BEFORE_MS
    net = F.col("network")
    is_upd = overlap & net.isin(*NEWER_NETWORKS)
    is_stale = overlap & (net == STALE_NETWORK)
    is_late = overlap & (net == LATE_NETWORK)
    mag, upd = F.col("magnitude"), F.col("updated_time")
    return feed.filter(F.col("event_time") >= B_FROM_MS).withColumns(
        {
            "magnitude": F.when(is_upd, mag + 0.5).when(is_stale, mag + 1.0).when(is_late, mag + 0.25)
            .otherwise(mag),
            "depth_km": F.when(is_upd, F.col("depth_km") + 10).otherwise(F.col("depth_km")),
            "status": F.when(is_upd, F.lit("reviewed")).otherwise(F.col("status")),
            "updated_time": F.when(is_upd, upd + _REVISION_MS).when(is_stale, upd - 1000)
            .when(is_late, upd + 1000).otherwise(upd),
        }
    )


def batch_c(feed: DataFrame) -> DataFrame:
    """A third snapshot: the events from 2024-01-26 on, those of one network updated past any revision above."""
    late = F.col("network") == LATE_NETWORK
    return feed.filter(F.col("event_time") >= C_FROM_MS).withColumns({
        "magnitude": F.when(late, F.col("magnitude") + 0.25).otherwise(F.col("magnitude")),
        "updated_time": F.when(late, F.col("updated_time") + 2 * _REVISION_MS).otherwise(F.col("updated_time"))})


def flawed_raw(raw: DataFrame) -> DataFrame:
    """Every 40th event twice, and titles and magnitude types of every 30th far past their declared length."""
    number = F.col("event_code").cast("bigint")
    long = number % 30 == 0
    flawed = raw.withColumns({
        "title": F.when(long, F.repeat("title", 200)).otherwise(F.col("title")),
        "mag_type": F.when(long, F.repeat("mag_type", 6)).otherwise(F.col("mag_type"))})
    return flawed.unionByName(flawed.filter(number % 40 == 0))
