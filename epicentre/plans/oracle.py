"""DuckDB SQL for every catalog query, derived anew from the written definitions.

Views ``events`` etc. are pre-registered by the checker. Each statement rebuilds the chain
events -> raw -> staging -> fact -> marts, so a Spark result is compared with a second engine
from the same input. Classes come from sorted bounds, dates from integer arithmetic on the
epoch, conditional counts and averages from the lists below, percentiles from ordered ranks;
none of it follows the Spark expressions.
"""

from __future__ import annotations


def _ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


# The catalog's stamps and dashboard settings.
TS0, TS1, TS2, TS3 = map(_ts, ("2024-01-30 23:00:00", "2024-01-31 00:00:00", "2024-01-31 00:05:00", "2024-01-31 00:10:00"))
CHAIN = [_ts("2024-01-31 23:55:00"), _ts("2024-02-01 00:05:00"), _ts("2024-02-20 00:00:00")]
AS_OF, DAYS, MIN_MAG = "DATE '2024-01-31'", 30, 2.0

# Lower bounds of the classes and their names; a class takes its lower bound.
MAGNITUDE_CLASSES = ([2.0, 4.0, 5.0, 6.0, 7.0, 8.0], ["micro", "minor", "light", "moderate", "strong", "major", "great"])
DEPTH_CLASSES = ([70, 300], ["shallow", "intermediate", "deep"])
RISK_CLASSES = ([10, 25, 50], ["minimal", "low", "moderate", "high"])
RISK_POINTS = ([4.0, 5.0, 6.0], [1, 5, 10, 20])
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# Columns in the order of the contract. Staging: name, or name and its raw name.
FEED_COLS = [
    "event_id", "magnitude", "mag_type", "place", "event_time", "updated_time",
    "timezone_offset", "felt_reports", "cdi", "mmi", "alert_level", "status",
    "tsunami_flag", "significance", "network", "event_code", "num_stations", "distance",
    "rms", "gap", "event_type", "title", "longitude", "latitude", "depth_km", "detail_url",
    "ingested_at",
]
UPDATE_COLS = [c for c in FEED_COLS if c not in ("event_id", "ingested_at")]
RENAMED = {
    "station_count": "num_stations", "travel_time_residual": "rms", "azimuthal_gap": "gap",
    "nearest_station_distance": "distance", "community_intensity": "cdi", "mercalli_intensity": "mmi",
    "source_network": "network",
}
UNCHANGED = [
    "event_id", "magnitude", "mag_type", "place", "longitude", "latitude", "depth_km", "status", "significance",
    "felt_reports", "alert_level", "tsunami_flag", "event_type", "event_code", "title", "detail_url",
    "ingested_at", "created_at", "updated_at",
]
REQUIRED = ["event_id", "magnitude", "latitude", "longitude"]
FACT_COLS = [
    "event_id", "event_date", "region", "magnitude_category", "depth_category", "source_network", "event_type",
    "status", "magnitude", "depth_km", "latitude", "longitude", "significance", "station_count",
    "travel_time_residual", "azimuthal_gap", "nearest_station_distance", "felt_reports",
    "community_intensity", "mercalli_intensity", "alert_level", "has_tsunami_warning", "event_timestamp",
    "event_hour", "day_of_week", "updated_timestamp", "place", "title", "detail_url", "ingested_at", "dbt_updated_at",
]
FACT_MERGED = ["magnitude", "updated_timestamp", "status", "felt_reports", "community_intensity", "alert_level", "dbt_updated_at"]
RECENT_COLS = [
    "event_id", "event_timestamp", "event_date", "magnitude", "magnitude_category", "depth_km", "depth_category",
    "latitude", "longitude", "region", "place", "felt_reports", "significance", "has_tsunami_warning", "alert_level",
    "source_network", "status",
]

# What the marts count, average and bound.
DAILY_COUNTS = {
    "total_earthquakes": "true", "significant_earthquakes": "magnitude >= 4", "strong_earthquakes": "magnitude >= 5",
    "tsunami_warnings": "has_tsunami_warning", "reviewed_count": "status = 'reviewed'",
    **{f"{c}_count": f"magnitude_category = '{c}'" for c in MAGNITUDE_CLASSES[1]},
    **{f"{c}_count": f"depth_category = '{c}'" for c in DEPTH_CLASSES[1]},
}
DAILY_MEANS = {"avg_magnitude": "magnitude", "avg_depth_km": "depth_km", "avg_significance": "ifnull(significance, 0)", "avg_station_count": "station_count"}
DAILY_BOUNDS = {"max_magnitude": "max(magnitude)", "min_magnitude": "min(magnitude)", "max_depth_km": "max(depth_km)"}
REGION_COUNTS = {
    "total_earthquakes": "true", "earthquakes_last_30_days": "event_date >= {day} - 30", "earthquakes_last_7_days": "event_date >= {day} - 7",
    "significant_events": "magnitude >= 4", "strong_events": "magnitude >= 5", "major_events": "magnitude >= 6",
    "tsunami_warnings": "has_tsunami_warning",
}
REGION_MEANS = {"avg_magnitude": "magnitude", "avg_depth_km": "depth_km", "centroid_latitude": "latitude", "centroid_longitude": "longitude"}
REGION_BOUNDS = {"max_magnitude": "max(magnitude)", "first_event_date": "min(event_date)", "last_event_date": "max(event_date)"}


def feed_sql(stamp: str = TS1) -> str:
    return f"""
    SELECT
      'ev' || cast(event_id AS varchar) AS event_id,
      CASE WHEN event_id % 97 = 0 THEN NULL WHEN value >= 228 THEN cast(9.5 AS double)
           ELSE cast(floor(value / 6) AS double) / 4 END AS magnitude,
      CASE WHEN event_id % 2 = 0 THEN 'ml' ELSE 'mb' END AS mag_type,
      CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 10 = 1 THEN site
           WHEN event_id % 10 = 2 THEN concat('north of Gulf of ', site)
           ELSE concat(cast(k AS varchar), ' km NNE of  ', site, ' ') END AS place,
      CASE WHEN event_id % 89 = 0 THEN NULL ELSE ms END AS event_time,
      ms + user_id * 3600000 AS updated_time,
      cast(NULL AS integer) AS timezone_offset,
      CASE WHEN event_id % 3 = 0 THEN NULL ELSE k END AS felt_reports,
      CASE WHEN event_id % 3 = 0 THEN NULL ELSE cast(k % 40 AS double) / 4 END AS cdi,
      CASE WHEN event_id % 7 = 0 THEN NULL ELSE cast(k % 36 AS double) / 4 END AS mmi,
      CASE WHEN event_id % 4 = 0 THEN 'green' WHEN event_id % 31 = 0 THEN 'red' ELSE NULL END AS alert_level,
      CASE WHEN event_id % 2 = 0 THEN 'reviewed' ELSE 'automatic' END AS status,
      CASE WHEN event_id % 29 = 0 THEN 1 WHEN event_id % 23 = 0 THEN NULL ELSE 0 END AS tsunami_flag,
      CASE WHEN event_id % 5 = 0 THEN NULL ELSE k * 10 END AS significance,
      substring(event_type, 1, 2) AS network,
      cast(event_id AS varchar) AS event_code,
      CASE WHEN event_id % 11 = 0 THEN NULL ELSE cast(event_id % 120 AS integer) END AS num_stations,
      cast(k AS double) / 4 AS distance,
      cast(k % 8 AS double) / 4 AS rms,
      cast(event_id % 360 AS double) AS gap,
      CASE WHEN event_id % 13 = 0 THEN 'quarry blast' ELSE 'earthquake' END AS event_type,
      'Event ' || cast(event_id AS varchar) AS title,
      cast((event_id * 104729) % 1441 AS double) / 4 - 180 AS longitude,
      CASE WHEN event_id % 101 = 0 THEN NULL ELSE cast((event_id * 7919) % 721 AS double) / 4 - 90 END AS latitude,
      CASE WHEN event_id % 53 = 0 THEN NULL ELSE cast((event_id * 37) % 2800 AS double) / 4 END AS depth_km,
      'https://example.com/event/' || cast(event_id AS varchar) AS detail_url,
      {stamp} AS ingested_at
    FROM (
      SELECT event_id, user_id, event_type, value,
             cast(json_extract_string(props, '$.k') AS integer) AS k,
             epoch_ms(date_trunc('second', ts)) AS ms,
             concat('SITE_', cast(user_id * 7 + event_id % 7 AS varchar)) AS site
      FROM events
    ) e"""


def _listed(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _class(value: str, classes, missing: str) -> str:
    """The name after as many others as there are bounds at or below the value."""
    bounds, names = classes
    return f"if({value} IS NULL, {missing}, {_listed(names)}[1 + len(list_filter({_listed(bounds)}, lambda b: b <= {value}))])"


def _rank(value: str, p: float) -> str:
    """The value at position p of the sorted ones, between two of them in proportion."""
    v = f"list({value} ORDER BY {value}) FILTER (WHERE {value} IS NOT NULL)"
    at = f"({p} * (count({value}) - 1))"
    low, high = (f"({v})[cast({f}({at}) AS BIGINT) + 1]" for f in ("floor", "ceil"))
    return f"({low} + ({at} - floor({at})) * ({high} - {low}))"


def _measures(counts: dict, means: dict, bounds: dict) -> str:
    parts = [f"count(*) FILTER (WHERE {c}) AS {n}" for n, c in counts.items()]
    parts += [f"sum({c})::DOUBLE / count({c}) AS {n}" for n, c in means.items()]
    parts += [f"{c} AS {n}" for n, c in bounds.items()]
    parts.append("sum(felt_reports) FILTER (WHERE felt_reports IS NOT NULL) AS felt")
    return ", ".join(parts)


def _raw_of(feed: str, stamp: str = TS1) -> str:
    return f"SELECT *, {stamp} AS created_at, {stamp} AS updated_at FROM {feed}"


def batches(ts_a: str = TS1, ts_b: str = TS1) -> str:
    """CTEs feed_a, feed_b, batch_a, batch_b (feed columns): the snapshots of FIXTURES.md, their revisions as a table of additions."""
    return f"""
    feed_a AS ({feed_sql(ts_a)}),
    feed_b AS ({feed_sql(ts_b)}),
    batch_a AS (SELECT * FROM feed_a WHERE event_time IS NULL OR event_time < 1705795200000),
    revision(network, more, deeper, later, state) AS (VALUES
      ('cl', 0.5, 10, 8640000000, 'reviewed'), ('vi', 0.5, 10, 8640000000, 'reviewed'), ('er', 1.0, 0, -1000, NULL), ('pu', 0.25, 0, 1000, NULL)),
    batch_b AS (
      SELECT f.* REPLACE (f.magnitude + ifnull(r.more, 0)::DOUBLE AS magnitude, f.depth_km + ifnull(r.deeper, 0) AS depth_km,
                          ifnull(r.state, f.status) AS status, f.updated_time + ifnull(r.later, 0) AS updated_time)
      FROM feed_b f LEFT JOIN revision r ON r.network = f.network AND f.event_time < 1705795200000
      WHERE f.event_time >= 1704931200000)"""


def _upserted(target: str, batch: str, stamp: str, more: tuple[tuple[str, str], ...] = ()) -> str:
    """A raw table after one batch: of a key's stored and new row the newer updated_time wins, the stored one if neither does."""
    cols = ", ".join(f"if(newer, b.{c}, t.{c}) AS {c}" if c in UPDATE_COLS else f"ifnull(t.{c}, b.{c}) AS {c}" for c in FEED_COLS)
    cols += "".join(f", if(newer, {x}, t.{c}) AS {c}" for c, x in more)
    return f"""SELECT {cols}, ifnull(t.created_at, {stamp}) AS created_at, if(newer, {stamp}, t.updated_at) AS updated_at
      FROM {target} t FULL JOIN {batch} b ON t.event_id = b.event_id,
           LATERAL (SELECT t.event_id IS NULL OR ifnull(b.updated_time > t.updated_time, false) AS newer)"""


def merged_raw(ts_a: str = TS1, ts_b: str = TS2) -> str:
    """CTEs raw_a and raw_ab: raw after batch_a (at ts_a), then batch_b (at ts_b)."""
    return f"raw_a AS ({_raw_of('batch_a', ts_a)}), raw_ab AS ({_upserted('raw_a', 'batch_b', ts_b)})"


def staging_sql(raw: str, stamp: str = TS1) -> str:
    """Days, hours and weekdays are counted from the epoch, a Thursday."""
    same = ", ".join([*UNCHANGED, *(f"{old} AS {new}" for new, old in RENAMED.items())])
    return f"""
    SELECT {same},
      {_class('magnitude', MAGNITUDE_CLASSES, "'unknown'")} AS magnitude_category,
      {_class('depth_km', DEPTH_CLASSES, "'unknown'")} AS depth_category,
      {REGION} AS region,
      make_timestamp(event_time * 1000) AS event_timestamp, make_timestamp(updated_time * 1000) AS updated_timestamp,
      (DATE '1970-01-01' + (event_time // 86400000)::INTEGER)::DATE AS event_date,
      ((event_time // 3600000) % 24)::INTEGER AS event_hour,
      ((event_time // 86400000 + 4) % 7)::INTEGER AS day_of_week,
      ifnull(tsunami_flag, 0) = 1 AS has_tsunami_warning, {stamp} AS dbt_updated_at
    FROM {raw} WHERE {' AND '.join(f'{c} IS NOT NULL' for c in REQUIRED)}"""


# what stands behind the first " of ", or the place as it is
REGION = "if(contains(place, ' of '), trim(array_to_string(string_split(place, ' of ')[2:], ' of ')), place)"


def fact_of(stg: str) -> str:
    return f"SELECT {', '.join(FACT_COLS)} FROM {stg}"


def daily_sql(fct: str, stamp: str = TS1, where: str = "") -> str:
    return f"""
    SELECT event_date AS summary_date, {_measures(DAILY_COUNTS, DAILY_MEANS, DAILY_BOUNDS)}, ifnull(felt, 0)::BIGINT AS total_felt_reports,
      sqrt(greatest(sum(magnitude * magnitude) - sum(magnitude) * sum(magnitude) / count(magnitude), 0) / nullif(count(magnitude) - 1, 0)) AS stddev_magnitude,
      {_rank('magnitude', 0.5)} AS median_magnitude, {stamp} AS dbt_updated_at
    FROM {fct} {where} GROUP BY event_date"""


def stats_sql(fct: str, day: str = AS_OF, region: str = "region") -> str:
    counts = {n: c.format(day=day) for n, c in REGION_COUNTS.items()}
    return f"""
    SELECT {region} AS region, {_measures(counts, REGION_MEANS, REGION_BOUNDS)}, ifnull(felt, 0)::BIGINT AS total_felt_reports,
      {_rank('magnitude', 0.95)} AS p95_magnitude, (max(event_date) - min(event_date) + 1)::BIGINT AS days_with_data
    FROM {fct} WHERE {region} IS NOT NULL GROUP BY {region}"""


def risk_sql(stats: str, stamp: str = TS1) -> str:
    """Weights as the definition lists them; a score that can't be computed stays null and is minimal."""
    weights = {"daily_frequency": 10, "avg_magnitude": 5, "points": 1, "earthquakes_last_30_days": 0.5, "tsunami_warnings": 15}
    score = " + ".join(f"{w} * {c}" for c, w in weights.items())
    return f"""
    SELECT * EXCLUDE (points), if(raw_risk_score > 100, 100, raw_risk_score) AS risk_score,
      {_class('raw_risk_score', RISK_CLASSES, "'minimal'")} AS risk_category, {stamp} AS dbt_updated_at
    FROM (SELECT *, ({score})::DOUBLE AS raw_risk_score
          FROM (SELECT *, total_earthquakes / days_with_data::DOUBLE AS daily_frequency, {_class('max_magnitude', RISK_POINTS, '1')} AS points FROM {stats}))"""


def heatmap_sql(fct: str, stamp: str = TS1) -> str:
    return f"""
    SELECT day_of_week, event_hour, {_listed(DAY_NAMES)}[day_of_week + 1] AS day_name, count(*) AS earthquake_count,
      sum(magnitude) / count(magnitude) AS avg_magnitude, max(magnitude) AS max_magnitude,
      count(*) FILTER (WHERE magnitude >= 4) AS significant_count, {stamp} AS dbt_updated_at
    FROM {fct} GROUP BY ALL"""


def base_ctes(raw: str = "raw") -> str:
    """feed, raw, stg, fct, daily, stats, risk, heatmap, recent for one full build."""
    return f"""WITH
    feed AS ({feed_sql()}),
    raw AS ({_raw_of('feed')}),
    flawed AS (
      SELECT * REPLACE (if(event_code::BIGINT % 30 = 0, repeat(title, 200), title) AS title, if(event_code::BIGINT % 30 = 0, repeat(mag_type, 6), mag_type) AS mag_type)
      FROM raw, range(if(event_code::BIGINT % 40 = 0, 2, 1))),
    stg AS ({staging_sql(raw)}),
    fct AS ({fact_of('stg')}),
    daily AS (SELECT * EXCLUDE (felt) FROM ({daily_sql('fct')})),
    stats AS (SELECT * EXCLUDE (felt) FROM ({stats_sql('fct')})),
    risk AS ({risk_sql('stats')}),
    heatmap AS ({heatmap_sql('fct')}),
    recent AS (SELECT {', '.join(RECENT_COLS)} FROM fct WHERE event_date >= {AS_OF} - {DAYS} AND magnitude >= {MIN_MAG})
    """


def two_run_ctes(feed_b: str = TS2, run_a: str = TS1, run_b: str = TS2, last: str | None = None, day: str = AS_OF, feed_a: str = TS1) -> str:
    """Two pipeline runs: batch A at run_a, then batch B at run_b; the marts of the last build."""
    last = last or run_b
    merged = ", ".join(f"if(i.event_id IS NULL, f.{c}, i.{c}) AS {c}" if c in FACT_MERGED else f"ifnull(f.{c}, i.{c}) AS {c}" if c == "event_id"
                       else f"if(f.event_id IS NULL, i.{c}, f.{c}) AS {c}" for c in FACT_COLS)
    return f"""WITH
    {batches(feed_a, feed_b)},
    {merged_raw(run_a, run_b)},
    stg_a AS ({staging_sql('raw_a', run_a)}),
    fct_a AS ({fact_of('stg_a')}),
    stg_ab AS ({staging_sql('raw_ab', run_b)}),
    fct_inc AS (
      SELECT {', '.join('s.' + c for c in FACT_COLS)} FROM stg_ab s LEFT JOIN fct_a f ON f.event_id = s.event_id
      WHERE f.event_id IS NULL OR s.updated_timestamp > (SELECT max(updated_timestamp) FROM fct_a)),
    fct_ab AS (SELECT {merged} FROM fct_a f FULL JOIN fct_inc i ON f.event_id = i.event_id),
    daily_a AS (SELECT * EXCLUDE (felt) FROM ({daily_sql('fct_a', run_a)})),
    daily_inc AS (SELECT * EXCLUDE (felt) FROM ({daily_sql('fct_ab', run_b, "WHERE event_date >= (SELECT max(summary_date) - 1 FROM daily_a)")})),
    daily_ab AS (SELECT * FROM daily_a ANTI JOIN daily_inc USING (summary_date) UNION ALL BY NAME SELECT * FROM daily_inc),
    stats_ab AS (SELECT * EXCLUDE (felt) FROM ({stats_sql('fct_ab', day)})),
    risk_ab AS ({risk_sql('stats_ab', last)}),
    heatmap_ab AS ({heatmap_sql('fct_ab', last)})
    """


def _r(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


def _replace_round(table: str, cols: list[str]) -> str:
    return f"SELECT * REPLACE ({_r(cols)}) FROM {table}"


DAILY_R = ["stddev_magnitude", "median_magnitude"]
RISK_R = ["p95_magnitude", "daily_frequency", "raw_risk_score", "risk_score"]
VARCHAR_LIMITS = [("event_id", 50), ("mag_type", 10), ("place", 500), ("alert_level", 20),
                  ("status", 20), ("network", 10), ("event_code", 20), ("event_type", 50),
                  ("title", 500), ("detail_url", 1000)]
UNIQUE = [("raw_earthquakes", "raw", "event_id"), ("stg_earthquakes", "stg", "event_id"),
          ("fct_earthquakes", "fct", "event_id"), ("agg_daily_summary", "daily", "summary_date"),
          ("agg_regional_risk", "risk", "region")]
NOT_NULL = [("raw_earthquakes", "raw", ["event_id"]),
            ("stg_earthquakes", "stg", ["event_id", "magnitude", "latitude", "longitude", "event_timestamp"]),
            ("fct_earthquakes", "fct", ["event_id", "magnitude", "event_date", "latitude", "longitude"]),
            ("agg_daily_summary", "daily", ["summary_date"]),
            ("agg_regional_risk", "risk", ["region"])]


def _dq_unique(views: dict[str, str] | None = None) -> str:
    out = []
    for t, v, c in UNIQUE:
        v = (views or {}).get(t, v)
        out.append(_count(t, c, "unique", f"sum((n > 1)::INTEGER) FROM (SELECT count(*) AS n FROM {v} WHERE {c} IS NOT NULL GROUP BY {c})") if v else _none(t, c, "unique"))
    return " UNION ALL ".join(out)


def _count(table: str, column: str, check: str, counted: str) -> str:
    what, _, source = counted.partition(" FROM ")
    return f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{check}' AS check_name, ifnull({what}, 0)::BIGINT AS failures FROM {source}"


def _none(table: str, column: str, check: str) -> str:
    return f"SELECT '{table}', '{column}', '{check}', NULL::BIGINT"


def _dq_not_null(views: dict[str, str] | None = None) -> str:
    out = []
    for t, v, cols in NOT_NULL:
        v = (views or {}).get(t, v)
        out += [_count(t, c, "not_null", f"count(*) - count({c}) FROM {v}") if v else _none(t, c, "not_null") for c in cols]
    return " UNION ALL ".join(out)


def _dq_length(raw: str = "raw") -> str:
    return " UNION ALL ".join(_count("raw_earthquakes", c, "max_length", f"count(*) FILTER (WHERE length({c}) > {n}) FROM {raw}") for c, n in VARCHAR_LIMITS)


def _pivot() -> str:
    days = ", ".join(f"({i}, '{d}')" for i, d in enumerate(
        ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]))
    hours = ", ".join(
        f"max(CASE WHEN h.event_hour = {h} THEN h.earthquake_count END) AS h{h:02d}" for h in range(24)
    )
    return (f"SELECT d.day_order, d.day_name, {hours} FROM (VALUES {days}) d(day_order, day_name) "
            "LEFT JOIN heatmap h ON h.day_name = d.day_name GROUP BY d.day_order, d.day_name")


def _histogram() -> str:
    return """, b AS (SELECT min(magnitude) AS lo, max(magnitude) AS hi FROM recent),
    binned AS (
      SELECT CASE WHEN b.hi = b.lo THEN 0
                  ELSE least(cast(floor((r.magnitude - b.lo) * 30 / (b.hi - b.lo)) AS integer), 29) END AS bin,
             r.magnitude_category, b.lo, b.hi
      FROM recent r CROSS JOIN b WHERE r.magnitude IS NOT NULL
    )
    SELECT bin, round(lo + bin * ((hi - lo) / 30), 6) AS bin_start,
           round(lo + (bin + 1) * ((hi - lo) / 30), 6) AS bin_end,
           magnitude_category, count(*) AS earthquake_count
    FROM binned GROUP BY bin, magnitude_category, lo, hi"""


def oracle_sql() -> dict[str, str]:
    base, two = base_ctes(), two_run_ctes()
    raw_cols = ", ".join([*FEED_COLS, "created_at", "updated_at"])
    newest = "ORDER BY event_timestamp DESC NULLS FIRST, event_id"
    ranked = "ORDER BY risk_score DESC NULLS FIRST, region"
    report = "SELECT *, if(ifnull(failures, 1) = 0, 'pass', 'fail') AS status FROM ({})"
    second = {"raw_earthquakes": "raw_ab", "stg_earthquakes": "stg_ab", "fct_earthquakes": "fct_ab", "agg_daily_summary": "daily_ab", "agg_regional_risk": "risk_ab"}
    absent = {"agg_regional_risk": "", "raw_earthquakes": "flawed"}
    return {
        "geojson_flatten": f"WITH feed AS ({feed_sql()}) SELECT * FROM feed",
        "geojson_rejects": "SELECT if(event_id % 10 = 0, 'cut short', 'wrong type') AS reason, count(*) AS documents FROM events WHERE event_id % 5 = 0 GROUP BY ALL",
        "backfill_slice": f"WITH feed AS ({feed_sql()}) SELECT * FROM feed WHERE event_time BETWEEN 1704067200000 AND 1706659200000 AND magnitude >= 2.5",
        "raw_upsert": f"WITH {batches(TS1, TS2)}, {merged_raw(TS1, TS2)} SELECT {raw_cols} FROM raw_ab",
        "raw_rejected_keys": """SELECT 'raw' AS table_name, count(*) AS row_count, count(*) AS keys FROM events WHERE event_id % 50 <> 0
            UNION ALL SELECT 'rejected', count(*), 0 FROM events WHERE event_id % 50 = 0""",
        "schema_evolution": f"""WITH {batches(TS1, TS2)}, raw_a AS (SELECT *, NULL AS review_note FROM ({_raw_of('batch_a', TS1)})),
            raw_ab AS ({_upserted('raw_a', 'batch_b', TS2, (('review_note', "'seen by ' || b.network"),))})
            SELECT t.event_id, if(late, c.magnitude + 0.25, t.magnitude) AS magnitude, if(late, c.updated_time + 17280000000, t.updated_time) AS updated_time,
                   if(late, {TS3}, t.updated_at) AS updated_at, t.review_note
            FROM raw_ab t JOIN feed_a c USING (event_id), LATERAL (SELECT ifnull(c.event_time >= 1706227200000 AND c.network = 'pu', false) AS late)""",
        "marts_schema_evolution": two + """, typed AS (SELECT f.*, if(a.event_id IS NULL, s.mag_type, NULL) AS mag_type FROM fct_ab f LEFT JOIN fct_a a USING (event_id) LEFT JOIN stg_ab s USING (event_id))
            SELECT 'fct_earthquakes' AS table_name, event_id AS key, magnitude, mag_type AS added FROM typed
            UNION ALL SELECT 'agg_daily_summary', d.summary_date::VARCHAR, d.max_magnitude, i.ml::VARCHAR FROM daily_ab d
            LEFT JOIN (SELECT event_date, count(*) FILTER (mag_type = 'ml') AS ml FROM typed WHERE event_date >= (SELECT max(summary_date) - 1 FROM daily_a) GROUP BY event_date) i ON i.event_date = d.summary_date""",
        "dedupe_latest": f"""WITH {batches(TS1, TS1)}
            SELECT * FROM (FROM batch_a UNION ALL FROM batch_b) QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY updated_time DESC) = 1""",
        "stg_events": base + "SELECT * FROM stg",
        "magnitude_class": base + "SELECT event_id, magnitude, magnitude_category FROM stg",
        "depth_class": base + "SELECT event_id, depth_km, depth_category FROM stg",
        "region_extract": base + f"SELECT event_id, place, {REGION} AS region FROM raw",
        "fct_full": base + "SELECT * FROM fct",
        "fct_incremental": two + "SELECT * FROM fct_ab",
        "fct_incremental_back_stamped": two_run_ctes(run_b=TS0) + "SELECT * FROM fct_ab",
        "new_events_anti": two + "SELECT * FROM stg_ab ANTI JOIN fct_a USING (event_id)",
        "agg_daily_summary": base + _replace_round("daily", DAILY_R),
        "daily_incremental": two + _replace_round("daily_ab", DAILY_R),
        "regional_stats": base + _replace_round("stats", ["p95_magnitude"]),
        "agg_regional_risk": base + _replace_round("risk", RISK_R),
        "risk_capped": base + f", capped AS (SELECT * EXCLUDE (felt) FROM ({stats_sql('fct', region='source_network')})), r AS ({risk_sql('capped')}) " + _replace_round("r", RISK_R),
        "agg_hourly_heatmap": base + "SELECT * FROM heatmap",
        "recent_events": base + f"SELECT * FROM recent {newest}",
        "daily_lookback": base + _replace_round(f"(FROM daily WHERE summary_date >= {AS_OF} - {DAYS})", DAILY_R),
        "latest_daily_10": base + _replace_round("(FROM daily ORDER BY summary_date DESC NULLS FIRST LIMIT 10)", DAILY_R),
        "top_risk_50": base + _replace_round(f"(FROM risk {ranked} LIMIT 50)", RISK_R),
        "top_risk_10": base + _replace_round(f"(FROM risk {ranked} LIMIT 10)", RISK_R),
        "risk_bar_15": base + f"SELECT region, round(risk_score, 6) AS risk_score, risk_category FROM (FROM risk {ranked} LIMIT 15)",
        "recent_table_20": base + f"""SELECT event_timestamp AS "Time", place AS "Location", magnitude AS "Magnitude", depth_km AS "Depth (km)",
            magnitude_category AS "Category", region AS "Region", has_tsunami_warning AS "Tsunami Warning" FROM (FROM recent {newest} LIMIT 20)""",
        "raw_latest_10": base + """SELECT event_id, make_timestamp(event_time * 1000) AS event_time, magnitude, place, latitude, longitude
            FROM (FROM raw ORDER BY event_time DESC NULLS FIRST, event_id LIMIT 10)""",
        "kpi_row": base + f"""SELECT count(*) AS total_earthquakes, count(*) FILTER (WHERE event_timestamp >= {TS1} - INTERVAL 24 HOUR) AS last_24h,
            ifnull(max(magnitude), 0.0) AS max_magnitude, ifnull(sum(magnitude) / count(magnitude), 0.0) AS avg_magnitude,
            count(*) FILTER (WHERE magnitude >= 5) AS significant_count FROM recent""",
        "magnitude_histogram": base + _histogram(),
        "map_points": base + "SELECT latitude, longitude, magnitude, place, depth_km, event_timestamp FROM recent",
        "timeline": base + f"SELECT summary_date, total_earthquakes, avg_magnitude FROM daily WHERE summary_date >= {AS_OF} - {DAYS}",
        "depth_points": base + "SELECT depth_km, magnitude, depth_category, significance, place FROM recent",
        "heatmap_pivot": base + _pivot(),
        "dq_unique": base + _dq_unique(),
        "dq_not_null": base + _dq_not_null(),
        "dq_length": base + _dq_length(),
        "dq_report": base + report.format(f"{_dq_unique()} UNION ALL {_dq_not_null()} UNION ALL {_dq_length()}"),
        "dq_report_of_writes": two + report.format(" UNION ALL ".join([_dq_unique(second), _dq_not_null(second), _dq_length("raw_ab")])),
        "dq_report_flawed": base_ctes("flawed") + report.format(f"{_dq_unique(absent)} UNION ALL {_dq_not_null(absent)} UNION ALL {_dq_length('flawed')}"),
        "row_counts": base + "SELECT 'raw_earthquakes' AS table_name, count(*) AS row_count FROM raw UNION ALL SELECT 'fct_earthquakes', count(*) FROM fct",
        "stream_ingest": f"WITH {batches(TS1, TS2)}, {merged_raw(TS1, TS2)} SELECT {raw_cols} FROM raw_ab",
        "stream_chained_build": two_run_ctes(CHAIN[1], CHAIN[0], CHAIN[1], CHAIN[2], "DATE '2024-02-20'", CHAIN[0]) + _replace_round("risk_ab", RISK_R),
        "end_to_end_build": two + _replace_round("risk_ab", RISK_R),
        "risk_maintained": two + _replace_round("risk_ab", RISK_R),
        "interleaved_build": two + f""", stats_a AS (SELECT * EXCLUDE (felt) FROM ({stats_sql('fct_a')})), risk_a AS ({risk_sql('stats_a')})
            SELECT *, 1 AS build FROM ({_replace_round("risk_a", RISK_R)}) UNION ALL BY NAME SELECT *, 2 AS build FROM ({_replace_round("risk_ab", RISK_R)})""",
        "end_to_end_heatmap": two + "SELECT * FROM heatmap_ab",
    }
