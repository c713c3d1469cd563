"""The query catalog: one callable per operator, ``(spark, sf_dir) -> DataFrame``.

Every query starts from the driver's whole ``events`` table (mapped to feed
records by ``epicentre.sources.fixtures``) and runs the library operators on it.
Serving, verification and quality queries read the written tables by name; those
are built from ``events`` once for each session and input.
Non-exact doubles (stddev, percentiles, ratios, scores, bin edges) are rounded
to 6 places here, in the result only, so two engines can be compared; the
library itself returns full precision.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epicentre.functions import region_from_place
from epicentre.operators import incremental as inc
from epicentre.operators import quality, serving
from epicentre.operators.marts import daily_summary, fct_events, hourly_heatmap, regional_risk, regional_stats
from epicentre.operators.merge import dedupe_latest, key_counts
from epicentre.operators.staging import stg_events
from epicentre.params import RunParams
from epicentre.plans.pipeline import DAILY, FACT, HEATMAP, RAW, RISK, STAGING, Pipeline
from epicentre.session import scratch_path
from epicentre.sources import feed as feedsrc
from epicentre.sources.fixtures import batch_a, batch_b, batch_c, feed_from_events, flawed_raw, raw_from_events, read_table
from epicentre.sources.store import TableStore
from epicentre.streaming.ingest import start_ingest

# The dates of the first run (and of every single-run query), of the second, and
# of one that a wrong clock stamps before the first.
P1 = RunParams.at(dt.datetime(2024, 1, 31, 0, 0, 0))
P2 = P1.with_run_ts(dt.datetime(2024, 1, 31, 0, 5, 0))
P0 = P1.with_run_ts(dt.datetime(2024, 1, 30, 23, 0, 0))
P3 = P1.with_run_ts(dt.datetime(2024, 1, 31, 0, 10, 0))

DAILY_ROUND = ["stddev_magnitude", "median_magnitude"]
STATS_ROUND = ["p95_magnitude"]
RISK_ROUND = ["p95_magnitude", "daily_frequency", "raw_risk_score", "risk_score"]

Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame, cols: list[str], places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols if c in df.columns})


# -- building blocks --------------------------------------------------------
def _events(spark, sf):
    return read_table(spark, sf, "events")


def _raw(spark, sf):
    return raw_from_events(_events(spark, sf), P1)


def _feed(spark, sf, p=P1):
    return feed_from_events(_events(spark, sf), p)


def _stg(spark, sf):
    return stg_events(_raw(spark, sf), P1)


def _fct(spark, sf):
    return fct_events(_stg(spark, sf))


def _two_batches(spark, sf):
    return batch_a(_feed(spark, sf, P1)), batch_b(_feed(spark, sf, P2))


def _fresh(spark, name: str = "pipeline") -> Pipeline:
    return Pipeline(spark, TableStore(spark, scratch_path(spark, name)))


def _pipeline(spark, sf, select=None, second_run: bool = True, second: RunParams = P2) -> tuple[Pipeline, dict[str, DataFrame]]:
    """Ingest batch A and build ``select``; ingest batch B and (optionally) build
    again, incrementally. Every table is written to a fresh store."""
    pipe = _fresh(spark)
    a, b = _two_batches(spark, sf)
    pipe.ingest(a, P1)
    if select:
        pipe.run(P1, select)
    pipe.ingest(b, second)
    out = pipe.run(second, select) if (select and second_run) else {}
    return pipe, out


_built: dict[tuple[str, str], Pipeline] = {}


def _warehouse(spark, sf) -> Pipeline:
    """All tables after one ingest of the whole feed and one build, written once per session and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _built:
        pipe = _fresh(spark, "warehouse")
        pipe.ingest(_feed(spark, sf), P1)
        pipe.run(P1)
        _built[key] = pipe
    return _built[key]


def _tables(spark, sf) -> dict[str, DataFrame]:
    pipe = _warehouse(spark, sf)
    return {n: pipe.table(n) for n in (RAW, FACT, DAILY, RISK)} | {STAGING: pipe.staging(P1)}


def _recent(spark, sf, ordered=False):
    return serving.recent_events(_warehouse(spark, sf).table(FACT), P1, ordered=ordered)


# -- sources, ingest, increments ----------------------------------------------
def q_geojson_flatten(spark, sf):
    """Written as feed files, read back and flattened."""
    path = scratch_path(spark, "snapshot")
    feedsrc.write_snapshot(_feed(spark, sf), path)
    docs = feedsrc.accepted(feedsrc.parse_documents(feedsrc.read_documents(spark, path)))
    return feedsrc.flatten(docs, P1.run_ts_col())


def q_geojson_rejects(spark, sf):
    """Documents of one feature each; those of every fifth event are cut short or hold a wrong type."""
    feed = _feed(spark, sf)
    docs = feedsrc.to_features(feed).select("event_id", F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array("feature").alias("features"))).alias("value"))
    number = F.substring("event_id", 3, 20).cast("bigint")
    broken = F.when(number % 10 == 0, F.substring("value", 1, 40)).when(number % 10 == 5, F.regexp_replace("value", '"coordinates":\\[', '"coordinates":["east",')).otherwise(F.col("value"))
    bad = feedsrc.rejects(feedsrc.parse_documents(docs.select(broken.alias("value"))))
    how = F.when(F.length("malformed") == 40, "cut short").otherwise("wrong type")
    return bad.groupBy(how.alias("reason")).agg(F.count(F.lit(1)).alias("documents"))


def q_backfill_slice(spark, sf):
    return feedsrc.backfill_slice(_feed(spark, sf), P1)


def q_raw_upsert(spark, sf):
    pipe, _ = _pipeline(spark, sf)
    return pipe.raw_table()


def q_raw_rejected_keys(spark, sf):
    """A batch in which every 50th event has lost its key, ingested twice: each such row is stored once."""
    feed = _feed(spark, sf)
    lost = F.substring("event_id", 3, 20).cast("bigint") % 50 == 0
    batch = feed.withColumn("event_id", F.when(~lost, F.col("event_id")))
    pipe = _fresh(spark)
    pipe.ingest(batch, P1)
    pipe.ingest(batch, P2)
    raw = pipe.raw_table().agg(F.lit("raw").alias("table_name"), F.count(F.lit(1)).alias("row_count"), F.count("event_id").alias("keys"))
    bad = pipe.rejected().agg(F.lit("rejected").alias("table_name"), F.count(F.lit(1)).alias("row_count"), F.count("event_id").alias("keys"))
    return raw.unionByName(bad)


def q_schema_evolution(spark, sf):
    """Three ingests, the second with a column that the others don't have, read back after the third."""
    a, b = _two_batches(spark, sf)
    pipe = _fresh(spark)
    pipe.ingest(a, P1)
    pipe.ingest(b.withColumn("review_note", F.concat(F.lit("seen by "), F.col("network"))), P2)
    pipe.ingest(batch_c(_feed(spark, sf, P3)), P3)
    return pipe.raw_table().select("event_id", "magnitude", "updated_time", "updated_at", "review_note")


def q_marts_schema_evolution(spark, sf):
    """Fact and daily models that get a column each before the second run: magnitude type, and events of type ml."""
    pipe = _fresh(spark)
    a, b = _two_batches(spark, sf)
    pipe.ingest(a, P1)
    pipe.run(P1, [FACT, DAILY])
    pipe.ingest(b, P2)
    more = {"ml_events": F.count_if(F.col("mag_type") == "ml")}
    later = Pipeline(spark, pipe.store, lambda stg: fct_events(stg, ["mag_type"]), lambda fct, params: daily_summary(fct, params, more))
    out = later.run(P2, [FACT, DAILY])
    fact = out[FACT].select(F.lit(FACT).alias("table_name"), F.col("event_id").alias("key"), "magnitude", F.col("mag_type").alias("added"))
    daily = out[DAILY].select(F.lit(DAILY), F.col("summary_date").cast("string"), F.col("max_magnitude"), F.col("ml_events").cast("string"))
    return fact.union(daily)


def q_dedupe_latest(spark, sf):
    # one ingest stamp for both snapshots: unchanged repeats are then identical rows
    feed = _feed(spark, sf, P1)
    both = batch_a(feed).unionByName(batch_b(feed))
    return dedupe_latest(both, "event_id", "updated_time", key_counts(both, "event_id")[2])


# -- staging and marts ----------------------------------------------------------
def q_stg_events(spark, sf):
    return _stg(spark, sf)


def q_magnitude_class(spark, sf):
    return _stg(spark, sf).select("event_id", "magnitude", "magnitude_category")


def q_depth_class(spark, sf):
    return _stg(spark, sf).select("event_id", "depth_km", "depth_category")


def q_region_extract(spark, sf):
    return _raw(spark, sf).select("event_id", "place", region_from_place("place").alias("region"))


def q_fct_full(spark, sf):
    return _fct(spark, sf)


def q_fct_incremental(spark, sf):
    return _pipeline(spark, sf, [FACT])[1][FACT]


def q_fct_incremental_back_stamped(spark, sf):
    """The second ingest carries an earlier stamp than the first (a replay, or a corrected clock)."""
    return _pipeline(spark, sf, [FACT], second=P0)[1][FACT]


def q_new_events_anti(spark, sf):
    pipe, _ = _pipeline(spark, sf, [FACT], second_run=False)
    return inc.new_events(pipe.staging(P2), pipe.fact.read())


def q_agg_daily_summary(spark, sf):
    return _round(daily_summary(_fct(spark, sf), P1), DAILY_ROUND)


def q_daily_incremental(spark, sf):
    return _round(_pipeline(spark, sf, [FACT, DAILY])[1][DAILY], DAILY_ROUND)


def q_regional_stats(spark, sf):
    return _round(regional_stats(_fct(spark, sf), P1), STATS_ROUND)


def q_agg_regional_risk(spark, sf):
    return _round(regional_risk(_fct(spark, sf), P1), RISK_ROUND)


def q_risk_capped(spark, sf):
    """Regions by network, each with very many events a day: raw scores past the cap."""
    fct = _fct(spark, sf).withColumn("region", F.col("source_network"))
    return _round(regional_risk(fct, P1), RISK_ROUND)


def q_agg_hourly_heatmap(spark, sf):
    return hourly_heatmap(_fct(spark, sf), P1).orderBy("day_of_week", "event_hour")


# -- serving: the written marts, by name ------------------------------------------
def q_recent_events(spark, sf):
    return _recent(spark, sf, ordered=True)


def _lookback(spark, sf):
    return serving.daily_lookback(_warehouse(spark, sf).table(DAILY), P1)


def q_daily_lookback(spark, sf):
    return _round(_lookback(spark, sf), DAILY_ROUND)


def q_latest_daily_10(spark, sf):
    return _round(serving.latest_daily(_warehouse(spark, sf).table(DAILY), 10), DAILY_ROUND)


def q_top_risk_50(spark, sf):
    return _round(serving.top_risk(_warehouse(spark, sf).table(RISK), 50), RISK_ROUND)


def q_top_risk_10(spark, sf):
    return _round(serving.top_risk(_warehouse(spark, sf).table(RISK), 10), RISK_ROUND)


def q_risk_bar_15(spark, sf):
    return _round(serving.risk_bar(_warehouse(spark, sf).table(RISK), 15), RISK_ROUND)


def q_recent_table_20(spark, sf):
    return serving.recent_table(_warehouse(spark, sf).table(FACT), P1, 20)


def q_raw_latest_10(spark, sf):
    return serving.raw_latest(_warehouse(spark, sf).table(RAW), 10)


def q_kpi_row(spark, sf):
    return serving.kpi_row(_recent(spark, sf), P1)


def q_magnitude_histogram(spark, sf):
    return _round(serving.magnitude_histogram(_recent(spark, sf)), ["bin_start", "bin_end"])


def q_map_points(spark, sf):
    return serving.map_points(_recent(spark, sf))


def q_timeline(spark, sf):
    return serving.timeline(_lookback(spark, sf))


def q_depth_points(spark, sf):
    return serving.depth_points(_recent(spark, sf))


def q_heatmap_pivot(spark, sf):
    return serving.heatmap_pivot(_warehouse(spark, sf).table(HEATMAP))


# -- quality ------------------------------------------------------------------------
def q_dq_unique(spark, sf):
    return quality.dq_unique(_tables(spark, sf), spark)


def q_dq_not_null(spark, sf):
    return quality.dq_counts(_tables(spark, sf), spark, lengths=False)


def q_dq_length(spark, sf):
    return quality.length_failures(_warehouse(spark, sf).table(RAW))


def q_dq_report(spark, sf):
    return quality.dq_report(_tables(spark, sf), spark)


def q_dq_report_of_writes(spark, sf):
    """The report from what the writes counted, after a second ingest and build."""
    pipe, _ = _pipeline(spark, sf, [FACT, DAILY, RISK])
    return pipe.quality_report(P2, from_writes=True)


def q_dq_report_flawed(spark, sf):
    """The report over a raw table with repeated keys and over-long texts; the risk table is absent."""
    raw = flawed_raw(_raw(spark, sf))
    stg = stg_events(raw, P1)
    fct = fct_events(stg)
    tables = {RAW: raw, STAGING: stg, FACT: fct, DAILY: daily_summary(fct, P1)}
    return quality.dq_report(tables, spark)


def q_row_counts(spark, sf):
    pipe = _warehouse(spark, sf)
    parts = [
        pipe.table(name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name in (RAW, FACT)
    ]
    return parts[0].unionByName(parts[1])


# -- streaming and whole builds --------------------------------------------------------
def _stream(spark, sf, clock, **how) -> Pipeline:
    """Land snapshots A, B and B again, one file each, and stream them one a trigger."""
    root = scratch_path(spark, "stream")
    a, b = _two_batches(spark, sf)
    store = TableStore(spark, f"{root}/tables")
    for i, snap in enumerate((a, b, b)):
        feedsrc.write_snapshot(snap, f"{root}/landing/snapshot-{i:04d}")
        q = start_ingest(spark, f"{root}/landing/*/part-*", store, f"{root}/checkpoint", clock, available_now=True, **how)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return Pipeline(spark, store)


def q_stream_ingest(spark, sf):
    """Three micro-batches, each with its own stamps; the third is a replay."""
    return _stream(spark, sf, lambda epoch: (P1, P2, P3)[epoch]).raw_table()


def q_stream_chained_build(spark, sf):
    """A build after every micro-batch, days apart: the last-30-days counts move with the clock."""
    days = (dt.datetime(2024, 1, 31, 23, 55), dt.datetime(2024, 2, 1, 0, 5), dt.datetime(2024, 2, 20, 0, 0))
    pipe = _stream(spark, sf, lambda epoch: RunParams.at(days[epoch]), transform_every=dt.timedelta(minutes=10))
    return _round(pipe.table(RISK), RISK_ROUND)


def q_end_to_end_build(spark, sf):
    return _round(_pipeline(spark, sf, [FACT, DAILY, RISK, HEATMAP])[1][RISK], RISK_ROUND)


def q_risk_maintained(spark, sf):
    """The risk mart after a second ingest, from parts that the build of it changed by its fact rows alone."""
    pipe = _fresh(spark)
    pipe.maintain = True
    a, b = _two_batches(spark, sf)
    pipe.ingest(a, P1)
    pipe.run(P1, [FACT, RISK])
    pipe.ingest(b, P2)
    return _round(pipe.run(P2, [FACT, RISK])[RISK], RISK_ROUND)


def q_interleaved_build(spark, sf):
    """Ingest and build as two users of one warehouse: batch B is committed while a build of batch A is at work.

    The risk mart of that build, which sees batch A alone, and of the next.
    """
    root = scratch_path(spark, "interleaved")
    ingest, build = (Pipeline(spark, TableStore(spark, root)) for _ in range(2))
    a, b = _two_batches(spark, sf)
    models = [FACT, DAILY, RISK]
    ingest.ingest(a, P1)
    began = build.raw.state()
    with build.store.run() as scratch:
        begun = scratch.write("begun", build.raw.read(state=began).select("event_id"))
        ingest.ingest(b, P2)
        begun.count()  # an ingest leaves the files of a build alone
        first = build.run(P1, models, raw_state=began)[RISK].withColumn("build", F.lit(1))
    second = build.run(P2, models)[RISK].withColumn("build", F.lit(2))
    return _round(first.unionByName(second), RISK_ROUND)


def q_end_to_end_heatmap(spark, sf):
    return _pipeline(spark, sf, [FACT, HEATMAP])[1][HEATMAP]


def queries() -> dict[str, Query]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_agg_daily_summary(spark, sf_dir)
