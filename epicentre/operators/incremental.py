"""Incremental maintenance: raw upsert, fact increment, daily increment.

Late-data rules follow the model definitions exactly:

* raw: a matched row is replaced only when the source ``updated_time`` is
  strictly newer (null on either side: no update); never deletes;
* fact: takes staging rows newer than the fact's high-water mark, or unknown to
  it; for known events only seven columns change, so a revised magnitude keeps
  its old category/region/depth until a full refresh;
* daily: recomputes dates from (latest summary date - 1 day) on; an existing but
  empty summary never fills, and older back-filled dates wait for a full refresh.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epicentre.operators.marts import daily_summary, fct_events
from epicentre.operators.merge import Matches, dedupe_latest, matches, merge_apart, merge_rows, merge_upsert
from epicentre.params import RunParams
from epicentre.schemas import FACT_MERGE_UPDATE_COLUMNS, FEED_COLUMNS, RAW_UPDATE_COLUMNS

FactModel = Callable[[DataFrame], DataFrame]
DailyModel = Callable[[DataFrame, RunParams], DataFrame]


def _raw_rule(batch: DataFrame, params: RunParams) -> dict:
    stamp = params.run_ts_col()
    return {
        "update_cols": [*RAW_UPDATE_COLUMNS, *(c for c in batch.columns if c not in FEED_COLUMNS)],
        "condition": lambda t, s: s("updated_time") > t("updated_time"),
        "on_update": {"updated_at": stamp},
        "on_insert": {"created_at": stamp, "updated_at": stamp},
    }


def raw_changes(target: DataFrame, batch: DataFrame, params: RunParams, past_keys: bool = True) -> DataFrame:
    """The raw rows that a deduplicated feed batch adds or replaces.

    An update keeps two stamps of the stored row and takes all else from the batch, so only
    those, the key and ``updated_time`` are read from the stored table, and what only it has;
    ``past_keys`` as for ``merge_rows``.
    """
    kept = [c for c in target.columns if c not in RAW_UPDATE_COLUMNS or c == "updated_time"]
    rows = merge_rows(target.select(*kept), batch, "event_id", past_keys=past_keys, **_raw_rule(batch, params))
    return rows.select(*target.columns, *[c for c in batch.columns if c not in target.columns])


def raw_day() -> Column:
    """The day of a raw row as a number, some day for one without a time."""
    return F.coalesce(F.floor(F.col("event_time") / 86_400_000), F.lit(0)).cast("long")


def raw_merged(target: DataFrame, batch: DataFrame, params: RunParams, changed: str, found: Matches, once: bool, rest: bool = True) -> DataFrame:
    """The whole raw table after a deduplicated feed batch that changes much of it; ``changed`` as for ``merge_all``.

    ``found`` are the days of the keys on both sides, by ``raw_day``; those of the batch count where each of its
    keys came ``once``. Stored rows and batch rows of other days aren't joined; without ``rest``, these stored rows are
    left out."""
    how, kept = _raw_rule(batch, params), found.source(raw_day()) if once else F.lit(True)
    return merge_apart(target, batch.where(kept), batch.where(~kept), found.target(raw_day()), "event_id", changed, rest, **how)


def raw_upsert(target: DataFrame, batch: DataFrame, params: RunParams) -> DataFrame:
    """The whole raw table after merging one feed batch (null keys left out)."""
    return merge_upsert(target, dedupe_latest(batch, "event_id", "updated_time"), "event_id", **_raw_rule(batch, params))


def increment_keys(stg: DataFrame, fct_target: DataFrame) -> DataFrame:
    """Keys of staging rows newer than the fact's max updated_timestamp, or unknown to it.

    A keyed left join plus an uncorrelated scalar subquery (the literal
    ``updated > (max) OR id NOT IN (...)`` plans as a nested-loop existence
    join). Only key and timestamp columns take part; of the fact's keys only those that
    staging has.
    """
    return candidates(stg, fct_target).filter("take").select("event_id")


def fact_day() -> Column:
    """The day of a staging or fact row as a number, some day for one without a date."""
    return F.coalesce(F.unix_date("event_date"), F.lit(0)).cast("long")


def candidates(stg: DataFrame, fct_target: DataFrame) -> DataFrame:
    """Staging's keys: whether ``increment_keys`` takes one, its day, and that of the fact's row (null: unknown)."""
    high_water = fct_target.select(F.max("updated_timestamp")).scalar()
    left = stg.select("event_id", "updated_timestamp", fact_day().alias("day"))
    known = fct_target.select("event_id", fact_day().alias("fact_day")).join(left.select("event_id"), "event_id", "left_semi")
    take = F.col("fact_day").isNull() | F.coalesce(F.col("updated_timestamp") > high_water, F.lit(False))
    return left.join(known, "event_id", "left").select("event_id", take.alias("take"), "day", "fact_day")


def candidate_matches(judged: DataFrame) -> Matches:
    """The number of rows taken, and the days of the keys that the fact knows, from written ``candidates``."""
    return matches(judged, F.col("take"), "fact_day", "day")


def fact_increment(stg: DataFrame, fct_target: DataFrame, keys: DataFrame | None = None, model: FactModel = fct_events) -> DataFrame:
    """Fact rows to merge: the staging rows whose keys ``increment_keys`` selects."""
    keys = increment_keys(stg, fct_target) if keys is None else keys
    return model(stg.join(keys, "event_id", "left_semi"))


def fact_changes(fct_target: DataFrame, increment: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """unique_key event_id: the fact's new rows; on match only the seven merge columns change.

    A column that the model has got since is appended: null in stored rows, also where they change.
    With ``keys``, those that the increment was made from, the increment is read once.
    """
    return merge_rows(fct_target, increment, "event_id", update_cols=FACT_MERGE_UPDATE_COLUMNS, keys=keys)


def fact_merged(fct_target: DataFrame, stg: DataFrame, keys: DataFrame, changed: str, found: Matches, model: FactModel = fct_events,
                rest: bool = True) -> DataFrame:
    """The whole fact after an increment that changes much of it; ``changed`` as for ``merge_all``.

    Staging rows of days without known keys are new, so all of them are taken; neither they nor the fact's rows
    of its other days are joined. The model is applied to either part, as it is to each increment. Without ``rest``, the
    fact's rows of its other days are left out."""
    kept = found.source(fact_day())
    increment = fact_increment(stg.where(kept), fct_target, keys, model)
    return merge_apart(fct_target, increment, model(stg.where(~kept)), found.target(fact_day()), "event_id", changed, rest,
                       update_cols=FACT_MERGE_UPDATE_COLUMNS)


def daily_increment(fct: DataFrame, daily_target: DataFrame, params: RunParams, model: DailyModel = daily_summary) -> DataFrame:
    """Daily rows for event_date >= max(summary_date) - 1 day."""
    low = daily_target.select(F.date_sub(F.max("summary_date"), 1)).scalar()
    return model(fct.filter(F.col("event_date") >= low), params)


def daily_merge(daily_target: DataFrame, increment: DataFrame) -> DataFrame:
    """unique_key summary_date, no column list: matched rows are replaced whole."""
    return merge_upsert(daily_target, increment, "summary_date")


def new_events(stg: DataFrame, fct_target: DataFrame) -> DataFrame:
    """Staging events the fact does not know yet (NOT IN as a left anti join)."""
    return stg.join(fct_target.select("event_id"), "event_id", "left_anti")
