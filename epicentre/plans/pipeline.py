"""Dependency-ordered build: raw -> staging -> fact -> {daily, risk, heatmap}.

Raw and fact are keyed tables: an ingest commits the rows that it changed, a build takes what
raw has committed since the fact was last built. The other marts are written as a new version
each. Every layer is read back from the shared folder, which cuts lineage between layers (a
lost executor recomputes from the last written table, not from the feed). Incremental models
follow the rules in ``epicentre.operators.incremental``; ``full_refresh`` rebuilds them whole.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epicentre.operators import incremental as inc
from epicentre.operators.maintained import HOUR_PARTS, REGION_PARTS, heatmap_from_parts, risk_from_parts
from epicentre.operators.marts import daily_summary, fct_events, hourly_heatmap, regional_risk
from epicentre.operators.merge import count_keys, dedupe_counted, match_merged
from epicentre.operators.quality import dq_report, dq_report_of_writes, write_checks
from epicentre.operators.staging import stg_events
from epicentre.params import RunParams
from epicentre.schemas import RAW_SCHEMA
from epicentre.sources.feed import backfill_slice
from epicentre.sources.store import COMMIT, AppendTable, KeyedTable, PartitionedTable, TableStore

RAW, FACT, DAILY, RISK, HEATMAP = (
    "raw_earthquakes", "fct_earthquakes", "agg_daily_summary", "agg_regional_risk", "agg_hourly_heatmap",
)
REJECTED = RAW + "__rejected"
STAGING = "stg_earthquakes"
MODELS = [STAGING, FACT, DAILY, RISK, HEATMAP]
LAYERS = {"staging": [STAGING], "marts": [FACT, DAILY, RISK, HEATMAP]}
#: The commit of raw that the fact has seen, kept in the fact's own manifest; that of the fact which
#: the parts have seen, kept in theirs.
SEEN, SEEN_FACT = "raw_commit", "fact_commit"


class MissingTable(LookupError):
    """A model's parent, or a table to be checked, hasn't been built."""


class Pipeline:
    """``fact_model`` and ``daily_model`` are the two incremental models; columns that one has got since its
    table was built are appended to the table, null in the rows that no later run takes.

    With ``maintain``, the risk and heatmap marts are built from tables of parts, which each build
    changes by the fact rows that it changes, instead of from the whole fact."""

    def __init__(self, spark: SparkSession, store: TableStore, fact_model: inc.FactModel = fct_events, daily_model: inc.DailyModel = daily_summary,
                 maintain: bool = False):
        self.spark, self.maintain = spark, maintain
        self.fact_model, self.daily_model = fact_model, daily_model
        self.store = store
        self.raw = KeyedTable(store, RAW, "event_id", checks=write_checks(RAW), place=inc.raw_day())
        self.fact = KeyedTable(store, FACT, "event_id", order_by=["event_date"], checks=write_checks(FACT), place=inc.fact_day())
        self.daily = PartitionedTable(store, DAILY, "summary_date")
        self.parts = {RISK: (KeyedTable(store, RISK + "__parts", "part"), REGION_PARTS), HEATMAP: (KeyedTable(store, HEATMAP + "__parts", "part"), HOUR_PARTS)}
        self.rejects = AppendTable(store, REJECTED, "row_hash")

    # -- ingest --
    def ingest(self, batch: DataFrame, params: RunParams) -> dict[str, int]:
        """Upsert one feed batch (the feed columns, and any further ones) into the raw table.

        Commits only rows that are new or strictly newer, so a replayed snapshot commits
        nothing. Rows without a key go to a table of rejected rows, each once however often it comes
        again. Gives the number of rows committed, and of rows of this batch that were rejected.
        The batch is read once for its keys and once whole (``ingest_parsed`` for one that is dear to make).
        """
        counts = count_keys(batch, "event_id")
        keys, rejected = counts.keys, counts.none
        latest = dedupe_counted(batch, "event_id", "updated_time", counts)
        if rejected:
            what = F.to_json(F.struct(*[c for c in sorted(batch.columns) if c != "ingested_at"]))
            no_key = batch.where(F.col("event_id").isNull())
            self.rejects.append(no_key.withColumns({"row_hash": F.sha2(what, 256), "rejected_at": params.run_ts_col()}))
        state = self.raw.state()
        if state is None:
            # without rows for the optimizer too, so that the batch is written as it comes
            none = self.spark.createDataFrame([], RAW_SCHEMA).limit(0)
            self.raw.rebuild(inc.raw_changes(none, latest, params))
            committed = self.raw.state()["base_rows"]
        elif keys > self.raw.MAX_SHARE * state["base_rows"]:
            committed = self._ingest_large(batch, latest, params, state, once=counts.repeated == [])
        else:  # a small batch is written for its keys, past which the stored rows stream
            with self.store.run() as scratch:
                committed = self.raw.commit(inc.raw_changes(self.raw.read(state=state), scratch.write("latest", latest), params).hint("rebalance"))
        return {"committed": committed, "rejected": rejected}

    def _ingest_large(self, batch: DataFrame, latest: DataFrame, params: RunParams, state: dict, once: bool) -> int:
        """The rows that the batch changes are counted from keys and times first: none, and nothing whole is read; so many
        that the base would be rewritten, and they are written into the new base at once, where only days that have
        keys of both are joined, and stored rows of other days stay in their files where these are worth it."""
        stored = self.raw.read(with_commit=True, state=state)
        found = match_merged(stored, batch, "event_id", "updated_time", inc.raw_day())
        if not found.changed:
            return 0
        if not self.raw.outgrows(found.changed, state):
            return self.raw.commit(inc.raw_changes(stored.drop(COMMIT), latest, params, past_keys=False))
        stay = self.raw.staying(found.replaced(), state)
        self.raw.commit_all(inc.raw_merged(stored, latest, params, COMMIT, found, once, rest=stay is None), state, stay=stay)
        return found.changed

    def ingest_parsed(self, batch: DataFrame, params: RunParams) -> dict[str, int]:
        """``ingest`` of a batch that is parsed from texts: parsed once, into an intermediate table."""
        with self.store.run() as scratch:
            return self.ingest(scratch.write("batch", batch), params)

    def backfill(self, history: DataFrame, params: RunParams, **slice_args) -> dict[str, int]:
        """Historical load: the back-fill slice of landed feed records, then the upsert."""
        return self.ingest_parsed(backfill_slice(history, params, **slice_args), params)

    def raw_table(self) -> DataFrame:
        raw = self.raw.read()
        return self.spark.createDataFrame([], RAW_SCHEMA) if raw is None else raw

    def rejected(self) -> DataFrame | None:
        return self.rejects.read()

    # -- transform --
    def staging(self, params: RunParams) -> DataFrame:
        return stg_events(self.raw_table(), params)

    def run(self, params: RunParams, select: Iterable[str] | None = None,
            full_refresh: bool = False, raw_state: dict | None = None) -> dict[str, DataFrame]:
        """Build the selected models (default all) in dependency order; all tables that are there.

        The build sees raw as it is at its start, or as ``raw_state`` (an earlier ``raw.state()``)
        has it, whatever an ingest in another process commits meanwhile; the next build takes that.
        """
        chosen = _expand(select)
        state = raw_state or self.raw.state()
        if state is None:
            raise MissingTable(RAW)
        if FACT in chosen:
            self._fact(params, full_refresh, state)
        fct = self.fact.read()
        if fct is None and chosen & {DAILY, RISK, HEATMAP}:
            raise MissingTable(FACT)
        if DAILY in chosen:
            self._daily(fct, params, full_refresh)
        if RISK in chosen:
            self.store.write(RISK, risk_from_parts(self._parts(RISK), params) if self.maintain else regional_risk(fct, params))
        if HEATMAP in chosen:
            self.store.write(HEATMAP, heatmap_from_parts(self._parts(HEATMAP), params) if self.maintain else hourly_heatmap(fct, params))
        out = self.tables() | {STAGING: self.staging(params)}
        del out[RAW]
        return out

    def _fact(self, params: RunParams, full_refresh: bool, state: dict) -> None:
        """Rows that raw committed since the last build are the only ones that can be taken.

        Any other staging row was judged by an earlier build: it is in the fact at or below its
        high-water mark, which never falls, or the fact passed it over for good. Commit numbers
        rise whatever stamps a caller gives, and the number seen is written in one step with
        the rows that were taken.
        """
        current = None if full_refresh else self.fact.read()
        if current is None:
            self.fact.rebuild(self.fact_model(stg_events(self.raw.read(state=state), params)), {SEEN: state["last"]})
            return
        recent = stg_events(self.raw.read(since=self.fact.notes().get(SEEN, 0), state=state), params)
        with self.store.run() as scratch:
            judged = scratch.write("increment-keys", inc.candidates(recent, current))
            held, found, keys = self.fact.state(), inc.candidate_matches(judged), judged.where("take").select("event_id")
            taken = found.changed
            if taken and not self.maintain and self.fact.outgrows(taken, held):
                stay = self.fact.staying(found.replaced(), held)
                merged = inc.fact_merged(self.fact.read(with_commit=True, state=held), recent, keys, COMMIT, found, self.fact_model, rest=stay is None)
                again = current if stay is None else current.where(found.target(inc.fact_day()))
                dates = again.select("event_date").unionByName(recent.select("event_date"))
                self.fact.commit_all(merged, held, {SEEN: state["last"]}, like=dates, stay=stay)
                return
            changes = inc.fact_changes(current, inc.fact_increment(recent, current, keys, self.fact_model), keys)
            if taken <= self.fact.MAX_SHARE * held["base_rows"]:
                changes = changes.hint("rebalance")  # few rows, out of each split of raw
            if not self.maintain:
                self.fact.commit(changes, {SEEN: state["last"]})
                return
            changes = scratch.write("changes", changes)
            old = scratch.write("replaced", current.join(changes.select("event_id"), "event_id", "left_semi").select(*current.columns))
            before = self.fact.last_commit()
            self.fact.commit(changes, {SEEN: state["last"]})
            for table, kind in self.parts.values():
                if table.notes().get(SEEN_FACT) == before:
                    table.commit(kind.changed(table.read(), changes, old), {SEEN_FACT: self.fact.last_commit()})

    def _parts(self, mart: str) -> DataFrame:
        """The parts of a mart. They are made from the whole fact if they have missed one of its commits
        (they are new, a run died between the two commits, or another build didn't maintain them)."""
        table, kind = self.parts[mart]
        seen = self.fact.last_commit()
        if not table.exists() or table.notes().get(SEEN_FACT) != seen:
            table.rebuild(kind.of(self.fact.read()), {SEEN_FACT: seen})
        return table.read()

    def _daily(self, fct: DataFrame, params: RunParams, full_refresh: bool) -> None:
        """An increment replaces the partitions of its dates; what it is computed from, the table's last
        date included, is read before it is written (into files of its own)."""
        current = None if full_refresh else self.daily.read()
        if current is None:
            self.daily.commit(self.daily_model(fct, params), replace_all=True)
        else:
            self.daily.commit(inc.daily_increment(fct, current, params, self.daily_model))

    # -- reading --
    def table(self, name: str) -> DataFrame:
        """A written table by name; MissingTable if it isn't there."""
        own = {RAW: self.raw, FACT: self.fact, DAILY: self.daily}
        df = own[name].read() if name in own else self.store.read(name)
        if df is None:
            raise MissingTable(name)
        return df

    def tables(self) -> dict[str, DataFrame]:
        """All written tables that are there."""
        out = {}
        for name in (RAW, FACT, DAILY, RISK, HEATMAP):
            try:
                out[name] = self.table(name)
            except MissingTable:
                continue
        return out

    def quality_report(self, params: RunParams, from_writes: bool = False) -> DataFrame:
        """The declared column tests (plus declared lengths) over the current tables,
        as the transform's test step runs them after the marts. An absent table fails its tests.

        ``from_writes`` takes nulls and lengths of raw and fact from what their writes counted, so that
        only keys are read of these; it reads a column where rows that failed may have been replaced since."""
        tables = self.tables()
        if RAW in tables:
            tables[STAGING] = self.staging(params)
        if not from_writes:
            return dq_report(tables, self.spark)
        keyed = {RAW: self.raw, FACT: self.fact}
        return dq_report_of_writes(tables, self.spark, lambda t, check: keyed[t].failures(check) if t in keyed else None)

    def register_views(self, params: RunParams) -> list[str]:
        """Expose the current tables (and the staging view) to ``spark.sql`` by name."""
        views = self.tables() | {STAGING: self.staging(params)}
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return sorted(views)


def _expand(select: Iterable[str] | None) -> set[str]:
    if select is None:
        return set(MODELS)
    chosen: set[str] = set()
    for s in select:
        chosen.update(LAYERS.get(s, [s]))
    unknown = chosen - set(MODELS)
    if unknown:
        raise ValueError(f"unknown models: {sorted(unknown)}")
    return chosen
