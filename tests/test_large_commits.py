"""Large batches and increments: no dedupe where keys don't repeat, one write of a new base, ranges without a sample."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from epicentre.operators import incremental as inc
from epicentre.operators import merge
from epicentre.plans import catalog as C
from epicentre.plans.pipeline import FACT, RAW, Pipeline
from epicentre.schemas import FACT_MERGE_UPDATE_COLUMNS, RAW_SCHEMA
from epicentre.session import scratch_path
from epicentre.sources import store as S
from epicentre.sources.store import KeyedTable, TableStore


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_rows_of_repeated_keys_are_deduplicated(spark, monkeypatch):
    once = [(f"k{i}", i % 4, i) for i in range(30)] + [(None, 1, 1)]
    for more in ([], [("k3", 9, 1), ("k3", None, 2), ("k7", 0, 5)], [(f"k{i}", 7, i) for i in range(20)]):
        df = spark.createDataFrame(once + more, "k string, o int, v int")
        want = sorted(map(tuple, merge.dedupe_latest(df, "k", "o").collect()))
        for most in (1000, 10):  # within the bounded list, or past it
            monkeypatch.setattr(merge, "FREQUENT_KEYS", most)
            counts = merge.count_keys(df, "k")
            assert counts[:3] == (30, 1, []) == merge.key_counts(df, "k")
            assert (counts.repeated is None) == (len({m[0] for m in more}) > most)
            got = merge.dedupe_counted(df, "k", "o", counts)
            assert sorted(map(tuple, got.collect())) == want
            if not more:
                assert "Exchange" not in _plan(got) and "Sort" not in _plan(got)


def test_merge_all_is_merge_upsert_in_one_join(spark):
    tgt = spark.createDataFrame([(1, 5, "a", 1), (2, None, "b", 1), (3, 5, "c", 2), (4, 5, "d", 2)], "k int, u int, v string, c long")
    src = spark.createDataFrame([(1, 6, "A", "x"), (2, 6, "B", "x"), (3, 5, "C", "x"), (4, None, "D", "x"), (9, None, "N", "x")], "k int, u int, v string, w string")
    newer = {"condition": lambda t, s: s("u") > t("u")}
    for how in ({}, newer, {**newer, "update_cols": ["v"], "on_update": {"u": F.lit(0)}}):
        whole = merge.merge_all(tgt, src, "k", "c", **how)
        assert _plan(whole).count("Join") == 1
        want = merge.merge_upsert(tgt.drop("c"), src, "k", **how)
        assert sorted(map(str, whole.drop("c").collect())) == sorted(map(str, want.select(*whole.drop("c").columns).collect()))
        changed = {r.k for r in merge.merge_rows(tgt.drop("c"), src, "k", **how).collect()}
        assert {r.k for r in whole.where("c is null").collect()} == changed
    assert merge.count_merged(tgt, src.unionByName(src.where("k = 1").withColumn("u", F.lit(1))), "k", "u") == 2


def test_merge_apart_joins_only_places_with_keys_of_both(spark, monkeypatch):
    place = F.coalesce(F.col("d"), F.lit(0)).cast("long")
    tgt = spark.createDataFrame([(1, 5, 10, "a", 1), (2, 5, 10, "b", 1), (3, 5, 20, "c", 1), (4, 5, None, "d", 2), (5, 5, 30, "e", 2)],
                                "k int, u int, d int, v string, c long")
    src = spark.createDataFrame([(1, 6, 40, "A", "x"), (4, 4, 20, "D", "x"), (7, 1, None, "N", "x"), (8, 1, 40, "N", "x"), (9, 1, 50, "N", "x"), (10, 1, 30, "N", "x")],
                                "k int, u int, d int, v string, w string")
    how = {"condition": lambda t, s: s("u") > t("u"), "on_update": {"u": F.lit(0)}}
    want = merge.merge_all(tgt, src, "k", "c", **how)
    found = merge.match_merged(tgt, src, "k", "u", place)
    assert found.changed == 5 == merge.count_merged(tgt, src, "k", "u") and sorted(found.places) == [(0, 20), (10, 40)]
    assert merge.match_merged(tgt, src.where("k > 6"), "k", "u", place) == (4, [])
    assert merge.match_merged(tgt, src.where("k > 99"), "k", "u", place) == (0, [])
    kept = found.source(place)
    joined, plain = [], merge.merge_all
    monkeypatch.setattr(merge, "merge_all", lambda t, s, *a, **h: (joined.append((t.count(), s.count())), plain(t, s, *a, **h))[1])
    got = merge.merge_apart(tgt, src.where(kept), src.where(~kept), found.target(place), "k", "c", **how)
    assert joined == [(3, 3)] and got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    monkeypatch.setattr(merge, "MATCHED_PLACES", 1)  # too many to tell: all are joined
    found = merge.match_merged(tgt, src, "k", "u", place)
    assert found == (5, None)
    got = merge.merge_apart(tgt, src.where(found.source(place)), src.where(~found.source(place)), found.target(place), "k", "c", **how)
    assert joined[1:] == [(5, 6)] and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_large_batch_and_increment_join_only_days_with_keys_of_both(spark, monkeypatch):
    """Days that only the stored rows or only the batch have pass the join, also rows without a time or whose day has
    changed; with repeated keys, the whole batch is joined."""
    day = 86_400_000
    names = [f.name for f in RAW_SCHEMA.fields][:27]

    def feed(rows):
        df = spark.createDataFrame(rows, "event_id string, event_time long, updated_time long, magnitude double")
        df = df.withColumns({"latitude": F.lit(1.0), "longitude": F.lit(2.0), "ingested_at": C.P1.run_ts_col()})
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(RAW_SCHEMA[c].dataType).alias(c) for c in names])

    a = feed([(f"e{i}", i % 10 * day, 5, 1.0) for i in range(40)] + [("none", None, 5, 1.0)])
    later = [(f"e{i}", 9 * day + 7, 6, 2.0) for i in (8, 9, 18, 19)] + [(f"n{i}", (15 + i % 5) * day, 6, 3.0) for i in range(20)] + [("late", None, 1, 3.0)]
    joined, plain = [], merge.merge_all
    monkeypatch.setattr(merge, "merge_all", lambda t, s, *x, **h: (joined.append((t.count(), s.count())), plain(t, s, *x, **h))[1])
    for rows, raw_join in ((later, (8, 4)), ([*later, ("n3", 3 * day, 9, 4.0)], (8, 25))):
        joined.clear()
        b = feed(rows)
        pipe = Pipeline(spark, TableStore(spark, scratch_path(spark, "t-days")))
        pipe.ingest(a, C.P1)
        before = pipe.raw_table()
        pipe.run(C.P1, [FACT])
        assert pipe.ingest(b, C.P2) == {"committed": 25, "rejected": 0}
        want = inc.raw_upsert(before, b, C.P2)
        assert sorted(map(str, pipe.raw_table().collect())) == sorted(map(str, want.select(*before.columns).collect()))
        old = pipe.fact.read()
        keys = inc.increment_keys(pipe.staging(C.P2), old)
        assert joined == [raw_join]
        want = merge.merge_upsert(old, inc.fact_increment(pipe.staging(C.P2), old, keys), "event_id", update_cols=FACT_MERGE_UPDATE_COLUMNS)
        want = sorted(map(str, want.select(*old.columns).collect()))
        assert sorted(map(str, pipe.run(C.P2, [FACT])[FACT].collect())) == want
        assert joined[1:] == [(8, 4)]


def test_report_of_writes_counts_raw_keys_once_and_starts_no_python(spark, sf001):
    pipe = Pipeline(spark, TableStore(spark, scratch_path(spark, "t-report")))
    pipe.ingest(C._feed(spark, sf001), C.P1)
    pipe.run(C.P1)
    report = pipe.quality_report(C.P1, from_writes=True)
    plan = report._jdf.queryExecution().toString()
    assert RAW + "/" not in plan and "ExistingRDD" not in plan and "LogicalRDD" not in plan
    got = {(r.table_name, r.column_name, r.check_name): r.failures for r in report.collect()}
    assert got == {(r.table_name, r.column_name, r.check_name): r.failures for r in pipe.quality_report(C.P1).collect()}


def test_a_large_commit_is_written_into_the_new_base_at_once(spark, sf001, monkeypatch):
    written, plain = [], KeyedTable._write
    monkeypatch.setattr(KeyedTable, "_write", lambda self, df, *how: (written.append(self.name), plain(self, df, *how))[1])
    pipe = Pipeline(spark, TableStore(spark, scratch_path(spark, "t-large")))
    a, b = C._two_batches(spark, sf001)
    pipe.ingest(a, C.P1)
    pipe.run(C.P1, [FACT])
    assert pipe.ingest(b, C.P2) == {"committed": 508, "rejected": 0}
    pipe.run(C.P2, [FACT])
    assert written == ["raw_earthquakes", "fct_earthquakes"] * 2  # and no directory of changes before the new base
    for t in (pipe.raw, pipe.fact):
        assert t.state()["commits"] == [] and t.state()["base_commit"] == t.state()["last"] == 2
    assert pipe.raw.read(since=1).count() == 508
    held = pipe.raw.state()
    assert pipe.ingest(b, C.P2)["committed"] == 0 and pipe.raw.state() == held and len(written) == 4


def test_days_without_keys_of_a_large_commit_stay_in_their_files(spark, monkeypatch):
    """Neither read whole nor written again, over several commits, with a column that comes later, rows without a time, a
    day that is rewritten after it stayed, and a fold of everything; all counts hold."""
    day = 86_400_000
    names = [f.name for f in RAW_SCHEMA.fields][:27]

    def feed(rows, title="t"):
        df = spark.createDataFrame(rows, "event_id string, event_time long, updated_time long, magnitude double")
        df = df.withColumns({"latitude": F.lit(1.0), "longitude": F.lit(2.0), "ingested_at": C.P1.run_ts_col(), "title": F.lit(title)})
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(RAW_SCHEMA[c].dataType).alias(c) for c in names])

    pipe = Pipeline(spark, TableStore(spark, scratch_path(spark, "t-stay")))
    pipe.ingest(feed([(f"e{i}", i % 20 * day, 5, 1.0) for i in range(60)] + [("none", None, 5, 1.0)], "x" * 501), C.P1)
    pipe.run(C.P1, [FACT])
    first = [pipe.raw.state()["base"], pipe.fact.state()["base"]]
    batches = (
        feed([(f"e{i}", i % 20 * day, 6, 2.0) for i in range(60) if i % 20 > 14] + [(f"n{i}", (20 + i % 5) * day, 6, 3.0) for i in range(20)]),
        feed([(f"e{i}", 22 * day, 7, 4.0) for i in range(0, 60, 20)] + [(f"m{i}", 30 * day, 7, 4.0) for i in range(30)]).withColumn("note", F.lit("later")),
        feed([("none", 3 * day, 8, 4.0)] + [(f"e{i}", i % 20 * day, 8, 5.0) for i in range(60) if i != 5] + [(f"m{i}", 30 * day, 8, 5.0) for i in range(30)]).withColumn("note", F.lit("last")),
    )
    written = []
    for n, (batch, params, kept) in enumerate(zip(batches, (C.P2, C.P3, C.P3), (1, 2, 0), strict=True)):
        want = inc.raw_upsert(pipe.raw_table(), batch, params)
        want = sorted(map(str, want.select(*sorted(want.columns)).collect()))
        old, held = pipe.fact.read(), pipe.raw.state()
        before = sorted(map(str, old.collect()))
        pipe.ingest(batch, params)
        got = pipe.raw_table()
        assert sorted(map(str, got.select(*sorted(got.columns)).collect())) == want
        keys = inc.increment_keys(pipe.staging(params), old)
        fact = merge.merge_upsert(old, inc.fact_increment(pipe.staging(params), old, keys), "event_id", update_cols=FACT_MERGE_UPDATE_COLUMNS)
        fact = sorted(map(str, fact.select(*old.columns).collect()))
        pipe.run(params, [FACT])
        assert sorted(map(str, pipe.fact.read().collect())) == fact
        assert sorted(map(str, old.collect())) == before  # readers of the state before still have it
        for t, start in zip((pipe.raw, pipe.fact), first, strict=True):
            s = t.state()
            assert len(s.get("kept", [])) == kept and (start in [k[0] for k in s.get("kept", [])]) == (kept > 0) and s["commits"] == []
            assert s["base_rows"] == t.read().count()
            written.append(spark.read.parquet(f"{t.root}/{s['base']}").count())
            assert {c: t.failures(c) for c in t.checks} == t.read().agg(*[F.count_if(x).alias(c) for c, x in t.checks.items()]).first().asDict()
        assert pipe.raw.read(since=held["last"]).count() == pipe.raw_table().where(F.col("updated_time") == 6 + n).count()
        if n == 0:  # what the fact's readers skip is told by dates too, which Parquet's bounds hold
            plan = pipe.fact.read().select("event_id")._jdf.queryExecution().optimizedPlan().toString()
            assert all(re.search(rf"event_date#\d+ {bound}", plan) for bound in ("< 1970-01-16", "> 1970-01-20"))
        if n == 1:  # a small commit over it, and a new base of all
            pipe.raw.commit(pipe.raw.read().where("event_id = 'e5'").withColumn("updated_time", F.lit(99).cast("long")).localCheckpoint())
            assert len(pipe.raw.state()["kept"]) == 2 and pipe.raw.read().count() == 111 and pipe.raw.read().where("updated_time = 99").count() == 1
            assert pipe.raw.staying([5], pipe.raw.state()) is None  # a commit lies over the files
            pipe.raw.compact()
            assert pipe.raw.state()["kept"] == [] and pipe.raw.read().count() == 111 == pipe.raw.state()["base_rows"]
    assert written[:4] == [35, 35, 34, 34]  # of 81 and 111
    monkeypatch.setattr(KeyedTable, "CURRENT_SHARE", 2)
    assert pipe.raw.staying([], pipe.raw.state()) is None
    monkeypatch.undo()
    assert pipe.raw.staying([], pipe.raw.state()).rows == 111 and pipe.raw.staying(None, pipe.raw.state()) is None


def test_a_second_writer_of_a_base_is_noticed(spark):
    store = TableStore(spark, scratch_path(spark, "t-two"))
    t = KeyedTable(store, "t", "k")
    rows = lambda *k: spark.createDataFrame([(i, i) for i in k], "k int, v int")
    t.rebuild(rows(1, 2))
    held = t.state()
    whole = t.read(with_commit=True)
    KeyedTable(store, "t", "k").commit(rows(3))
    with pytest.raises(RuntimeError, match="another writer"):
        t.commit_all(whole, held)
    assert t.read().count() == 3


def test_base_is_ranged_without_a_sample_of_whole_rows(spark, monkeypatch):
    """Even files whose dates don't overlap, but for one date in half of the rows and rows without a date."""
    monkeypatch.setattr(S, "ROWS_A_FILE", 100)
    monkeypatch.setattr(S, "ROWS_A_TASK", 100)
    t = KeyedTable(TableStore(spark, scratch_path(spark, "t-ranged")), "t", "k", order_by=["d"], checks={"odd": F.col("k") % 2 == 1, "none": F.col("k").isNull()})
    day = F.when(F.col("id") % 2 == 0, F.lit(dt.date(2024, 1, 5))).when(F.col("id") % 11 != 0, F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("id") % 700).cast("int")))
    rows = spark.range(2000).select(F.col("id").alias("k"), day.alias("d"))
    ranged = t._ranged(rows, rows)
    assert "rangepartitioning" not in _plan(ranged)
    t.rebuild(rows)
    assert t.failures("odd") == 1000 and t.failures("none") == 0
    assert sorted(map(str, t.read().collect())) == sorted(map(str, rows.collect()))
    files = [r for r in t.read().groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("low"), F.max("d").alias("high")).collect()]
    assert len(files) > 10 and max(f.n for f in files) <= 300
    spans = sorted((f.low, f.high) for f in files if f.low)
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))
    empty = KeyedTable(t.store, "e", "k", order_by=["d"])
    empty.rebuild(rows.limit(0))
    assert empty.read().count() == 0
