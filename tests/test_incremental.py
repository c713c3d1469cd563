"""Late-data laws of the incremental models (sf0.001 fixture batches)."""

import pytest
from pyspark.sql import functions as F

from epicentre.plans import catalog as C
from epicentre.plans.pipeline import DAILY, FACT, MissingTable, Pipeline
from epicentre.session import scratch_path
from epicentre.sources.store import KeyedTable, TableStore


def _two_runs(spark, sf, select, second=C.P2):
    pipe = Pipeline(spark, TableStore(spark, scratch_path(spark, "t-inc")))
    a, b = C._two_batches(spark, sf)
    pipe.ingest(a, C.P1)
    pipe.run(C.P1, select)
    first = {}
    if FACT in select:
        first[FACT] = pipe.fact.read()  # stays readable: commits never touch written files
    if DAILY in select:
        first[DAILY] = pipe.daily.read()
    pipe.ingest(b, second)
    return pipe, first, a, b


def test_batch_sizes_and_raw_merge(spark, sf001):
    pipe, first, a, b = _two_runs(spark, sf001, [FACT])
    # A: before 2024-01-21 (and no origin time); B: from 2024-01-11; overlap revised
    assert a.count() == 702 and b.count() == 648
    assert b.join(a.select("event_id"), "event_id").count() == 350
    assert a.unionByName(b).select("event_id").distinct().count() == 1000  # every event
    raw = pipe.raw_table()
    assert raw.count() == 1000
    changed = raw.join(a.select("event_id", F.col("magnitude").alias("m0")), "event_id").filter(
        ~F.col("magnitude").eqNullSafe(F.col("m0"))
    )
    assert changed.count() == 207  # newer and late revisions, never the stale ones


def test_fact_increment_skips_late_updates_and_keeps_stale_columns(spark, sf001):
    pipe, first, a, b = _two_runs(spark, sf001, [FACT])
    fct_a = first[FACT]
    stg_ab = pipe.staging(C.P2)
    from epicentre.operators.incremental import fact_increment

    taken = fact_increment(stg_ab, fct_a)
    assert taken.count() == 423
    newer = stg_ab.join(fct_a.select("event_id", F.col("updated_timestamp").alias("u0")), "event_id").filter(
        F.col("updated_timestamp") > F.col("u0")
    )
    assert newer.join(taken.select("event_id"), "event_id", "left_anti").count() == 73
    out = pipe.run(C.P2, [FACT])[FACT]
    assert out.count() == stg_ab.count()
    # the depth revision never reaches the fact (not a merge column), magnitude does
    from epicentre.sources.fixtures import A_BEFORE_MS, NEWER_NETWORKS

    upd = b.filter((F.col("event_time") < A_BEFORE_MS) & F.col("network").isin(*NEWER_NETWORKS)).select(
        "event_id", "magnitude", "depth_km")
    joined = out.join(upd.select("event_id", F.col("magnitude").alias("m1"), F.col("depth_km").alias("d1")), "event_id")
    assert joined.count() > 0
    assert joined.filter(F.col("magnitude") != F.col("m1")).count() == 0
    assert joined.filter(F.col("depth_km").isNotNull() & (F.col("depth_km") == F.col("d1"))).count() == 0


def test_daily_increment_window_and_empty_target(spark, sf001):
    pipe, first, a, b = _two_runs(spark, sf001, [FACT, DAILY])
    daily_a = first[DAILY]
    daily_ab = pipe.run(C.P2, [FACT, DAILY])[DAILY]
    assert daily_a.count() == 21 and daily_ab.count() == 31  # 20 days (+ null date), then 30 (+ null)
    refreshed = daily_ab.filter(F.col("dbt_updated_at") == C.P2.run_ts_col()).select("summary_date")
    # latest summary after run 1 is 2024-01-20: dates from the 19th on are recomputed,
    # the revised days 11-18 keep their run-1 numbers until a full refresh
    assert sorted(str(r[0]) for r in refreshed.collect()) == [f"2024-01-{d}" for d in range(19, 31)]
    # an existing but empty summary never fills
    from epicentre.operators.incremental import daily_increment

    empty = daily_a.limit(0)
    assert daily_increment(pipe.fact.read(), empty, C.P2).count() == 0


def test_daily_increment_writes_its_dates_only(spark, sf001):
    """Partitions of other dates keep their files; those of a reader stay; a repeated commit replaces its own."""
    pipe, first, a, b = _two_runs(spark, sf001, [FACT, DAILY])
    data = f"{pipe.daily.root}/data"
    before = {n: pipe.store.times(f"{data}/{n}") for n in pipe.store.names(data) if "=" in n}
    held = first[DAILY]
    pipe.run(C.P2, [FACT, DAILY])
    after = {n: pipe.store.times(f"{data}/{n}") for n in pipe.store.names(data) if "=" in n}
    changed = {n for n, t in after.items() if t != before.get(n)}
    assert changed == {f"summary_date=2024-01-{d}" for d in range(19, 31)} and len(before) == 21
    assert all(set(t) == {"__commit=1"} for n, t in after.items() if n not in changed)
    assert held.count() == 21  # read before the increment
    s = pipe.daily.state()
    rows = pipe.daily.read().where("summary_date = '2024-01-30'")
    for _ in range(2):  # as if the first had died before its manifest
        pipe.daily.commit(rows)
        pipe.store.remove(f"{pipe.daily.root}/manifests/{pipe.store.names(pipe.daily.root + '/manifests')[-1]}")
    assert pipe.daily.state() == s and pipe.daily.read().count() == 31
    pipe.daily.commit(rows)
    assert pipe.daily.read().count() == 31 and pipe.daily.read().where("summary_date is null").count() == 1


def test_partition_cleaning_goes_by_age(spark):
    import datetime as dt

    from epicentre.sources.store import PartitionedTable

    store = TableStore(spark, scratch_path(spark, "t-part"), keep_for=dt.timedelta(hours=6))
    t = PartitionedTable(store, "t", "d")
    rows = lambda v, *ds: spark.createDataFrame([(d, v) for d in ds], "d string, v int")
    t.commit(rows(1, "a", "b"), replace_all=True)
    t.commit(rows(2, "b"))
    t.commit(rows(3, "b", "c"))
    _age(store, t.root, 24)
    t.commit(rows(4, "c").selectExpr("d", "v", "v * 10 as w"))
    assert {(r.d, r.v, r.w) for r in t.read().collect()} == {("a", 1, None), ("b", 3, None), ("c", 4, 40)}
    assert store.names(f"{t.root}/data/d=b") == ["__commit=3"]
    assert store.names(f"{t.root}/data/d=c") == ["__commit=3", "__commit=4"]  # replaced just now
    t.commit(rows(5, "a"), replace_all=True)
    assert [(r.d, r.v) for r in t.read().collect()] == [("a", 5)] and t.read().columns == ["d", "v"]


def test_full_refresh_equals_one_shot_build(spark, sf001):
    pipe, first, a, b = _two_runs(spark, sf001, [FACT, DAILY])
    refreshed = pipe.run(C.P2, [FACT, DAILY], full_refresh=True)
    from epicentre.operators.marts import daily_summary, fct_events

    one_shot = fct_events(pipe.staging(C.P2))
    cols = [c for c in one_shot.columns if c != "dbt_updated_at"]
    assert refreshed[FACT].select(cols).exceptAll(one_shot.select(cols)).count() == 0
    assert one_shot.select(cols).exceptAll(refreshed[FACT].select(cols)).count() == 0
    d1 = daily_summary(one_shot, C.P2)

    def rounded(df):  # summation order differs between layouts
        return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])

    assert rounded(refreshed[DAILY]).exceptAll(rounded(d1)).count() == 0


def test_commits_hold_only_what_changed(spark, sf001):
    pipe = Pipeline(spark, TableStore(spark, scratch_path(spark, "t-replay")))
    a, b = C._two_batches(spark, sf001)
    pipe.raw.MAX_SHARE = 10  # no compaction here
    assert pipe.ingest(a, C.P1) == {"committed": 702, "rejected": 0}
    before = pipe.raw.read()
    assert pipe.ingest(b, C.P2)["committed"] == 298 + 210  # new, and strictly newer
    held = pipe.raw.state()
    assert pipe.ingest(b, C.P2)["committed"] == 0  # the same snapshot again
    assert pipe.raw.state() == held
    some = pipe.raw_table().orderBy("event_id").limit(100).withColumn("updated_time", F.col("updated_time") + 10**13)
    some = pipe.store.scratch("some", some)
    assert pipe.ingest(some.drop("created_at", "updated_at"), C.P2)["committed"] == 100
    assert pipe.raw.state()["commits"][-1][2] == 100
    assert before.count() == 702 and before.agg(F.max("updated_at")).first()[0] == C.P1.run_ts  # read before, still whole


def test_compaction_keeps_rows_and_numbers(spark):
    store = TableStore(spark, scratch_path(spark, "t-compact"))
    t = KeyedTable(store, "t", "k")
    rows = lambda *r: spark.createDataFrame(r, "k int, v string")
    t.rebuild(rows((1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")))
    for i in range(6):
        t.commit(rows((i, f"x{i}")))
    assert {r.k: r.v for r in t.read().collect()} == {0: "x0", 1: "x1", 2: "x2", 3: "x3", 4: "x4", 5: "x5"}
    assert t.state()["last"] == 7 and len(t.state()["commits"]) < 6  # grown past its share, and compacted
    assert {r.k for r in t.read(since=5).collect()} == {4, 5}
    t.compact()
    assert t.state()["commits"] == [] and {r.k for r in t.read(since=5).collect()} == {4, 5}


def test_small_commits_are_folded_and_never_rewrite_the_base(spark):
    """200 commits of one row over 20,000: each row is folded once for each order of size."""
    store = TableStore(spark, scratch_path(spark, "t-fold"))
    t = KeyedTable(store, "t", "k")
    t.rebuild(spark.range(20_000).selectExpr("id as k", "'base' as v"))
    base, written, plain = t.state()["base"], [], t._write

    def counted(df, ordered):
        out = plain(df, ordered)
        written.append(out[1])  # rows
        return out

    t._write = counted
    keys = [(i * 37) % 150 if i % 4 else 20_000 + i for i in range(200)]  # some come again, some are new
    for i, k in enumerate(keys):
        assert t.commit(spark.range(k, k + 1, 1, 1).selectExpr("id as k", f"'c{i}' as v")) == 1
    s = t.state()
    assert s["base"] == base and s["last"] == 201 and max(written) <= 200
    assert sum(written) <= 200 * (1 + 3) and len(s["commits"]) <= 3 * (t.FOLD - 1)  # 200 < FOLD ** 3
    want = {k: "base" for k in range(20_000)} | {k: f"c{i}" for i, k in enumerate(keys)}
    assert {r.k: r.v for r in t.read().collect()} == want
    later = {k: f"c{i}" for i, k in enumerate(keys) if i >= 120}
    assert {r.k: r.v for r in t.read(since=121).collect()} == later


def _age(store, path, hours):
    """Make files (and folders) look older."""
    import os
    import pathlib

    root = pathlib.Path(path.removeprefix("file:"))
    for p in [root, *root.rglob("*")]:
        then = p.stat().st_mtime - hours * 3600
        os.utime(p, (then, then))


def test_retention_goes_by_age(spark):
    import datetime as dt

    store = TableStore(spark, scratch_path(spark, "t-age"), keep_for=dt.timedelta(hours=6))
    t = KeyedTable(store, "t", "k")
    t.MAX_SHARE = 100
    row = lambda i: spark.range(i, i + 1, 1, 1).selectExpr("id as k")
    t.rebuild(row(0))
    held = t.read()
    for i in range(1, 20):
        t.commit(row(i))
    assert held.count() == 1 and len([n for n in store.names(f"{t.root}/manifests") if n.endswith(".json")]) >= 20
    dead = store.times(t.root)  # with what folding has replaced
    _age(store, t.root, 24)
    t.rebuild(row(100))
    manifests = [n for n in store.names(f"{t.root}/manifests") if n.endswith(".json")]
    left = store.names(t.root)
    # the state before the rebuild was replaced just now: its files stay
    assert len(manifests) == 2 and len(left) < len(dead) and t.read().count() == 1
    store.write("p", row(1))
    store.write("p", row(2))
    assert store.names(f"{store.root}/p") == ["v000001", "v000002"]
    _age(store, f"{store.root}/p", 24)
    store.write("p", row(3))
    assert store.names(f"{store.root}/p") == ["v000002", "v000003"]


def test_scratch_belongs_to_its_run(spark):
    import datetime as dt

    root = scratch_path(spark, "t-own")
    one, two = TableStore(spark, root), TableStore(spark, root, keep_for=dt.timedelta(hours=6))
    held = one.scratch("x", spark.range(3))
    with two.run() as run:
        run.write("y", spark.range(4))
    two.scratch("z", spark.range(5))
    two.drop_scratch()
    assert held.count() == 3  # other runs came and went
    _age(one, f"{root}/_scratch", 7)
    with two.run():
        assert len(two.names(f"{root}/_scratch")) == 1  # what a dead run left has expired
    one.drop_scratch()
    assert two.names(f"{root}/_scratch") == []


def test_build_beside_an_ingest_of_another_process(spark, sf001, tmp_path):
    """Both schedules at once, each in its own process, over one warehouse; then one more build."""
    import os
    import subprocess
    import sys

    from epicentre.sources import feed as fd

    a, b = C._two_batches(spark, sf001)
    root = str(tmp_path / "w")
    pipe = Pipeline(spark, TableStore(spark, root))
    pipe.ingest(a, C.P1)
    parts = [b.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == i) for i in range(3)]
    for i, p in enumerate(parts):
        fd.write_snapshot(p, str(tmp_path / f"s{i}"))
    code = (
        "import sys\nsys.path.insert(0, sys.argv[1])\nfrom epicentre.__main__ import main\n"
        "for i in range(3):\n    assert main(['ingest', '--warehouse', sys.argv[2], '--snapshots', f'{sys.argv[3]}/s{i}/part-*', '--run-ts', '2024-01-31 00:05:00']) == 0\n")
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    other = subprocess.Popen([sys.executable, "-c", code, here, root, str(tmp_path)], stdout=subprocess.PIPE, stderr=subprocess.STDOUT)
    builds = 0
    while other.poll() is None:
        pipe.run(C.P1)
        builds += 1
    assert other.returncode == 0, other.stdout.read().decode()[-2000:]
    last = pipe.run(C.P2)
    assert builds >= 1 and pipe.raw_table().count() == 1000
    assert last[FACT].count() == 980
    assert pipe.run(C.P2, full_refresh=True)["agg_regional_risk"].count() > 0


def test_failure_before_the_switch_leaves_the_old_table(spark, sf001, monkeypatch):
    pipe = Pipeline(spark, TableStore(spark, scratch_path(spark, "t-crash")))
    a, b = C._two_batches(spark, sf001)
    pipe.ingest(a, C.P1)
    pipe.run(C.P1, [FACT])

    def crash(*_):
        raise OSError("lost before the switch")

    with monkeypatch.context() as m:
        m.setattr(TableStore, "create_text", crash)
        with pytest.raises(OSError, match="lost"):
            pipe.ingest(b, C.P2)
    assert pipe.raw_table().count() == 702
    assert pipe.ingest(b, C.P2)["committed"] == 508  # again, and whole
    with monkeypatch.context() as m:
        m.setattr(TableStore, "create_text", crash)
        with pytest.raises(OSError, match="lost"):
            pipe.run(C.P2, [FACT])
    out = pipe.run(C.P2, [FACT])[FACT]
    assert out.count() == pipe.staging(C.P2).count()


def test_two_writers_are_noticed(spark):
    store = TableStore(spark, scratch_path(spark, "t-two"))
    t = KeyedTable(store, "t", "k")
    t.rebuild(spark.createDataFrame([(1,)], "k int"))
    with pytest.raises(RuntimeError, match="another writer"):
        store.create_text(f"{t.root}/manifests/00000001.json", "{}")


def test_rows_without_a_key_are_rejected_and_counted(spark, sf001):
    pipe = Pipeline(spark, TableStore(spark, scratch_path(spark, "t-null")))
    a, _ = C._two_batches(spark, sf001)
    five = a.orderBy("event_code").limit(5).withColumn("event_id", F.lit(None).cast("string"))
    for _ in range(3):
        done = pipe.ingest(a.unionByName(five), C.P1)
        assert done["rejected"] == 5 and pipe.raw_table().count() == 702
        assert pipe.rejected().count() == 5  # once, however often they come


def test_rejects_of_many_batches_are_written_once(spark, sf001):
    """50 polls of a rolling feed, each with the same rows without a key and one new one; some are replayed."""
    pipe = Pipeline(spark, TableStore(spark, scratch_path(spark, "t-rejects")))
    feed = C._feed(spark, sf001).orderBy("event_code").limit(60).withColumn("event_id", F.lit(None).cast("string"))
    rows = feed.collect()
    written = 0
    for n in range(50):
        batch = spark.createDataFrame(rows[n : n + 10], feed.schema).withColumn("ingested_at", F.lit(f"2024-01-31 00:00:{n:02d}").cast("timestamp_ntz"))
        new = pipe.rejects.append(batch.withColumn("row_hash", F.sha2(F.to_json(F.struct(*sorted(c for c in batch.columns if c != "ingested_at"))), 256)))
        written += new
        assert new == (10 if n == 0 else 1)
    assert written == pipe.rejected().count() == 59
    assert len(pipe.store.names(pipe.rejects.root)) == 50  # a directory for each, and none written again


def test_a_failed_batch_leaves_its_rejects_once(spark, sf001, monkeypatch):
    pipe = Pipeline(spark, TableStore(spark, scratch_path(spark, "t-reject-crash")))
    a, b = C._two_batches(spark, sf001)
    pipe.ingest(a, C.P1)
    bad = b.withColumn("event_id", F.when(F.col("network") != "cl", F.col("event_id")))
    lost = bad.where("event_id is null").count()

    def crash(*_):
        raise OSError("lost before the switch")

    with monkeypatch.context() as m:
        m.setattr(TableStore, "create_text", crash)
        with pytest.raises(OSError, match="lost"):
            pipe.ingest(bad, C.P2)
    assert pipe.ingest(bad, C.P2)["rejected"] == lost == pipe.rejected().count() > 0


def test_missing_parents_raise(spark, sf001):
    pipe = Pipeline(spark, TableStore(spark, scratch_path(spark, "t-missing")))
    with pytest.raises(MissingTable, match="raw"):
        pipe.run(C.P1, [FACT])
    a, _ = C._two_batches(spark, sf001)
    pipe.ingest(a, C.P1)
    with pytest.raises(MissingTable, match="fct"):
        pipe.run(C.P1, [DAILY])
    with pytest.raises(MissingTable):
        pipe.table(DAILY)
    assert {r.status for r in pipe.quality_report(C.P1).collect() if r.table_name == DAILY} == {"fail"}


def test_new_columns_survive_commits_and_compaction(spark, sf001):
    pipe = Pipeline(spark, TableStore(spark, scratch_path(spark, "t-columns")))
    pipe.raw.MAX_SHARE = 10
    a, b = C._two_batches(spark, sf001)
    pipe.ingest(a, C.P1)
    pipe.ingest(b.withColumn("note", F.lit("n")), C.P2)
    one = pipe.raw_table().where("note = 'n'").limit(1).withColumn("updated_time", F.col("updated_time") + 10**13)
    one = pipe.store.scratch("one", one.drop("created_at", "updated_at", "note"))
    pipe.ingest(one, C.P3)
    assert pipe.raw_table().where("note = 'n'").count() == 508
    pipe.raw.compact()
    assert pipe.raw_table().where("note = 'n'").count() == 508


def test_earlier_stamps_lose_no_rows(spark, sf001):
    pipe, first, a, b = _two_runs(spark, sf001, [FACT], second=C.P0)
    out = pipe.run(C.P0, [FACT])[FACT]
    assert out.count() == 980 == pipe.staging(C.P0).count()


def test_backfill_then_stream_chained_transform(spark, sf001):
    import datetime as dt

    from epicentre.sources import feed as fd
    from epicentre.streaming.ingest import start_ingest

    root = scratch_path(spark, "t-chain")
    a, b = C._two_batches(spark, sf001)
    store = TableStore(spark, f"{root}/tables")
    pipe = Pipeline(spark, store)
    pipe.backfill(a, C.P1, min_magnitude=0.0)
    assert pipe.raw_table().count() == a.filter(F.col("event_time").isNotNull() & F.col("magnitude").isNotNull()).count()
    fd.write_snapshot(b, f"{root}/landing/s0")
    q = start_ingest(spark, f"{root}/landing/*/part-*", store, f"{root}/ckpt", lambda epoch: C.P2, available_now=True,
                     transform_every=dt.timedelta(minutes=10))
    q.awaitTermination()
    tables = pipe.tables()
    assert {"fct_earthquakes", "agg_daily_summary", "agg_regional_risk", "agg_hourly_heatmap"} <= set(tables)
    assert tables["fct_earthquakes"].count() == pipe.staging(C.P2).count()


def test_only_later_commits_are_candidates(spark, sf001):
    from epicentre.operators.incremental import fact_increment

    pipe, first, a, b = _two_runs(spark, sf001, [FACT])
    pipe.run(C.P2, [FACT])
    fct2 = pipe.fact.read()
    assert pipe.raw.read(since=pipe.fact.notes()["raw_commit"]).count() == 0
    pipe.run(C.P3, [FACT])  # nothing new
    assert pipe.fact.read().exceptAll(fct2).count() == 0
    # one newer revision is taken, exactly as the full rule takes it
    row = pipe.raw_table().filter(F.col("event_id") == "ev8").withColumn(
        "updated_time", F.col("updated_time") + 10**12).withColumn("magnitude", F.lit(7.25))
    row = pipe.store.scratch("row", row.drop("created_at", "updated_at"))
    pipe.ingest(row, C.P3)
    expected = fact_increment(pipe.staging(C.P3), fct2)
    assert [r.event_id for r in expected.collect()] == ["ev8"]
    pipe.run(C.P3, [FACT])
    got = pipe.fact.read().filter(F.col("event_id") == "ev8").first()
    old = fct2.filter(F.col("event_id") == "ev8").first()
    # magnitude is a merge column; its category is not and keeps the first load's value
    assert got.magnitude == 7.25 and got.magnitude_category == old.magnitude_category != "major"


def test_incremental_fact_is_zone_free(spark, sf001):
    """Watermark and time conversions do not depend on the session time zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        pipe, first, a, b = _two_runs(spark, sf001, [FACT])
        out = pipe.run(C.P2, [FACT])[FACT]
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        pipe_utc, _, _, _ = _two_runs(spark, sf001, [FACT])
        ref = pipe_utc.run(C.P2, [FACT])[FACT]
        assert out.exceptAll(ref).count() == 0 and ref.exceptAll(out).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_a_large_batch_is_written_once(spark, sf001, monkeypatch):
    """A first batch, and one with a large share of the stored keys, go to raw without an intermediate table; so
    does the fact's increment, but for its keys."""
    from epicentre.sources.store import Scratch

    written, plain = [], Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, name, df: (written.append(name), plain(self, name, df))[1])
    pipe = Pipeline(spark, TableStore(spark, scratch_path(spark, "t-once")))
    a, b = C._two_batches(spark, sf001)
    assert pipe.ingest(a, C.P1) == {"committed": 702, "rejected": 0}
    pipe.run(C.P1, [FACT])
    assert pipe.ingest(b, C.P2)["committed"] == 508
    assert written == []
    assert pipe.ingest(b.limit(5), C.P2)["committed"] == 0 and written == ["latest"]
    assert pipe.run(C.P2, [FACT])[FACT].count() == 980 and written == ["latest", "increment-keys"]
