"""MERGE semantics: conditional update, inserts, stamps, dedupe, broadcast and shuffled joins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from epicentre.operators.incremental import raw_upsert
from epicentre.operators.merge import dedupe_latest, merge_rows, merge_upsert
from epicentre.params import RunParams
from epicentre.schemas import FEED_COLUMNS, RAW_SCHEMA

T0 = dt.datetime(2024, 1, 31, 0, 0)
T1 = dt.datetime(2024, 1, 31, 0, 5)


def _feed(spark, rows, stamp=T0):
    """rows: (event_id, magnitude, updated_time)."""
    df = spark.createDataFrame(rows, "event_id string, magnitude double, updated_time long")
    types = {f.name: f.dataType for f in RAW_SCHEMA.fields}
    cols = []
    for c in FEED_COLUMNS:
        if c in df.columns:
            cols.append(F.col(c))
        elif c == "ingested_at":
            cols.append(F.lit(stamp).cast("timestamp_ntz").alias(c))
        else:
            cols.append(F.lit(None).cast(types[c]).alias(c))
    return df.select(*cols)


@pytest.fixture(params=["10m", "-1"])
def joins(spark, request):
    """Spark's broadcast threshold: its default, and never."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_raw_upsert_rules(spark, joins):
    empty = spark.createDataFrame([], RAW_SCHEMA)
    first = _feed(spark, [("a", 1.0, 100), ("b", 2.0, 100), ("c", 3.0, None), ("d", 4.0, 100)])
    raw = raw_upsert(empty, first, RunParams.at(T0))
    second = _feed(
        spark,
        [("a", 1.5, 200), ("b", 2.5, 100), ("c", 3.5, 300), ("d", 4.5, None), ("e", 5.0, 50)],
        stamp=T1,
    )
    out = raw_upsert(raw, second, RunParams.at(T1))
    got = {r.event_id: r for r in out.collect()}
    assert set(got) == {"a", "b", "c", "d", "e"}
    # strictly newer: update, bump updated_at, keep ingest/create stamps
    assert got["a"].magnitude == 1.5 and got["a"].updated_at == T1
    assert got["a"].ingested_at == T0 and got["a"].created_at == T0
    # equal, null target, null source: no update
    assert got["b"].magnitude == 2.0 and got["b"].updated_at == T0
    assert got["c"].magnitude == 3.0
    assert got["d"].magnitude == 4.0
    # new key: inserted with the batch's stamps
    assert got["e"].created_at == T1 and got["e"].ingested_at == T1
    assert out.columns == [f.name for f in RAW_SCHEMA.fields]


def test_replay_is_noop(spark):
    empty = spark.createDataFrame([], RAW_SCHEMA)
    batch = _feed(spark, [("a", 1.0, 100), ("b", 2.0, 200)])
    once = raw_upsert(empty, batch, RunParams.at(T0))
    twice = raw_upsert(once, batch, RunParams.at(T1))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_dedupe_latest(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", 1, "m"), (None, 5, "k1"), (None, 6, "k2")],
        "k string, o int, v string",
    )
    got = sorted((r.k or "", r.o, r.v) for r in dedupe_latest(df, "k", "o").collect())
    # latest per key; rows without a key can't be merged and are left out
    assert got == [("a", 3, "y"), ("b", 1, "m")]


def test_dedupe_tie_is_deterministic(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y")], "k string, o int, v string")
    picks = {dedupe_latest(df.repartition(n), "k", "o").first().v for n in (1, 2, 3)}
    assert len(picks) == 1


def test_restricted_update_and_schema_evolution(spark):
    tgt = spark.createDataFrame([(1, "old", 10)], "id int, a string, b int")
    src = spark.createDataFrame([(1, "new", 20, "x"), (2, "ins", 30, "y")], "id int, a string, b int, extra string")
    out = merge_upsert(tgt, src, "id", update_cols=["a"])
    got = {r.id: r for r in out.collect()}
    assert out.columns == ["id", "a", "b", "extra"]
    assert (got[1].a, got[1].b, got[1].extra) == ("new", 10, None)  # only `a` updated
    assert (got[2].a, got[2].b, got[2].extra) == ("ins", 30, "y")
    rows = {r.id: r for r in merge_rows(tgt, src, "id").collect()}
    assert (rows[1].b, rows[1].extra) == (20, "x")


def test_small_source_leaves_the_target_unshuffled(spark, tmp_path):
    spark.range(1000).select(F.col("id").cast("int").alias("id"), F.lit("t").alias("v")).write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(1, "s")], "id int, v string").write.parquet(str(tmp_path / "s"))
    rows = merge_rows(spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s")), "id")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_random_inputs_row_by_row(spark, joins):
    """The merged table is what merging row by row gives, by either join."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    key = st.integers(0, 30)
    ts = st.one_of(st.none(), st.integers(0, 5))
    rows = st.lists(st.tuples(key, ts, st.integers(0, 9)), max_size=25, unique_by=lambda r: r[0])

    @settings(max_examples=12, deadline=None)
    @given(rows, rows)
    def check(trows, srows):
        tgt = spark.createDataFrame(trows, "k int, u int, v int")
        src = spark.createDataFrame(srows, "k int, u int, v int")

        out = merge_upsert(tgt, src, "k", condition=lambda t, s: s("u") > t("u"))
        got = sorted(tuple(r) for r in out.collect())
        # reference semantics, row by row
        t = {r[0]: r for r in trows}
        for k, u, v in srows:
            if k not in t:
                t[k] = (k, u, v)
            elif u is not None and t[k][1] is not None and u > t[k][1]:
                t[k] = (k, u, v)
        assert got == sorted(t.values())

    check()


def test_dedupe_sorts_after_the_shuffle_but_for_frequent_keys(spark, monkeypatch):
    from epicentre.operators import merge

    monkeypatch.setattr(merge, "FREQUENT_ROWS", 3)
    rows = [(f"k{i % 9}", i % 4, i) for i in range(27)] + [("hot", i % 5, i % 2) for i in range(40)] + [(None, 1, 1)] * 2
    df = spark.createDataFrame(rows, "k string, o int, v int")
    keys, none, often = merge.key_counts(df, "k")
    assert (keys, none, often) == (10, 2, ["hot"])
    want = sorted(map(tuple, dedupe_latest(df, "k", "o").collect()))
    for frequent in (often, [], ["k1", "absent"]):
        assert sorted(map(tuple, dedupe_latest(df, "k", "o", frequent).collect())) == want
    plan = dedupe_latest(df, "k", "o", [])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Aggregate" in plan and "Aggregate" not in plan.split("Exchange")[1]


def test_merge_by_given_keys_or_past_none(spark, joins):
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    src = spark.createDataFrame([(2, "B"), (4, "D")], "id int, v string")
    more = spark.createDataFrame([(2,), (3,), (4,), (9,)], "id int")
    for how in ({}, {"keys": more}, {"past_keys": False}):
        assert sorted(map(tuple, merge_rows(tgt, src, "id", **how).collect())) == [(2, "B"), (4, "D")]
