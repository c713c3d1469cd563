"""Physical-plan properties that matter at scale."""

from epicentre.operators import serving
from epicentre.operators.marts import daily_summary, regional_stats
from epicentre.plans import catalog as C


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_serving_read_pushes_filters_and_prunes_columns(spark, sf001):
    pipe, _ = C._pipeline(spark, sf001, ["marts"], second_run=False)
    fct = pipe.fact.read()
    df = serving.recent_events(fct, C.P1)
    plan = _formatted(df)
    assert "GreaterThanOrEqual(event_date" in plan and "GreaterThanOrEqual(magnitude" in plan
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "title" not in read_schema and "detail_url" not in read_schema
    views = pipe.register_views(C.P1)
    assert "fct_earthquakes" in views
    assert spark.sql("select count(*) from fct_earthquakes").first()[0] == fct.count()


def test_marts_are_one_scan_with_partial_aggregation(spark, sf001):
    fct = C._fct(spark, sf001)
    for df in (daily_summary(fct, C.P1), regional_stats(fct, C.P1)):
        plan = _plan(df)
        assert "partial_count" in plan
        # one scan, no join; the only sort is that of counted cells by value, above the shuffle of their counts
        assert plan.count("Scan parquet") == 1 and "Join" not in plan and plan.count("+- Window") == 1
        assert plan.index("Window") < plan.index("Exchange hashpartitioning", plan.index("Window")) < plan.index("partial_count")


def test_checks_scan_a_table_once_for_all_counts(spark, sf001):
    from epicentre.operators import quality

    tables = C._tables(spark, sf001)
    plan = _plan(quality.dq_counts(tables, spark))
    # the daily table's only checked column, and its newest commits, are names of partitions: no column of a file is read
    names_only = plan.count("ReadSchema: struct<>")
    assert plan.count("Scan parquet") - names_only == len(quality.NOT_NULL_CHECKS) - 1 and names_only >= 1


def test_increment_reads_only_later_commits(spark, sf001):
    pipe, _ = C._pipeline(spark, sf001, ["fct_earthquakes"], second_run=False)
    pipe.raw.MAX_SHARE = 10  # no compaction
    state = pipe.raw.state()
    seen = pipe.fact.notes()["raw_commit"]
    later = pipe.raw.read(since=seen)
    assert later.inputFiles() and all(any(c[0] in f for c in state["commits"] if c[1] > seen) or state["base_commit"] > seen for f in later.inputFiles())
    pipe.raw.compact()
    assert "GreaterThan(__commit," in _formatted(pipe.raw.read(since=seen, with_commit=True))
    assert pipe.raw.read(since=seen).exceptAll(later).count() == 0


def test_top_k_is_take_ordered(spark, sf001):
    risk = C._warehouse(spark, sf001).table("agg_regional_risk")
    assert "TakeOrderedAndProject" in _plan(serving.top_risk(risk, 50))


def test_fact_increment_shuffles_keys_only(spark, sf001):
    from epicentre.operators.incremental import increment_keys

    stg = C._stg(spark, sf001)
    plan = _plan(increment_keys(stg, C._fct(spark, sf001)))
    assert "NestedLoop" not in plan and "detail_url" not in plan and "title" not in plan
