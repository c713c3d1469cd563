"""Data-quality checks detect duplicates, nulls and over-long text."""

from pyspark.sql import functions as F

from epicentre.operators import quality


def test_checks_count_failures(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("b", 2.0), (None, 3.0), ("c" * 60, 1.0)], "event_id string, magnitude double"
    )
    u = quality.unique_failures(df, "t", "event_id").first()
    assert u.failures == 1  # one duplicated value; null ignored
    nn = {r.column_name: r.failures for r in quality.not_null_failures(df, "t", ["event_id", "magnitude"]).collect()}
    assert nn == {"event_id": 1, "magnitude": 1}
    ln = {r.column_name: r.failures for r in quality.length_failures(df, {"event_id": 50}).collect()}
    assert ln == {"event_id": 1}


def test_report_passes_on_fixture(spark, sf001):
    from epicentre.plans import catalog as C

    rep = {(r.table_name, r.column_name, r.check_name): r for r in quality.dq_report(C._tables(spark, sf001), spark).collect()}
    assert len(rep) == 28
    # staging lets null event times through, so this declared test really fails
    assert rep[("stg_earthquakes", "event_timestamp", "not_null")].status == "fail"
    assert rep[("fct_earthquakes", "event_id", "unique")].status == "pass"


def test_absent_tables_fail(spark, sf001):
    from epicentre.plans import catalog as C

    raw = C._tables(spark, sf001)["raw_earthquakes"]
    rep = quality.dq_report({"raw_earthquakes": raw}, spark).collect()
    assert len(rep) == 28
    assert all((r.status == "fail" and r.failures is None) == (r.table_name != "raw_earthquakes") for r in rep)


def test_checks_of_writes_read_keys_only(spark, sf001):
    """After a small commit nothing of raw and fact is read but keys; failures that can't be told are counted."""
    from epicentre.plans import catalog as C
    from epicentre.plans.pipeline import FACT, RAW

    pipe = C._fresh(spark)
    pipe.ingest(C._feed(spark, sf001).where("event_time is not null"), C.P1)
    pipe.run(C.P1)
    row = pipe.raw_table().where("event_id = 'ev8'").withColumn("updated_time", F.col("updated_time") + 10**13).drop("created_at", "updated_at")
    pipe.ingest(pipe.store.scratch("row", row), C.P3)
    pipe.run(C.P3)
    of_writes = pipe.quality_report(C.P3, from_writes=True)
    plan = of_writes._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    scans = [x for x in plan.split("Scan parquet")[1:] if "Location: " in x.split("\n\n")[0]]
    assert any(FACT in x for x in scans) and any(RAW in x for x in scans)
    for scan in scans:
        place, schema = scan.split("Location: ")[1].split("\n")[0], scan.split("ReadSchema: ")[1].split("\n")[0]
        if RAW in place or FACT in place:
            assert schema in ("struct<event_id:string>", "struct<event_id:string,__commit:bigint>", "struct<>"), (place, schema)
    same = lambda a, b: a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert same(of_writes, pipe.quality_report(C.P3))
    # a title that is too long, in one row and then in none
    for title, failed in (("x" * 600, 1), ("short", 0)):
        late = row.withColumns({"updated_time": F.col("updated_time") + 10**13 * (3 - failed), "title": F.lit(title)})
        pipe.ingest(pipe.store.scratch("late", late), C.P3)
        got = {(r.table_name, r.column_name, r.check_name): r.failures for r in pipe.quality_report(C.P3, from_writes=True).collect()}
        assert got[RAW, "title", "max_length"] == failed
    assert pipe.raw.failures("title__max_length") in (None, 0)
