"""The command line drives ingest -> build -> check over a warehouse folder."""

from epicentre.__main__ import main
from epicentre.plans import catalog as C
from epicentre.plans.pipeline import Pipeline
from epicentre.session import scratch_path
from epicentre.sources import feed as fd
from epicentre.sources.store import TableStore


def test_cli_ingest_build_check(spark, sf001):
    root = scratch_path(spark, "t-cli")
    a, b = C._two_batches(spark, sf001)
    fd.write_snapshot(a, f"{root}/landing/s0")
    fd.write_snapshot(b, f"{root}/landing/s1")
    wh = f"{root}/warehouse"
    ts = ["--run-ts", "2024-01-31T00:00:00", "--as-of", "2024-01-31"]
    assert main(["ingest", "--warehouse", wh, "--snapshots", f"{root}/landing/s0", *ts]) == 0
    assert main(["build", "--warehouse", wh, *ts]) == 0
    assert main(["ingest", "--warehouse", wh, "--snapshots", f"{root}/landing/s1",
                 "--run-ts", "2024-01-31T00:05:00"]) == 0
    assert main(["build", "--warehouse", wh, "--run-ts", "2024-01-31T00:05:00", "--as-of", "2024-01-31",
                 "--select", "fct_earthquakes", "agg_daily_summary"]) == 0
    # staging lets null event times through, so a declared not_null test fails
    assert main(["check", "--warehouse", wh, "--as-of", "2024-01-31"]) == 1
    pipe = Pipeline(spark, TableStore(spark, wh))
    assert pipe.raw_table().count() == 1000
    assert pipe.fact.read().count() == pipe.staging(C.P2).count()
    report = {(r.table_name, r.column_name, r.check_name): r.status for r in pipe.quality_report(C.P2).collect()}
    assert report[("fct_earthquakes", "event_id", "unique")] == "pass"


def test_cli_backfill_has_no_cap(spark, capsys):
    """More rows than one request of the feed's service would return."""
    from pyspark.sql import functions as F

    from epicentre.sources.fixtures import feed_from_events, read_table

    root = scratch_path(spark, "t-backfill")
    fd.write_snapshot(feed_from_events(read_table(spark, "/root/testdata/sf0.1", "events"), C.P1), f"{root}/history")
    args = ["backfill", "--warehouse", f"{root}/w", "--snapshots", f"{root}/history", "--run-ts", "2024-01-31T00:00:00"]
    assert main([*args, "--min-magnitude", "2.5"]) == 0
    raw = Pipeline(spark, TableStore(spark, f"{root}/w")).raw_table()
    n = raw.count()
    assert n > 20_000 and f"{n} rows committed" in capsys.readouterr().out
    assert raw.agg(F.min("magnitude")).first()[0] >= 2.5
    assert main([*args, "--start", "2024-01-05", "--end", "2024-01-06", "--min-magnitude", "0"]) == 0
    assert Pipeline(spark, TableStore(spark, f"{root}/w")).raw_table().count() > n


def test_cli_stream_of_a_document_as_served(spark):
    import json

    root = scratch_path(spark, "t-cli-stream")
    doc = {"type": "FeatureCollection", "features": [{"id": "x", "properties": {"mag": 3.0, "updated": 5}, "geometry": {"coordinates": [1, 2, 3]}}]}
    path = root.removeprefix("file:") + "/landing"
    import os

    os.makedirs(path)
    with open(f"{path}/one.json", "w") as f:
        json.dump(doc, f, indent=2)
    assert main(["stream", "--warehouse", f"{root}/w", "--landing", f"{root}/landing/*", "--checkpoint", f"{root}/c", "--files-per-trigger", "1", "--available-now"]) == 0
    assert [r.event_id for r in Pipeline(spark, TableStore(spark, f"{root}/w")).raw_table().collect()] == ["x"]
