"""GeoJSON flattening edge cases, document round trip, back-fill slice."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from epicentre.params import RunParams
from epicentre.plans import catalog as C
from epicentre.schemas import FEED_COLUMNS
from epicentre.sources import feed as fd
from epicentre.session import scratch_path
from epicentre.sources.store import TableStore

STAMP = dt.datetime(2024, 1, 31)


def _docs(spark, docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")


def test_flatten_edge_cases(spark):
    docs = [
        {"type": "FeatureCollection", "features": [
            {"id": "full", "properties": {"mag": 4.5, "place": "x", "time": 1, "updated": 2, "nst": 7,
                                          "magType": "ml", "unknown": 1},
             "geometry": {"type": "Point", "coordinates": [1.0, 2.0, 3.0]}},
            {"id": "noprops", "geometry": {"coordinates": [1.0]}},
            {"id": "two", "properties": {}, "geometry": {"coordinates": [5.0, 6.0]}},
            {"id": "empty", "properties": {}, "geometry": {"coordinates": []}},
            {"id": "nogeom", "properties": {"mag": 1.0}, "geometry": None},
        ]},
        {"type": "FeatureCollection", "features": []},
    ]
    out = fd.flatten(fd.parse_collections(_docs(spark, docs)), F.lit(STAMP).cast("timestamp_ntz"))
    assert out.columns == FEED_COLUMNS
    got = {r.event_id: r for r in out.collect()}
    assert len(got) == 5
    f = got["full"]
    assert (f.magnitude, f.mag_type, f.num_stations, f.event_time, f.updated_time) == (4.5, "ml", 7, 1, 2)
    assert (f.longitude, f.latitude, f.depth_km, f.ingested_at) == (1.0, 2.0, 3.0, STAMP)
    assert (got["noprops"].magnitude, got["noprops"].longitude, got["noprops"].latitude) == (None, 1.0, None)
    assert (got["two"].latitude, got["two"].depth_km) == (6.0, None)
    assert got["empty"].longitude is None
    assert got["nogeom"].magnitude == 1.0 and got["nogeom"].longitude is None


def test_documents_round_trip_and_bounded_size(spark, sf001):
    from epicentre.sources.fixtures import feed_from_events, read_table

    feed = feed_from_events(read_table(spark, sf001, "events"), RunParams.at(STAMP))
    docs = fd.to_documents(feed, per_document=100)
    sizes = docs.select(F.size(F.from_json("value", "features array<string>").features).alias("n"))
    assert sizes.count() == 10 and sizes.agg(F.max("n")).first()[0] < 200
    back = fd.flatten(fd.parse_collections(docs), F.lit(STAMP).cast("timestamp_ntz"))
    assert back.exceptAll(feed).count() == 0 and feed.exceptAll(back).count() == 0


def test_written_snapshot_reads_back(spark, sf001):
    from epicentre.sources.fixtures import feed_from_events, read_table

    feed = feed_from_events(read_table(spark, sf001, "events"), RunParams.at(STAMP))
    path = scratch_path(spark, "t-snap")
    fd.write_snapshot(feed, path)
    back = fd.flatten(fd.accepted(fd.parse_documents(fd.read_documents(spark, path))), F.lit(STAMP).cast("timestamp_ntz"))
    assert back.count() == feed.count()


def test_backfill_slice(spark):
    rows = [(f"e{i}", float(i % 5), 1704067200000 + i * 1000) for i in range(50)]
    hist = spark.createDataFrame(rows, "event_id string, magnitude double, event_time long")
    assert fd.backfill_slice(hist, RunParams.at(STAMP), min_magnitude=2.5).count() == 20  # all, without a limit
    assert "Sort" not in fd.backfill_slice(hist, RunParams.at(STAMP))._jdf.queryExecution().executedPlan().toString()
    out = fd.backfill_slice(hist, RunParams.at(STAMP), min_magnitude=2.5, limit=7).collect()
    assert len(out) == 7 and all(r.magnitude >= 2.5 for r in out)
    assert [r.event_time for r in out] == sorted(r.event_time for r in out)
    assert out[0].event_id == "e3"


ONE = {"type": "FeatureCollection", "features": [{"id": "a", "properties": {"mag": 1.0}, "geometry": None}, {"id": "b"}]}


def _read(spark, folder):
    return fd.parse_documents(fd.read_documents(spark, str(folder)))


def _ids(docs):
    return sorted(r.event_id for r in fd.flatten(docs, F.lit(STAMP).cast("timestamp_ntz")).collect())


@pytest.mark.parametrize("text", [json.dumps(ONE), json.dumps(ONE, indent=2), json.dumps(ONE, indent=2).replace("\n", "\r\n"), "\n" + json.dumps(ONE) + "\n\n"])
def test_any_layout_of_one_document(spark, tmp_path, text):
    (tmp_path / "feed.json").write_text(text)
    assert _ids(fd.accepted(_read(spark, tmp_path))) == ["a", "b"]


def test_json_lines(spark, tmp_path):
    (tmp_path / "feed.json").write_text(json.dumps(ONE) + "\n" + json.dumps(ONE))
    assert _ids(fd.accepted(_read(spark, tmp_path))) == ["a", "a", "b", "b"]


@pytest.mark.parametrize("bad", [json.dumps(ONE)[:-5], json.dumps(ONE, indent=2)[:-9], " ", "no json", "[1]", "{}", json.dumps({"features": None}), json.dumps(ONE).replace("1.0", '"high"')])
def test_malformed_documents_are_raised_or_handed_back(spark, tmp_path, bad):
    (tmp_path / "bad.json").write_text(bad)
    (tmp_path / "good.json").write_text(json.dumps(ONE))
    docs = _read(spark, tmp_path)
    assert [r.malformed for r in fd.rejects(docs).collect()] == [bad]
    assert _ids(docs) == ["a", "b"]
    with pytest.raises(Exception, match="a feed document can't be read"):
        _ids(fd.accepted(docs))


def test_only_the_malformed_line_is_handed_back(spark, tmp_path):
    (tmp_path / "feed.json").write_text(json.dumps(ONE) + "\n" + json.dumps(ONE)[:30] + "\n" + json.dumps(ONE))
    docs = _read(spark, tmp_path)
    assert _ids(docs) == ["a", "a", "b", "b"] and fd.rejects(docs).count() == 1


def test_layouts_side_by_side(spark, tmp_path):
    """Files of every layout in one folder, with names that a pattern would read otherwise."""
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(ONE) for _ in range(3)) + "\n\n")
    (tmp_path / "one line.json").write_text(json.dumps(ONE))
    (tmp_path / "pretty.json").write_text(json.dumps(ONE, indent=1))
    (tmp_path / "tabs%20.json").write_text(json.dumps(ONE, indent="\t"))
    (tmp_path / "empty.json").write_text("")
    docs = _read(spark, tmp_path)
    assert docs.count() == 6 and _ids(fd.accepted(docs)) == ["a"] * 6 + ["b"] * 6
    only = fd.read_documents(spark, str(tmp_path / "lines.json"), "lines")
    assert only.count() == 3
    assert fd.read_documents(spark, str(tmp_path / "pretty.json"), "document").count() == 1


def test_json_lines_are_split_among_tasks(spark, tmp_path):
    """A history file of 300 MB is read by several tasks, and none holds more than its split."""
    line = json.dumps({"type": "FeatureCollection", "features": [{"id": "x" * 100, "properties": {"mag": 1.0}}] * 2000})
    n = (300 << 20) // len(line) + 1
    with open(tmp_path / "history.json", "w") as f:
        for _ in range(n):
            f.write(line + "\n")
    docs = fd.read_documents(spark, str(tmp_path))
    assert docs.rdd.getNumPartitions() >= 3
    rows = docs.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in rows) == n and len(rows) >= 3


def test_a_document_too_large_raises(spark, tmp_path, monkeypatch):
    (tmp_path / "pretty.json").write_text(json.dumps(ONE, indent=1))
    monkeypatch.setattr(fd, "WHOLE_BYTES", 20)
    with pytest.raises(fd.DocumentTooLarge, match="pretty.json"):
        fd.read_documents(spark, str(tmp_path))
    (tmp_path / "pretty.json").write_text(json.dumps(ONE) + "\n" + json.dumps(ONE))
    assert fd.read_documents(spark, str(tmp_path)).count() == 2  # lines of any size


def test_snapshots_are_written_compressed(spark, sf001):
    path = scratch_path(spark, "t-gz")
    feed = C._feed(spark, sf001)
    fd.write_snapshot(feed, path, 100)
    files = [n for n in TableStore(spark, path).names(path) if n.startswith("part-")]
    assert files and all(n.endswith(".gz") for n in files)
    back = fd.flatten(fd.accepted(_read(spark, path)), C.P1.run_ts_col())
    assert back.count() == feed.count() and back.exceptAll(feed).count() == 0
