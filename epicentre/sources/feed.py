"""The GeoJSON event feed: read, flatten, back-fill slice, and write snapshots.

A feed file holds one FeatureCollection in any layout, as the feed serves it, or JSON Lines
with one collection on each line, as ``write_snapshot`` writes them.  Lines are read by Spark's
text source, which splits a plain file of any size among tasks (a compressed one is a task's); only a file whose document runs over
several lines is one row, up to ``WHOLE_BYTES``.  Documents that don't parse, or hold a value
of a wrong type, are never skipped: they fail the job that reads them, or are handed back as
rejects.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epicentre.params import RunParams
from epicentre.schemas import (
    COORDINATE_COLUMNS,
    FEATURE_COLLECTION_SCHEMA,
    FEED_COLUMNS,
    PROPERTY_OF,
    RAW_FIELDS,
)

# The historical query's defaults.
BACKFILL_START = dt.date(2024, 1, 1)
BACKFILL_MIN_MAGNITUDE = 2.5
# Features per written FeatureCollection document.
FEATURES_PER_DOCUMENT = 1000

# Largest file that is read as one document; history of any size belongs in JSON Lines.
WHOLE_BYTES = 512 << 20

_CORRUPT = "_corrupt"
_CHECKED = T.StructType([*FEATURE_COLLECTION_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])


class DocumentTooLarge(ValueError):
    """A file that must be read as one document is larger than WHOLE_BYTES."""


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row (value) per file; a file of no bytes has none."""
    return spark.read.text(path, wholetext=True)


def read_documents(spark: SparkSession, path: str, layout: str = "auto") -> DataFrame:
    """One row (value) per document of the files.

    A file is JSON Lines if every line that isn't blank begins an object, else one document.
    ``layout`` "lines" or "document" spares the pass over the files that tells them apart.
    """
    if layout == "document":
        return read_texts(spark, path)
    lines = spark.read.text(path)
    return _lines(lines) if layout == "lines" else documents_of(with_files(lines), path)


def with_files(lines: DataFrame) -> DataFrame:
    """Lines of text files with the file that each is from."""
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))


def documents_of(lines: DataFrame, path: str) -> DataFrame:
    """The documents that the lines (value, file, bytes) are from; ``path`` reads the same files."""
    value = F.col("value")
    blank = ~value.rlike("\\S")
    files = lines.groupBy("file", "bytes").agg(F.bool_and(blank).alias("blank"), F.bool_and(blank | value.rlike("^\\s*\\{")).alias("objects"))
    # as many names at most as there are files, which the driver has listed anyway
    whole = files.where(F.col("blank") | ~F.col("objects")).select("file", "bytes").collect()
    for file, size in whole:
        if size > WHOLE_BYTES:
            raise DocumentTooLarge(f"{file}: a document over several lines of {size} bytes; at most {WHOLE_BYTES} can be read, as JSON Lines any number")
    if not whole:
        return _lines(lines)
    names = [r.file for r in whole]
    texts = read_texts(lines.sparkSession, path).where(F.col("_metadata.file_path").isin(names)).select(F.explode(F.array("value")).alias("value"))
    return texts.unionByName(_lines(lines.where(~F.col("file").isin(names))))


def _lines(lines: DataFrame) -> DataFrame:
    # by a generator, since a filter may be evaluated after those that later steps add (and fail on blank lines)
    return lines.select(F.explode(F.filter(F.array("value"), lambda x: x.rlike("\\S"))).alias("value"))


def _parsed(text: Column) -> Column:
    return F.from_json(text, _CHECKED, {"columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE"})


def parse_documents(docs: DataFrame, column: str = "value") -> DataFrame:
    """One document a row: type, features, malformed (the text, else null).

    A document without an array of features is malformed.
    """
    d = docs.select(F.col(column).alias("doc")).withColumn("fc", _parsed(F.col("doc")))
    bad = F.col("fc").isNull() | F.col(f"fc.{_CORRUPT}").isNotNull() | F.col("fc.features").isNull()
    return d.select("fc.type", "fc.features", F.when(bad, F.coalesce("doc", F.lit(""))).alias("malformed"))


def parse_collections(texts: DataFrame, column: str = "value") -> DataFrame:
    """Documents of single texts (values of a table, say): type, features, malformed.

    If every line that isn't blank begins an object, each is a document; else the text is one.
    """
    text = F.col(column)
    lines = F.filter(F.split(text, "\\r?\\n"), lambda x: F.trim(x) != "")
    by_line = (F.size(lines) > 0) & F.forall(lines, lambda x: F.ltrim(x).startswith("{"))
    return parse_documents(texts.select(F.explode(F.when(by_line, lines).otherwise(F.array(text))).alias("doc")), "doc")


def rejects(collections: DataFrame) -> DataFrame:
    return collections.where(F.col("malformed").isNotNull()).select("malformed")


def accepted(collections: DataFrame) -> DataFrame:
    """All documents as readable ones; whatever reads the features of another fails (in the same pass)."""
    kind = collections.schema["features"].dataType
    stop = F.raise_error(F.concat(F.lit("a feed document can't be read: "), F.substring("malformed", 1, 200))).cast(kind)
    features = F.when(F.col("malformed").isNull(), F.col("features")).otherwise(stop)
    return collections.select("type", features.alias("features"), F.lit(None).cast("string").alias("malformed"))


def flatten(collections: DataFrame, ingested_at: Column) -> DataFrame:
    """One feed record (27 columns) per feature of the readable documents.

    Missing properties give nulls, unknown keys are dropped; coordinates past the
    end of the array (or a null geometry) give null lon/lat/depth.
    """
    feats = collections.where(F.col("malformed").isNull()).select(F.explode("features").alias("f"))
    types = dict(RAW_FIELDS)
    cols = []
    for c in FEED_COLUMNS:
        if c == "event_id":
            expr = F.col("f.id")
        elif c in PROPERTY_OF:
            expr = F.col(f"f.properties.{PROPERTY_OF[c]}")
        elif c in COORDINATE_COLUMNS:
            expr = F.get(F.col("f.geometry.coordinates"), COORDINATE_COLUMNS.index(c))
        else:  # ingested_at
            expr = ingested_at
        cols.append(expr.cast(types[c]).alias(c))
    return feats.select(*cols)


def to_features(feed: DataFrame) -> DataFrame:
    """Feed records -> one GeoJSON Feature struct per row (column ``feature``)."""
    props = F.struct(*[F.col(c).alias(p) for c, p in PROPERTY_OF.items()])
    geometry = F.struct(
        F.lit("Point").alias("type"),
        F.array(*[F.col(c) for c in COORDINATE_COLUMNS]).alias("coordinates"),
    )
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.col("event_id").alias("id"),
        props.alias("properties"),
        geometry.alias("geometry"),
    )
    return feed.select(feature.alias("feature"), "event_id")


def to_documents(feed: DataFrame, per_document: int = FEATURES_PER_DOCUMENT) -> DataFrame:
    """Feed records -> FeatureCollection JSON documents (doc, value).

    Documents hold about ``per_document`` features: the document count comes from
    a scalar count, and rows go to documents by a hash of the event id, so the
    assignment is deterministic (safe to recompute) and no document grows with
    the data.
    """
    n_docs = feed.select(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / per_document))).scalar()
    feats = to_features(feed).withColumn("doc", F.pmod(F.xxhash64("event_id"), n_docs))
    docs = feats.groupBy("doc").agg(F.collect_list("feature").alias("features"))
    return docs.select("doc", F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value"))


def write_snapshot(feed: DataFrame, path: str, per_document: int = FEATURES_PER_DOCUMENT) -> None:
    """A folder of JSON Lines, compressed: the texts are many times the rows' size. A file is one shuffle
    partition's documents, so its size is bounded though it can't be split."""
    docs = to_documents(feed, per_document).select("value")
    docs.write.mode("errorifexists").option("zlib.compress.level", "BEST_SPEED").text(path, compression="gzip")


def backfill_slice(
    history: DataFrame,
    params: RunParams,
    start: dt.date = BACKFILL_START,
    end: dt.date | None = None,
    min_magnitude: float = BACKFILL_MIN_MAGNITUDE,
    limit: int | None = None,
) -> DataFrame:
    """The historical query: start <= time <= end, magnitude >= min. ``end`` defaults to as_of.

    All rows, in no order: landed history has no request limit.  A ``limit``, where a caller
    wants one, takes the oldest rows (a top-k).  The bounds are plain literals on the raw
    columns, so they push down to Parquet.
    """
    found = history.filter(
        (F.col("event_time") >= _epoch_ms(start))
        & (F.col("event_time") <= _epoch_ms(end or params.as_of))
        & (F.col("magnitude") >= min_magnitude)
    )
    return found if limit is None else found.orderBy("event_time", "event_id").limit(limit)


def _epoch_ms(d: dt.date) -> int:
    return int(dt.datetime(d.year, d.month, d.day, tzinfo=dt.timezone.utc).timestamp() * 1000)
