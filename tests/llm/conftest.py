import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, source[, lang]]) tuples."""

    def make(rows):
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(docs_of):
    """Nulls, empty and very long texts, ties, repeated rows."""
    long_text = " ".join(f"word{i % 997}x{i}" for i in range(30_000))
    return docs_of([(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "no id at all", None), (None, None, None, None), (6, long_text), (7, "ünï ñ çé <|endoftext|> a|b")])


@pytest.fixture(scope="session")
def clash():
    """Adds columns named like the operators' results and steps."""
    from pyspark.sql import functions as F

    names = ["size", "shard", "slot", "score", "rank", "kept", "quality", "mix", "n_words", "component_id", "value", "ref", "node", "bucket", "u", "v", "start", "words", "sharding", "flags", "learn", "held_out", "target"]
    return lambda df: df.withColumns({n: F.lit("x") for n in names if n not in df.columns})


@pytest.fixture(scope="session")
def sf001_docs(spark, sf001):
    return spark.read.parquet(f"{sf001}/documents.parquet")
