"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet
and read back as the next stage's ``docs``.  All stages but the last return the columns of
``docs``, whatever they are besides doc_id, text and source.

Nulls: a null text counts as empty and is rejected by the first stage.  Rows that share an id
are one document; the second stage keeps one of them.  An empty table passes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epicentre.llm import automata_dedup, mixing, oph_minhash, packing, quality_cascade
from epicentre.llm.common import WORD, table, workers_find_us, written

#: Near-duplicates: words of a shingle, least similarity in percent.
SHINGLE, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality_cascade.passing(docs, rules=quality_cascade.order_rules(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of near-duplicates."""
    workers_find_us(spark)
    return oph_minhash.one_of_each(docs, SHINGLE, PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has; none of no words."""
    workers_find_us(spark)
    cut = automata_dedup.without_repeats(docs).where(F.col("text").rlike(WORD))
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mix(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in training sequences, with their token ids."""
    workers_find_us(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("source_mixing", mixture),
    ("packing", sequences),
]

#: Token ids are out of SQL's reach; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
