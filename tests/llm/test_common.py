import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from epicentre.llm import common as c

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("lower", [False, True])
def test_words_of_sliced_batches(lower):
    rng = random.Random(1)
    texts = [None if rng.random() < 0.05 else "".join(rng.choice("aBé Z\t\n\x0b\x1c .") for _ in range(rng.randrange(60))) for _ in range(500)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    got = []
    for part in c.slices(iter([batch]), "text", 700):
        codes, distinct, counts = c.coded_words(part.column("text"), lower)
        words = distinct.to_pylist()
        at = np.concatenate([[0], np.cumsum(counts)])
        got += [[words[k] for k in codes[a:b]] for a, b in zip(at, at[1:], strict=False)]
    want = [re.findall(c.WORD, (t or "").translate(LOWER) if lower else (t or "")) for t in texts]
    assert got == want


def test_slices_bound_bytes_and_keep_rows():
    batch = pa.RecordBatch.from_pydict({"id": list(range(6)), "text": ["x" * 10, None, "y" * 95, "", "z" * 1000, "w"]})
    parts = list(c.slices(iter([batch, batch.slice(0, 0)]), "text", 100))
    assert [r for p in parts for r in p.column("id").to_pylist()] == list(range(6))
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= 1100 for p in parts) and len(parts) > 1


def test_may_be_in_never_misses(spark):
    rng = random.Random(2)
    ids = [rng.randrange(-(1 << 62), 1 << 62) for _ in range(400)]
    rows = spark.createDataFrame([(i,) for i in [*ids, *(rng.randrange(1 << 62) for _ in range(4000)), None]], "id long")
    found = c.may_be_in(rows, "id", spark.createDataFrame([(i,) for i in ids], "k long"), "hit")
    hits = {r.id for r in found.where("hit").collect()}
    assert set(ids) <= hits and len(hits) < 450
    assert found.count() == 4401 and found.columns == ["id", "hit"]
    assert c.may_be_in(rows, "id", rows.limit(0), "hit").where("hit").count() == 0


def test_words_in_sql_and_arrow_agree(spark):
    texts = ["a  b\tc\n", "", None, " \x0b ", " x y \x1c z", "é"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(c.n_words_of(F.col("t")).alias("n"), F.size(c.words_of(F.col("t"))).alias("m"))
    _, counts = c.split_words(pa.array(texts))
    assert [(r.n, r.m) for r in df.collect()] == [(k, k) for k in counts.tolist()]
