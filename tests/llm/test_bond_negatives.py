import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from epicentre.llm import bond_negatives as b

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def brute(rows, k=5):
    """Every score of every anchor, filtered and sorted."""
    vectors = {}
    for i, x, label in rows:
        if i is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        one = ([math.floor(256 * float(np.float32(v))) for v in x], (label + 1) % 10 if i % 7 == 0 else label)
        vectors[i] = min(vectors.get(i, one), one)
    out = []
    for a, (vec, label) in vectors.items():
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(vec, v, strict=True)), i, of == label) for i, (v, of) in vectors.items() if i != a and len(v) == len(vec))
        for s, p, _ in [x for x in scored if x[2]][:k]:
            fit = [(n, i) for n, i, same in scored if not same and -80 * s <= -100 * n <= -100 * s]
            out += [(a, p, r + 1, i, -s, -n) for r, (n, i) in enumerate(fit[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def table(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


def got(df):
    return sorted(tuple(r) for r in b.hard_negatives(df).collect())


def test_matches_brute_force(spark, sf001):
    df = spark.read.parquet(f"{sf001}/embeddings.parquet")
    want = brute([(r.vec_id, list(r.embedding), r.label) for r in df.collect()])
    assert want and got(df) == want


def test_many_blocks(table):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0.1, 0.2) for _ in range(19)], 4 if i % 3 else rng.randrange(10)) for i in range(700)]
    d = b.quantised(table([(i, x, (k + 1) % 10 if i % 7 == 0 else k) for i, x, k in rows]))
    asked = d.where("vec_id % 100 = 0").select("vec_id")
    for row_block, anchor_block in ((32, 2), (1000, 1), (100, 100)):
        assert sorted(tuple(r) for r in b.mine(d, asked, row_block=row_block, anchor_block=anchor_block).collect()) == brute(rows)


def test_copies_and_ties(table):
    same = [0.25, -0.5, 0.125]
    rows = [(i, same if i % 3 else [0.25, -0.5, i / 1000], i % 2) for i in range(300)]
    want = brute(rows)
    assert want and got(table(rows)) == want


def test_negative_and_zero_scores(table):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.0, 0.0, 1.0]) if i % 100 else 1.0, 0.0, -abs(rng.gauss(0, 1))], i % 3) for i in range(300)]
    assert got(table(rows)) == brute(rows)


def test_odd_inputs(table, clash):
    rows = [(0, [1.0, 2.0], 1), (100, None, 1), (200, [1.0, None], 1), (300, [float("nan"), 1.0], 1), (400, [float("inf"), 1.0], 1), (None, [1.0, 1.0], 1),
            (500, [1.0, 1.0], None), (1, [0.5, 0.5], 2), (2, [0.5, 0.5], 2), (1, [0.5, 0.5], 2), (3, [1.0, 1.0], 2), (4, [0.9, 0.9], 1), (5, [0.9, 1.0], 3), (5, [0.8, 1.0], 3),
            (600, [1.0, 2.0, 3.0], 1), (6, [1.0, 2.0, 2.5], 1), (8, [1.0, 2.0, 2.4], 3), (700, [], 2), (9, [], 3), (10, [], 4)]
    want = brute(rows)
    assert want and got(table(rows)) == want
    assert got(clash(table(rows))) == want
    assert got(table([])) == []
    assert got(table([(100, [1.0], 1)])) == []


def test_large_components_stay_exact(table):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(1e5, 9e5) for _ in range(8)], i % 4) for i in range(220)]
    want = brute(rows)
    assert want and got(table(rows)) == want


def test_bounds_spare_components():
    """Vectors with a few large components: most of the block is read no further after these."""
    import pyarrow as pa

    rng = np.random.default_rng(1)
    x = rng.integers(-4, 4, (2000, 64))
    x[:, 5] = rng.integers(-400, 400, 2000)
    x[:, 40] = rng.integers(-400, 400, 2000)
    labels = np.arange(2000) % 2
    block = b._Block(pa.table({"vec": pa.array(x.tolist(), pa.list_(pa.int64())), "vec_id": np.arange(2000), "label": labels}))
    anchor = x[0] + 0
    anchor[[5, 40]] = 300, -250
    ids, scores, read = b.positives_of(block, anchor, 0, 5)
    exact = x @ anchor
    order = [i for i in np.lexsort((np.arange(2000), -exact)) if i != 0][:5]
    assert ids.tolist() == order and scores.tolist() == exact[order].tolist()
    assert read < x.size / 3
    windows = scores.tolist()
    found, read = b.negatives_of(block, anchor, 0, windows, 5)
    assert read < x.size / 2
    for top, (ids, scores) in zip(windows, found, strict=True):
        fit = [i for i in np.lexsort((np.arange(2000), -exact)) if labels[i] and 80 * top <= 100 * exact[i] <= 100 * top][:5]
        assert ids.tolist() == fit
