import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from epicentre.llm import uniform_topk as u

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def brute(rows, k=5):
    vectors = {}
    for i, x in rows:
        if i is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        vec = [math.floor(256 * float(np.float32(v))) for v in x]
        vectors[i] = min(vectors.get(i, vec), vec)
    out = []
    for q in vectors:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(vectors[q], v, strict=True)), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def table(spark):
    return lambda rows: spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA)


def got(df):
    return sorted(tuple(r) for r in u.top_scores(df).collect())


def test_matches_brute_force(spark, sf001):
    df = spark.read.parquet(f"{sf001}/embeddings.parquet")
    assert got(df) == brute([(r.vec_id, list(r.embedding)) for r in df.collect()])


def test_many_blocks_and_lists(table):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(9)]) for i in range(400)]
    d = u.quantised(table(rows))
    asked = d.where("vec_id % 50 = 0").select("vec_id")
    for lists, block, queries in ((1, 64, 3), (2, 64, 3), (3, 1000, 2), (9, 50, 100)):
        assert sorted(tuple(r) for r in u.search(d, asked, 5, lists, block, queries).collect()) == brute(rows)


def test_copies_and_ties(table):
    same = [0.25, -0.5, 0.125]
    rows = [(i, same if i % 3 else [0.25, -0.5, i / 1000]) for i in range(300)]
    assert got(table(rows)) == brute(rows)


def test_odd_inputs(table, clash):
    rows = [(0, [1.0, 2.0]), (50, None), (100, [1.0, None]), (150, [float("nan"), 1.0]), (200, [float("inf"), 1.0]), (None, [1.0, 1.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (1, [0.5, 0.5]),
            (250, [1.0, 2.0, 3.0]), (300, [-3.0, 1.0]), (350, []), (3, [-0.001, 0.001])]
    assert got(table(rows)) == brute(rows)
    assert got(clash(table(rows))) == brute(rows)
    assert got(table([])) == []
    assert got(table([(50, [1.0])])) == []


def test_large_components_stay_exact(table):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-9e5, 9e5) for _ in range(8)]) for i in range(120)]
    assert got(table(rows)) == brute(rows)


def test_bounds_spare_entries():
    """Vectors of skewed lengths: fewer entries are computed than there are pairs, in both phases, and none that counts is missed."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    x = (rng.normal(0, 40, (4000, 16)) * (rng.pareto(1.5, 4000)[:, None] + 0.05)).astype(np.int64)
    ids, asked = np.arange(4000), x[::200]
    tables = []
    for i in range(2):
        side = slice(8 * i, 8 * i + 8)
        other = slice(8 - 8 * i, 16 - 8 * i)
        make = lambda m, names: pa.table({"part": pa.array(m[:, side].tolist(), pa.list_(pa.int64())), "gid": names, "rest": np.sqrt((m[:, other].astype(float) ** 2).sum(axis=1))})  # noqa: B023, E731
        tables.append((make(x, ids), make(asked, ids[::200])))
    lists = [u._List(*t) for t in tables]
    gathered = {}
    for one, side in zip(lists, (slice(0, 8), slice(8, 16)), strict=True):
        for name, found, entries in one.best(6):
            exact = x[:, side] @ x[name, side]
            assert sorted(entries) == sorted(np.sort(exact)[-6:]) and (exact[found] == entries).all()
            gathered.setdefault(name, set()).update(found.tolist())
    first = sum(one.computed for one in lists)
    exact = {n: x @ x[n] for n in gathered}
    cutoffs = np.array([np.sort(exact[n][sorted(gathered[n])])[-6] for n in ids[::200]])
    sent = {}
    for one in lists:
        for name, found, _ in one.sufficient(cutoffs, 2):
            sent.setdefault(name, set()).update(found.tolist())
    second = sum(one.computed for one in lists) - first
    for n, cutoff in zip(ids[::200], cutoffs, strict=True):
        assert set(np.flatnonzero(exact[n] >= cutoff).tolist()) <= sent[n]
    pairs = len(asked) * len(x) * 2
    assert first < 0.7 * pairs and second < 0.7 * pairs and sum(map(len, sent.values())) < 0.2 * len(asked) * len(x)
