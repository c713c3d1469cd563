"""The stages against brute force, each on what its predecessor left."""

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as c
from tests.llm import test_automata_dedup, test_mixing, test_oph_minhash, test_packing, test_quality_cascade


@pytest.fixture(scope="module")
def steps(spark, sf001):
    from epicentre.llm.common import written

    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    out = [docs]
    for name, stage in c.STAGES:
        out.append(written(stage(spark, out[-1], sf001), f"test-{name}"))
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(steps):
    assert len(c.STAGES) == 5
    for df in steps[1:5]:
        assert df.columns == steps[0].columns and df.dtypes == steps[0].dtypes


def test_quality(steps):
    want = {i for i, t in rows(steps[0]) if test_quality_cascade.brute(t)[-1]}
    assert {i for i, _ in rows(steps[1])} == want and 0 < len(want) < steps[0].count()


def test_near_duplicates(steps):
    want = {r[0] for r in test_oph_minhash.brute(rows(steps[1]), 5, 80) if r[3]}
    assert {i for i, _ in rows(steps[2])} == want


def test_passages(steps):
    want = {r[0]: r[3] for r in test_automata_dedup.brute(rows(steps[2])) if r[1] > r[2]}
    import hashlib

    got = {i: hashlib.sha256(" ".join(test_automata_dedup.WORD.findall(t)).encode()).hexdigest() for i, t in rows(steps[3])}
    assert got == want
    assert all(r.n_chars == len(r.text) for r in steps[3].collect())


def test_mixture(steps):
    before, after = Counter(rows(steps[3])), Counter(rows(steps[4]))
    assert set(after) <= set(before) and max(after.values()) <= 3
    _, _, taken, _ = test_mixing.check(steps[3])
    words = Counter()
    for r in steps[4].collect():
        words[r.source] += len(test_mixing.WORD.findall(r.text))
    assert words == +taken


def test_packing_round_trip(steps):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(test_packing.p.default_tokenizer())
    copies = Counter(rows(steps[4]))
    whole = {i: test_packing.ids_of(tokenizer, t) for i, t in copies}
    used, seen = Counter(), Counter()
    for r in steps[5].collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == whole[r.doc_id][r.start : r.start + r.length]
        seen[r.doc_id] += r.length
        used[r.sequence_id] += r.length
    assert seen == Counter({i: n * len(whole[i]) for (i, _), n in copies.items()})
    assert max(used.values()) <= 4096


def test_run(spark, sf001, steps):
    got = Counter((r.doc_id, r.start, r.length, zlib.crc32(r.ids)) for r in c.run(spark, sf001).collect())
    assert sum(k[2] * n for k, n in got.items()) == sum(r.length for r in steps[5].collect())


def test_odd_inputs(spark, odd_docs, clash, docs_of, sf001):
    for df in (odd_docs, clash(odd_docs), docs_of([])):
        docs = df
        for _, stage in c.STAGES:
            docs = stage(spark, docs, sf001)
        docs.collect()


def test_registered():
    import __spark_entry__ as e

    names = list(e.queries())
    assert "pipeline" in names
    assert all(sum(x.startswith(f"op{n}_") for x in names) == 1 for n in range(1, 11))
    assert set(e.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op3_suffix_automata", "op4_oph_minhash", "op7_uniform_threshold", "op10_quality_cascade"])
def test_sql_agrees(spark, sf001, name):
    import duckdb

    import __spark_entry__ as e

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf001}/{t}.parquet')")
    df = e.queries()[name](spark, sf001)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({e.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)
