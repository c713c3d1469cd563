import re
from collections import Counter, defaultdict

import pytest

from epicentre.llm import mixing as m

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Reshare the excess round by round."""
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    weight = {x: (5, 2, 1)[i % 3] for i, x in enumerate(names)}
    capped, left, total = {}, set(names), float(sum(sizes.values()))
    while left:
        rest = total - sum(capped.values())
        heavy = sum(weight[x] for x in left)
        over = [x for x in left if rest * weight[x] / heavy > 3 * sizes[x] + 1e-9]
        if not over:
            return capped | {x: rest * weight[x] / heavy for x in left}
        for x in over:
            capped[x] = 3.0 * sizes[x]
            left.discard(x)
    return capped


def check(df):
    rows = df.collect()
    got = m.mixed_sizes(df).collect()
    assert len(got) == len(rows)
    source = {r.doc_id: r.source for r in rows}
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += len(WORD.findall(r.text or ""))
    want = brute_targets(dict(sizes))
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], abs=1e-6)
        assert r["size"] == 0 or r.taken % r["size"] == 0 and r.taken <= 3 * r["size"]
        taken[s] += r.taken
    return sizes, want, taken, got


def test_targets_and_taken(sf001_docs):
    sizes, want, taken, got = check(sf001_docs)
    largest = defaultdict(int)
    source = {r.doc_id: r.source for r in sf001_docs.collect()}
    for r in got:
        largest[source[r.doc_id]] = max(largest[source[r.doc_id]], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_caps_cascade(docs_of):
    df = docs_of([(1, "a b", "a"), (2, "c " * 10, "b"), (3, "d " * 100, "c"), (4, "e " * 30, None)] + [(10 + i, "x " * 7, "c") for i in range(30)])
    sizes, want, taken, _ = check(df)
    assert want["a"] == 6 and taken["a"] == 6


def test_many_small_documents_meet_the_target(docs_of):
    _, want, taken, _ = check(docs_of([(i, "w " * (1 + i % 9), "abc"[i % 3]) for i in range(3000)]))
    assert all(abs(taken[s] - want[s]) <= 1.5 for s in want)  # the sizes of c are multiples of 3


def test_a_long_document_at_the_edge_leaves_a_gap_that_small_ones_fill(docs_of):
    # the gaps take thousands of documents: more than one at a time must be found
    sizes, want, taken, _ = check(docs_of([(0, "l " * 4000, "a")] + [(i, "s", "a") for i in range(1, 5000)] + [(5000 + i, "t " * 5, "b") for i in range(2000)]))
    assert all(abs(taken[s] - want[s]) <= 3 for s in want)


def test_rows_that_share_an_id_and_the_end_of_filling(docs_of):
    _, want, taken, got = check(docs_of([(1, "x " * 30, "a")] * 40 + [(2, "y " * 7, "a")] * 9 + [(100 + i, "z " * 11, "b") for i in range(50)]))
    assert len({r.taken for r in got if r.doc_id == 1}) == 1


def test_what_is_left_ends_under_the_shortest_document_left(sf001_docs):
    _, want, taken, got = check(sf001_docs)
    source = {r.doc_id: r.source for r in sf001_docs.collect()}
    size = {s: sum(r["size"] for r in got if source[r.doc_id] == s) for s in want}
    for s in want:
        times = want[s] // size[s]
        over = [r["size"] for r in got if source[r.doc_id] == s and r["size"] and r.taken == times * r["size"]]
        assert not over or abs(taken[s] - want[s]) <= min(over) + 1


def test_many_sources(spark):
    from pyspark.sql import functions as F

    sized = spark.range(100_000).select(F.concat(F.lit("host"), F.col("id")).alias("source"), (1 + F.pmod(F.col("id") * 7919, F.lit(97))).alias("size"))
    got = {r.source: r.target for r in m.source_targets(sized).collect()}
    want = brute_targets({r.source: r["size"] for r in sized.collect()})
    assert len(got) == 100_000 and all(abs(got[x] - want[x]) < 1e-6 for x in want)


def test_the_input_keeps_a_column_named_like_the_result(docs_of, clash):
    df = clash(docs_of([(1, "a b", "a"), (2, "c d e", None)]))
    out = m.chosen(df)
    assert out.columns == [*df.columns, "mix_"] and {r.mix for r in out.collect()} == {"x"}


def test_same_again(sf001_docs):
    assert sorted(m.mixed_sizes(sf001_docs).collect()) == sorted(m.mixed_sizes(sf001_docs.repartition(3)).collect())


def test_odd_inputs(odd_docs, clash, docs_of):
    assert len(m.mixed_sizes(clash(odd_docs)).collect()) == odd_docs.count()
    assert m.mixed_sizes(docs_of([])).collect() == []
    assert {r.taken for r in m.mixed_sizes(docs_of([(1, None), (2, "")])).collect()} == {0}


def test_mix_repeats_rows(sf001_docs, clash):
    df = clash(sf001_docs)
    times = {r.doc_id: r.taken // r["size"] for r in m.mixed_sizes(df).collect() if r["size"]}
    out = m.mix(df)
    assert out.columns == df.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({i: n for i, n in times.items() if n})
