import random
import re

import numpy as np
import pyarrow as pa
import pytest

from epicentre.llm import oph_minhash as o
from epicentre.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def brute(rows, k=3, percent=85):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and None not in (rows[i][0], rows[j][0]) and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = None if d is None else least[find(i)]
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


def check(df, k=3, percent=85):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted((tuple(r) for r in o.near_duplicates(df, k, percent).collect()), key=repr) == brute(rows, k, percent)


def test_matches_brute_force(sf001_docs):
    check(sf001_docs)


def test_five_words(sf001_docs):
    check(sf001_docs, 5, 80)


def test_family_around_the_threshold(docs_of):
    rng = random.Random(2)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    check(docs_of(rows))


def test_short_texts(docs_of):
    check(docs_of([(1, "a"), (2, "A"), (3, "a b"), (4, "a  b"), (5, "b a"), (6, "a b c"), (7, "a b c a b c"), (8, "a b c d e f g h"), (9, "a b c d e f g h i"), (10, "x b c d e f g h i")]))


def test_odd_inputs(odd_docs, clash, docs_of):
    check(odd_docs)
    check(clash(odd_docs))
    check(docs_of([]))
    check(docs_of([(i, "the same text every time") for i in range(50)]))


def test_one_of_each(docs_of, clash):
    df = clash(docs_of([(1, "a b c d e f"), (2, "a b c d e f"), (1, "a b c d e f"), (3, "other words are here now ok"), (None, "a b c d e f"), (4, None)]))
    out = o.one_of_each(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id for r in out.collect()), key=repr) == [1, 3, 4, None]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    for size in (40, 300, 3000):
        agree = []
        for _ in range(20):
            x = rng.integers(0, 1 << 63, 2 * size).astype(np.uint64)
            a, b = x[:size], x[size // 10 : size + size // 10]
            s = o.signatures(np.concatenate([np.sort(a), np.sort(b)]), np.array([size, size]))
            agree.append((s[0] == s[1]).mean())
        assert np.mean(agree) == pytest.approx(0.9 / 1.1, abs=0.05)


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(4)
    for size in (3, 200, 5000):
        x = rng.integers(0, 1 << 63, size + 50).astype(np.uint64)
        a, b = x[:size], x[50:]
        m = o.bitmaps(np.concatenate([a, b]), np.array([len(a), len(b)]))
        assert np.bitwise_count(m[0] ^ m[1]).sum() <= len(set(a.tolist()) ^ set(b.tolist()))


def test_shingles_of_sliced_texts():
    texts = pa.array(["skip me", None, "A b c d", "", "x y"])
    hashes, sizes = o.shingle_sets(texts.slice(1), 3)
    assert sizes.tolist() == [0, 2, 0, 1]
    again, _ = o.shingle_sets(pa.array(["a B c d"]), 3)
    assert set(again.tolist()) == set(hashes[:2].tolist())


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(2, 1), (3, 2), (4, 3), (5, 4), (9, 8)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 29), (50, 51)]])
def test_components(spark, edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root}
