import hashlib
import random
import re

import pytest

from epicentre.llm import automata_dedup as a

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=50):
    words = [WORD.findall(t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words, strict=True):
        for s in range(len(w) - window + 1) if i is not None else ():
            key = tuple(w[s : s + window])
            least[key] = min(least.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = {p for s in range(len(w) - window + 1) if i is not None and least[tuple(w[s : s + window])] < i for p in range(s, s + window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(df):
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    assert sorted((tuple(r) for r in a.kept_words(df).collect()), key=repr) == want
    return {w[0]: w[2] for w in want}


def test_matches_brute_force(sf001_docs):
    assert any(check(sf001_docs).values())


def test_passages_edits_and_chains(docs_of):
    rng = random.Random(1)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    p, q = fresh(80), fresh(120)
    edited = [*q[:60], "EDIT", *q[61:]]
    rows = [(i, " ".join([*fresh(rng.randrange(60)), *p, *fresh(rng.randrange(60))])) for i in range(40)]
    rows += [(100 + i, " ".join([*fresh(7), *(q if i % 2 else edited), *fresh(9)])) for i in range(10)]
    # the reference of these windows' values lacks them: they stand in two later documents
    tail = fresh(60)
    rows += [(200, " ".join([*q[:45], *fresh(30)])), (201, " ".join([*q[:45], *tail])), (202, " ".join([*fresh(3), *q[:45], *tail]))]
    rows += [(300, " ".join(fresh(3) + p[:49])), (301, " ".join(p[:50]))]
    gone = check(docs_of(rows))
    assert gone[0] == 0 and gone[1] == 80 and gone[300] == 0 and gone[301] == 50 and gone[202] >= 60


def test_stutters_and_repeats_inside_a_document(docs_of):
    check(docs_of([(3, "the " * 200), (1, "the " * 60), (2, "the " * 49), (4, ("a b c " * 40)), (5, "a b c " * 30), (6, "c a b " * 30)]))


def test_odd_inputs(odd_docs, clash, docs_of):
    check(odd_docs)
    check(clash(odd_docs))
    assert check(docs_of([])) == {}
    long_text = " ".join(f"x{i}" for i in range(70))
    check(docs_of([(1, long_text), (1, long_text), (None, long_text), (2, long_text.replace(" ", "\n\t ")), (3, "  " + long_text + " tail\n")]))


def test_rows_that_share_an_id(docs_of):
    p, q = (" ".join(f"{c}{i}" for i in range(70)) for c in "pq")
    check(docs_of([(1, p), (2, f"own words {p}"), (2, q), (2, f"{q} {p}"), (3, q), (3, f"x y z {q}")]))


def test_white_space_of_what_is_kept(docs_of):
    passage = " ".join(f"x{i}" for i in range(50))
    df = docs_of([(1, passage), (2, f"head\n one {passage}\n\ntail  end\n"), (3, "as \n it\twas")])
    out = {r.doc_id: r for r in a.without_repeats(df, removed="gone").collect()}
    assert out[2].text == "head\n one\n\ntail  end\n" and out[2].gone == 50
    assert out[3].text == "as \n it\twas" and out[1].text == passage and out[1].gone == 0
    assert a.without_repeats(df).columns == df.columns


def test_busy_references_are_split(monkeypatch, docs_of):
    monkeypatch.setattr(a, "STREAM_WORDS", 300)
    monkeypatch.setattr(a, "SHARD_WORDS", 100)
    test_passages_edits_and_chains(docs_of)


@pytest.mark.parametrize("seed", range(8))
def test_automaton_against_search(seed):
    rng = random.Random(seed)
    docs = {d: [[rng.randrange(3) for _ in range(rng.randrange(1, 30))] for _ in range(2)] for d in rng.sample(range(20), 5)}
    m = a.SuffixAutomaton()
    for d in docs:
        for s in docs[d]:
            m.add(s, d)
    m.finish()
    for window in (1, 3, 5):
        least = {}
        for d, seqs in docs.items():
            for s in seqs:
                for i in range(len(s) - window + 1):
                    key = tuple(s[i : i + window])
                    least[key] = min(least.get(key, d), d)
        for doc in (0, 7, 21):
            text = [rng.randrange(-1, 3) for _ in range(60)]
            want = [i for i in range(len(text) - window + 1) if least.get(tuple(text[i : i + window]), 99) < doc]
            assert m.covered(text, doc, window) == want
