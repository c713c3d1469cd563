"""Stored backoff models against a brute-force one, at several orders and on other texts than those learnt."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from epicentre.llm import katz, katz_tables as kt

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text, order):
    w = ["<s>"] * (order - 1) + WORD.findall((text or "").lower()) + ["</s>"]
    return [tuple(w[i - order + 1 : i + 1]) for i in range(order - 1, len(w))]


class Brute:
    """P(w | context) by the definition, with dictionaries."""

    def __init__(self, texts, order):
        self.order, self.c, self.after, self.d = order, {}, {}, {}
        for k in range(1, order + 1):
            self.c[k] = Counter(g for t in texts for g in grams(t, k))
            self.after[k] = defaultdict(dict)
            for g, c in self.c[k].items():
                self.after[k][g[:-1]][g[-1]] = c
            self.d[k] = katz.discounts([sum(c == r for c in self.c[k].values()) for r in range(1, 7)])
        self.vocabulary = {g[0] for g in self.c[1]}

    def kept(self, k, h):
        """Discounted counts after a context, and what they are divided by."""
        seen = self.after[k].get(h, {})
        left = {w: c * (self.d[k][c] if c <= 5 else 1) for w, c in seen.items()}
        return left, sum(seen.values()) + (0 if any(c <= 5 for c in seen.values()) else 1)

    def p(self, w, h):
        k = len(h) + 1
        left, over = self.kept(k, h)
        if k == 1:
            return left[w] / over if w in left else (over - sum(left.values())) / over
        if w in left:
            return left[w] / over
        if not left:
            return self.p(w, h[1:])
        return (1 - sum(left.values()) / over) / (1 - sum(self.p(x, h[1:]) for x in left)) * self.p(w, h[1:])

    def score(self, text):
        return sum(math.log10(self.p(g[-1], g[:-1])) for g in grams(text, self.order))


def texts(seed, n):
    r = random.Random(seed)
    return [" ".join(r.choice("ab ABC abcdefgh the of a a a".split()) for _ in range(r.randrange(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_like_brute_force_on_other_texts(docs_of, order):
    learnt, other = texts(1, 60), [*texts(2, 25), "zz the zz", None, ""]
    model = kt.fit(docs_of(list(enumerate(learnt))), order)
    brute = Brute(learnt, order)
    got = {r.doc_id: r for r in kt.score(docs_of(list(enumerate(other))), model).collect()}
    assert len(got) == len(other)
    for i, t in enumerate(other):
        assert got[i].score == pytest.approx(brute.score(t), abs=1e-9)
        all_grams = grams(t, order)
        assert got[i].n_tokens == len(all_grams)
        assert got[i].n_backed_off == sum(g not in brute.c[order] for g in all_grams) * (order > 1)
        assert got[i].n_unknown == sum(g[-1] not in brute.vocabulary for g in all_grams)


def test_distributions_sum_to_one(docs_of):
    learnt = texts(3, 40)
    brute = Brute(learnt, 3)
    model = kt.fit(docs_of(list(enumerate(learnt))), 3)
    contexts = ["a a", "the of", "zz a", "b zz", "ab the"]
    words = sorted(brute.vocabulary - {"</s>"}) + ["unknown0"]
    rows = [(i * 100 + j, f"{h} {w}") for i, h in enumerate(contexts) for j, w in enumerate(words)]
    # the probability of w after h: the text (h, w) without its end, by the texts' own parts
    got = {r.doc_id: r.score for r in kt.score(docs_of(rows), model).collect()}
    for i, h in enumerate(contexts):
        a, b = h.split()
        head = math.log10(brute.p(a, ("<s>", "<s>"))) + math.log10(brute.p(b, ("<s>", a)))
        after = sum(10 ** (got[i * 100 + j] - head - math.log10(brute.p("</s>", (b, w)))) for j, w in enumerate(words))
        assert after + brute.p("</s>", (a, b)) == pytest.approx(1, abs=1e-9)


def test_same_model_as_the_query(sf001_docs):
    """Order 2 and the blocks of op2 give the same scores, for learnt and held-out documents."""
    want = {r.doc_id: r for r in katz.scored(sf001_docs).collect()}
    held = [i for i, r in want.items() if r.held_out]
    model = kt.fit(sf001_docs.where(~sf001_docs.doc_id.isin(held)), 2)
    got = {r.doc_id: r for r in kt.score(sf001_docs, model).collect()}
    assert held and set(got) == set(want)
    for i, r in want.items():
        assert got[i].score == pytest.approx(r.score, rel=1e-12)
        assert got[i].n_tokens - got[i].n_unknown == r.n_known


def test_stored_tables(spark, docs_of, tmp_path):
    """A model is opened from its path; its tables hold the counts, and the weights of all contexts."""
    learnt = texts(4, 30)
    kt.fit(docs_of(list(enumerate(learnt))), 3, str(tmp_path / "model"))
    model, brute = kt.Model(spark, str(tmp_path / "model")), Brute(learnt, 3)
    assert model.order == 3 and [r.entries for r in model.orders.orderBy("order").collect()] == [len(brute.c[k]) for k in (1, 2, 3)]
    for k in (2, 3):
        assert model.contexts(k).count() == len(brute.after[k])
        assert sorted(r.c for r in model.grams(k).collect()) == sorted(brute.c[k].values())
        left = model.grams(k).groupBy("h").sum("p").collect()
        assert all(0 < r[1] < 1 + 1e-12 for r in left)


def test_odd_rows(odd_docs, clash, docs_of):
    brute = Brute([r.text for r in odd_docs.collect()], 3)
    model = kt.fit(clash(odd_docs), 3)
    got = sorted((repr(r.doc_id), round(r.score, 6), r.n_tokens) for r in kt.score(clash(odd_docs), model).collect())
    long = {6}  # too long for the brute force's sums over contexts; its tokens are counted
    want = sorted((repr(r.doc_id), round(brute.score(r.text), 6), len(grams(r.text, 3))) for r in odd_docs.collect() if r.doc_id not in long)
    assert [x for x in got if x[0] != "6"] == want and [x[2] for x in got if x[0] == "6"] == [30_001]
    assert kt.score(docs_of([]), model).collect() == []
    none = kt.fit(docs_of([]), 3)
    assert {(r.score, r.n_tokens - r.n_unknown) for r in kt.score(odd_docs, none).collect()} == {(0.0, 0)}


def test_an_order_below_one_raises(docs_of):
    with pytest.raises(ValueError, match="order"):
        kt.fit(docs_of([]), 0)
