import re

from epicentre.llm import quality_cascade as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {j for s in at.values() if len(s) > 1 for i in s for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n, chars, symbols, dup = len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines))
    failed = n < 20 or 100 * len(covered) > 30 * n
    stutters = sum(a == b for a, b in zip(w, w[1:], strict=False))
    bad = failed or 10 * symbols > n or chars < 2 * n or chars > 12 * n or 2 * dup > len(lines) or 10 * stutters > 3 * n
    return n, chars, symbols, dup, len(covered), failed, not bad


def check(df):
    texts = [(r.doc_id, r.text) for r in df.collect()]
    got = sorted((tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")) for r in q.verdicts(df).collect()), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t in texts), key=repr)


def test_matches_brute_force(sf001_docs):
    check(sf001_docs)


def test_odd_inputs(odd_docs, docs_of, clash):
    check(odd_docs)
    check(clash(odd_docs))
    check(docs_of([]))


def test_windows(docs_of):
    eight = "a b c d e f g h"
    check(docs_of([(1, " ".join(["x"] * 9)), (2, f"{eight} {eight}"), (3, f"{eight} q {eight} r " + " ".join(map(str, range(40)))), (4, eight), (5, "l one\nl one\n\n \nl two\nl one")]))


def test_order_does_not_change_the_verdict(sf001_docs):
    kept = [{r.doc_id for r in q.passing(sf001_docs, rules=rules).collect()} for rules in (q.RULES, q.RULES[::-1], q.order_rules(sf001_docs))]
    assert kept[0] == kept[1] == kept[2]
    assert kept[0] == {r.doc_id for r in q.verdicts(sf001_docs).collect() if r.kept}


def test_passing_keeps_the_columns(odd_docs, clash):
    df = clash(odd_docs)
    assert q.passing(df).columns == df.columns
    assert {r.doc_id for r in q.passing(df).collect()} <= {6}


def test_order_prefers_rejection_per_cost(sf001_docs):
    assert {r.name for r in q.order_rules(sf001_docs)} == {r.name for r in q.RULES}


def test_no_python_in_the_plan(sf001_docs):
    plan = q.verdicts(sf001_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def evaluations(df, rules):
    """How many counts are computed for how many rows."""
    from pyspark.sql import functions as F

    done = q.cascade(df, "text", rules)
    steps = [c for c in done.columns if c.startswith("__q_n_") or c == "__q_word_chars"]
    return sum(done.agg(*[F.count(c) for c in steps]).first())


def test_the_measured_order_computes_less_than_its_reverse(docs_of):
    """Most texts break the cheap rule on symbols: behind it, few are looked at for the dear ones."""
    plain = " ".join(f"word{i}" for i in range(200))
    df = docs_of([(i, plain + " ### &&& %%% $$$ ***" * 10 if i % 10 else plain) for i in range(1500)])
    rules = q.order_rules(df)
    assert evaluations(df, rules) < evaluations(df, rules[::-1])
    assert evaluations(df, q.RULES[2:]) == 1500 * 2 + 150 * 4  # words and symbols of all; characters, both line counts and stutters of the rest
    kept = {r.doc_id for r in q.judge(df, rules=rules).where("quality.failed is null").collect()}
    assert kept == {i for i in range(0, 1500, 10)}


def test_a_text_with_very_many_copies_has_its_share_of_the_sample(docs_of, monkeypatch):
    taken = []
    plain = q.written
    monkeypatch.setattr(q, "written", lambda df, name: taken.append(plain(df, name)) or taken[-1])
    q.order_rules(docs_of([(i, "one text " * 20 if i % 3 else f"text {i} " * 20) for i in range(3000)]), rules=q.RULES[:1], sample_rows=300)
    assert 200 < taken[0].count() < 400


def test_clashing_name_of_the_result(docs_of):
    from pyspark.sql import functions as F

    df = docs_of([(1, "a b")]).withColumn("quality", F.lit("mine"))
    got = q.judge(df).first()
    assert got.quality == "mine" and got.quality_.failed == "few_words"
