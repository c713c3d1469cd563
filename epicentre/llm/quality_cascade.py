"""Quality rules as a short-circuit cascade (DataFrame functions only).

Each rule is a boolean column that is true where a document must go.  Cost and selectivity
of every rule are estimated on a sample; the rules then run in the order of rejection per
cost, and for a document that one rule rejects nothing is computed that only later ones need.
The order never changes which documents are kept, only what it costs and which rule is named.

Null and empty texts have no words and are rejected.  Very long texts are judged whole.
Repeated rows are judged alike, one result each; rules of equal rejection per cost keep their
order.  An empty table gives an empty result.  All columns of the input are kept; the results
stand in one struct column, whose name gets underscores after it if the input has such a
column.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epicentre.llm.common import SPACES, free_name, written

#: Rows of the sample on which cost and selectivity are estimated (expected number), and how often
#: each rule's cost is measured.
SAMPLE_ROWS, REPEATS = 8_000, 3
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets a function from feature name to column."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Callable[[str], Column]], Column]


#: Fixed by the contract: the first two rules; the other thresholds are this library's defaults.
RULES = (
    Rule("few_words", ("n_words",), lambda f: f("n_words") < 20),
    Rule("repeated_words", ("n_words", "n_repeat_words"), lambda f: 100 * f("n_repeat_words") > 30 * f("n_words")),
    Rule("symbols", ("n_words", "n_symbols"), lambda f: 10 * f("n_symbols") > f("n_words")),
    Rule("word_length", ("n_words", "word_chars"), lambda f: (f("word_chars") < 2 * f("n_words")) | (f("word_chars") > 12 * f("n_words"))),
    Rule("duplicate_lines", ("n_lines", "n_dup_lines"), lambda f: 2 * f("n_dup_lines") > f("n_lines")),
    Rule("stutter", ("n_words", "n_stutters"), lambda f: 10 * f("n_stutters") > 3 * f("n_words")),
)
BASE = ("few_words", "repeated_words")

#: Feature -> (features it is computed from, expression over the text and those features).
#: ``words`` .. ``starts`` are steps on the way; the rest are bigint counts.
FEATURES: dict[str, tuple[tuple[str, ...], Callable[[Column, Callable[[str], Column]], Column]]] = {
    "words": ((), lambda t, f: F.filter(F.split(t, f"[{SPACES}]+"), lambda w: w != "")),
    "n_words": (("words",), lambda t, f: F.size(f("words")).cast("bigint")),
    "word_chars": (("words",), lambda t, f: F.aggregate(f("words"), F.lit(0).cast("bigint"), lambda a, w: a + F.length(w))),
    "n_symbols": ((), lambda t, f: F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("bigint")),
    "lines": ((), lambda t, f: F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACES}]"))),
    "n_lines": (("lines",), lambda t, f: F.size(f("lines")).cast("bigint")),
    "n_dup_lines": (("lines",), lambda t, f: (F.size(f("lines")) - F.size(F.array_distinct(f("lines")))).cast("bigint")),
    "n_stutters": (("words",), lambda t, f: F.when(F.size(f("words")) < 2, F.lit(0)).otherwise(
        F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.size(f("words")) - 1, F.lit(1))), lambda i: F.get(f("words"), i) == F.get(f("words"), i - 1)))).cast("bigint")),
    # one 64-bit hash for each window; empty for a text of fewer words
    "windows": (("words",), lambda t, f: F.when(F.size(f("words")) <= WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(f("words")) - (WINDOW - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(f("words"), i, WINDOW))))),
    # where the windows found twice or more start, in order; most texts have none and stop at the first test
    "starts": (("windows",), lambda t, f: F.when(
        F.size(F.array_distinct(f("windows"))) == F.size(f("windows")), F.array().cast("array<int>")).otherwise(_repeated(f("windows")))),
    "n_repeat_words": (("starts",), lambda t, f: F.when(F.size(f("starts")) == 0, F.lit(0).cast("bigint")).otherwise(_covered(f("starts")))),
}


def _repeated(windows: Column) -> Column:
    """Sort (hash, position), keep those with an equal neighbour, give their positions in order."""
    order = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # the sorted array is bound once as the one element of an outer array, so that it isn't sorted for each element
    def kept(arr: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(arr, k)["h"] == x["h"], F.lit(False))  # noqa: E731  false past either end
        return F.filter(arr, lambda x, k: same(x, k - 1) | same(x, k + 1))

    return F.sort_array(F.transform(F.flatten(F.transform(F.array(order), kept)), lambda x: x["i"]))


def _covered(starts: Column) -> Column:
    """Words under windows of WINDOW words that start there."""

    def gap(x: Column, k: Column) -> Column:
        return F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - x, F.lit(WINDOW)))

    return F.aggregate(F.transform(starts, gap), F.lit(0).cast("bigint"), lambda a, g: a + g)


def _closure(names: tuple[str, ...]) -> list[str]:
    """The features with what they are computed from, in an order that can be computed."""
    out: list[str] = []

    def add(n: str) -> None:
        for d in FEATURES[n][0]:
            add(d)
        if n not in out:
            out.append(n)

    for n in names:
        add(n)
    return out


def _with(df: DataFrame, text: str, names: list[str], have: set[str], alive: Column | None = None) -> DataFrame:
    """``df`` with the missing features as columns, one projection for each level of them; only where ``alive``, if given."""
    at = lambda n: F.col(f"__q_{n}")
    todo = [n for n in _closure(tuple(names)) if n not in have]
    while todo:
        now = [n for n in todo if all(d in have for d in FEATURES[n][0])]
        new = {n: FEATURES[n][1](F.coalesce(F.col(text), F.lit("")), at) for n in now}
        df = df.withColumns({f"__q_{n}": c if alive is None else F.when(alive, c) for n, c in new.items()})
        have.update(now)
        todo = [n for n in todo if n not in now]
    return df


def order_rules(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by estimated rejection per cost, highest first.

    The sample is drawn by row, so that a text with very many copies has its share in it and no more.
    A rule's cost is the time of an aggregate over the sample with what the rule needs, less that of one
    without any rule: the least of some repeats, after one to compile it.
    """
    total = df.count()
    if not total:
        return list(rules)
    sample = written(df.select(F.col(text)).where(F.rand(7) < min(1.0, sample_rows / total)), "quality-sample")

    def measured(judged: DataFrame, *counts: Column) -> tuple[float, tuple]:
        spent, found = [], None
        for _ in range(REPEATS + 1):
            began = time.perf_counter()
            found = judged.agg(F.count("*"), F.sum(F.length(text)), *counts).first()
            spent.append(time.perf_counter() - began)
        return min(spent[1:]), found

    idle, _ = measured(sample)
    rated = []
    for k, r in enumerate(rules):
        cost, (n, _, bad) = measured(_with(sample, text, list(r.needs), set()), F.count_if(r.rejects(lambda x: F.col(f"__q_{x}"))))
        rated.append(((bad + 1) / (n + 2) / max(cost - idle, 1e-3), -k, r))
    return [r for _, _, r in sorted(rated, key=lambda x: x[:2], reverse=True)]


def cascade(df: DataFrame, text: str, rules: list[Rule] | tuple[Rule, ...], features: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``__q_failed`` (the first rule that rejects, else null) and a column ``__q_<name>`` for each feature.

    Those named in ``features`` are computed for all rows, others only where no earlier rule rejects.
    """
    have: set[str] = set()
    failed = F.col("__q_failed")
    d = _with(df, text, list(features), have).withColumn("__q_failed", F.lit(None).cast("string"))
    for r in rules:
        d = _with(d, text, list(r.needs), have, failed.isNull())
        d = d.withColumn("__q_failed", F.when(failed.isNotNull(), failed).when(r.rejects(lambda n: F.col(f"__q_{n}")), F.lit(r.name)))
    return d


def judge(df: DataFrame, text: str = "text", rules: list[Rule] | tuple[Rule, ...] = RULES, features: tuple[str, ...] = (), out: str = "quality") -> DataFrame:
    """``df`` with a struct ``out``: the named features, ``failed`` (the first rule that rejects, else null)."""
    own, out = df.columns, free_name(df.columns, out)
    d = cascade(df, text, rules, features)
    return d.select(*own, F.struct(*[F.col(f"__q_{n}").alias(n) for n in features], F.col("__q_failed").alias("failed")).alias(out))


def passing(df: DataFrame, text: str = "text", rules: list[Rule] | tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass every rule, with the input's columns.

    A column says which rows are still there; the features that the next rule needs are computed
    for those only.
    """
    own, have = df.columns, set()
    alive = F.col("__q_alive")
    d = df.withColumn("__q_alive", F.lit(True))
    for r in rules:
        d = _with(d, text, list(r.needs), have, alive)
        d = d.withColumn("__q_alive", alive & ~F.coalesce(r.rejects(lambda n: F.col(f"__q_{n}")), F.lit(False)))
    # counted where it is judged; the filter stays above the count and so above the steps, which it would
    # otherwise be pushed through with all their expressions nested in it
    d = d.observe(f"quality-{uuid.uuid4().hex}", F.count("*").alias("judged"), F.count_if(alive).alias("kept"))
    return d.where(alive).select(*own)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def verdicts(docs: DataFrame) -> DataFrame:
    """op10: one row per document with the base counts and the verdict of the cascade."""
    d = docs.select("doc_id", "text")
    q = judge(d, rules=order_rules(d), features=COUNTS)
    base = [r for r in RULES if r.name in BASE]
    at = lambda n: F.col(f"quality.{n}")
    failed = base[0].rejects(at) | base[1].rejects(at)
    return q.select("doc_id", *[at(n).alias(n) for n in COUNTS], failed.alias("base_failed"), F.col("quality.failed").isNull().alias("kept"))


VERDICTS_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS k
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) > 8)),
twice AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
rep AS (SELECT rid, sum(g)::BIGINT AS n FROM
        (SELECT rid, least(8, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 8)) AS g FROM twice) GROUP BY rid),
f AS (SELECT doc_id, len(ws)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        len(ls) AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_stutters
      FROM w LEFT JOIN rep USING (rid)),
g AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words
       OR 2 * n_dup_lines > n_lines OR 10 * n_stutters > 3 * n_words) AS kept
FROM g
"""
