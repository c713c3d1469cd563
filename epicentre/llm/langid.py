"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams (one to three characters inside a word and its two
borders) of all training texts of a language.  A document's own most frequent n-grams are
ranked the same way; its out-of-place distance to a language is the sum, over those n-grams,
of how far their rank is from their rank in the profile, and the full profile length where
the profile lacks one.  The nearest language wins; ties go to the smaller value by code point.

Training counts n-grams inside the tasks and sums them by language and n-gram, so a language
that holds most rows is pre-aggregated before the shuffle.  Prediction is a map over the
documents that sees the text alone.  A task gets the profiles of at most LANGUAGES languages, as
a list of their n-grams' places; where there are more, the map is taken for one set of them after
the other and the nearest so far goes along.

``und``, score 0: a text that is null or has no letter, or nothing to learn from.  Documents
with a null id are neither learnt from nor held out.  Repeated rows get the same prediction.
A text longer than a slice is counted as a whole; n-grams of equal number are ordered by code.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epicentre.llm.common import CRC32_OF_ID, crc32_of_id, slices, starts_of, written

#: N-grams of a profile; languages whose profiles a task holds at a time.
PROFILE, LANGUAGES = 300, 2_000
#: Fixed by the contract: documents with this remainder aren't learnt from.
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
#: Distinct n-grams that a training task holds before it hands them on.
HELD_GRAMS = 2_000_000

_letters: np.ndarray | None = None


def _is_letter(points: np.ndarray) -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _letters[points]


def grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Codes of the n-grams of all texts for n = 1, 2, 3, one array each, and each text's place in them.

    Between texts, and before and after each, stands a border (a character that isn't a letter).
    A code holds three characters of 21 bits: 0 for none, 1 for a border, else the code point + 1.
    Places are those of a text's first and last border; n-grams that have no letter, or one of
    two words, get the code -1.
    """
    lowered = [t.lower() for t in texts]
    joined = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in lowered])])
    letter = _is_letter(joined)
    x = np.where(letter, joined.astype(np.int64) + 1, 1)
    one = np.where(letter, x, -1)
    two = np.where(letter[:-1] | letter[1:], (x[:-1] << 21) | x[1:], -1)
    three = np.where(letter[1:-1], (x[:-2] << 42) | (x[1:-1] << 21) | x[2:], -1)
    return [one, two, three], at


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    codes = codes[np.searchsorted(codes, 0) :]  # without -1
    if not len(codes):
        return codes, codes
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.diff(np.concatenate([first, [len(codes)]]))


def ranked(codes: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by code."""
    values, counts = _counted(codes)
    if len(values) > size:
        floor = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= floor
        values, counts = values[keep], counts[keep]
    return values[np.argsort(-counts, kind="stable")][:size]


def _text_codes(all_grams: list[np.ndarray], a: int, b: int) -> np.ndarray:
    """The n-grams that lie in the places from a to before b."""
    return np.concatenate([g[a : b - n] for n, g in enumerate(all_grams)] if b > a else [np.zeros(0, np.int64)])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, (codes, counts) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], names=["lang", "gram", "n"])
        held.clear()

    for part in slices(batches, "text"):
        langs = part.column("lang").to_pylist()
        texts = part.column("text").to_pylist()
        for lang in sorted(set(langs)):
            codes = np.concatenate(grams([t for t, x in zip(texts, langs, strict=True) if x == lang])[0])
            values, counts = _counted(codes)
            if lang in held:
                both = np.concatenate([held[lang][0], values])
                values, where = np.unique(both, return_inverse=True)
                counts = np.bincount(where, weights=np.concatenate([held[lang][1], counts])).astype(np.int64)
            held[lang] = (values, counts)
        if sum(len(v) for v, _ in held.values()) > HELD_GRAMS:
            yield from rows()
    yield from rows()


def profiles(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """lang, gram, place (from 0): the profiles learnt from rows (text, lang) without nulls."""
    d = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = d.mapInArrow(_train, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    return counts.withColumn("place", place).where(F.col("place") <= size).select("lang", "gram", (F.col("place") - 1).alias("place"))


class Profiles:
    """Profiles of some languages: for each n-gram, the languages that have it and its places there."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE):
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        at = {x: k for k, x in enumerate(self.langs)}
        grams = np.array([r[1] for r in rows], np.int64)
        order = np.argsort(grams, kind="stable")
        self.lang = np.array([at[r[0]] for r in rows], np.int32)[order]
        self.place = np.array([r[2] for r in rows], np.int32)[order]
        self.grams, first = np.unique(grams[order], return_index=True)
        self.bounds = np.append(first, len(rows))

    def nearest(self, mine: np.ndarray) -> tuple[str, float]:
        """The language at the least distance from ranked n-grams, and one less the share of the greatest distance."""
        if not len(mine) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, mine), len(self.grams) - 1)
        mine_at = np.flatnonzero(self.grams[at] == mine)
        first = self.bounds[at[mine_at]]
        n = self.bounds[at[mine_at] + 1] - first
        entry = np.repeat(first - starts_of(n), n) + np.arange(n.sum())
        # what an n-gram that a profile has is nearer than one that it lacks
        near = self.size - np.abs(self.place[entry] - np.repeat(mine_at, n))
        gained = np.bincount(self.lang[entry], weights=near, minlength=len(self.langs))
        best = int(gained.argmax())
        off = self.size * len(mine) - gained[best]
        return self.langs[best], 1.0 - float(off) / (self.size * len(mine))


def _predict(known: Profiles, more: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            all_grams, at = grams(pc.fill_null(part.column("text"), "").to_pylist())
            found = [known.nearest(ranked(_text_codes(all_grams, a, b + 1), known.size)) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            if "lang_pred" in part.schema.names:  # the nearest of languages that come before these
                before = zip(part.column("lang_pred").to_pylist(), part.column("score").to_pylist(), strict=True)
                found = [old if new[0] == UNKNOWN or old[1] >= new[1] and old[0] != UNKNOWN else new for old, new in zip(before, found, strict=True)]
            own = ["doc_id", "held_out"] + ["text"] * more  # the text goes along if there are more languages
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in own], pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=[*own, "lang_pred", "score"])

    return run


def predict(docs: DataFrame, known: DataFrame, languages: int = LANGUAGES) -> DataFrame:
    """doc_id, held_out, lang_pred, score for rows (doc_id, held_out, text).  ``known`` is a written table of profiles."""
    d = docs.select("doc_id", "held_out", F.col("text").cast("string").alias("text"))
    langs, some = known.select("lang").distinct(), None
    while some is None or len(some) == languages:
        after = langs if some is None else langs.where(F.col("lang") > some[-1])
        some = [r[0] for r in after.orderBy("lang").limit(languages).collect()]
        if some or "lang_pred" not in d.columns:
            rows = known.where(F.col("lang").between(some[0], some[-1])).collect() if some else []
            more = len(some) == languages
            d = d.mapInArrow(_predict(Profiles([tuple(r) for r in rows]), more), "doc_id long, held_out boolean, " + "text string, " * more + "lang_pred string, score double")
    return d.drop("text")


def identified(docs: DataFrame) -> DataFrame:
    """op9: learn from the training folds, predict every document."""
    fold = F.pmod(crc32_of_id(F.col("doc_id")), F.lit(FOLDS))
    learnt = written(profiles(docs.where(fold != HELD_OUT)), "langid-profiles")
    return predict(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"), "text"), learnt)


#: Borders as blanks, which stand before every letter; n-grams are ordered by length, then by code point.
IDENTIFIED_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, text IS NULL AS no_text, {CRC32_OF_ID} % {FOLDS} AS fold,
    regexp_extract_all(' ' || regexp_replace(lower(coalesce(text, '')), '\PL', ' ', 'g') || ' ', '.') AS l FROM documents),
x AS (SELECT r, unnest(list_prepend(NULL, l[:-2])) AS a, unnest(l) AS b, unnest(list_append(l[2:], NULL)) AS c FROM d),
g AS (SELECT r, unnest([CASE WHEN b <> ' ' THEN b END, CASE WHEN a <> ' ' OR a = ' ' AND b <> ' ' THEN a || b END, CASE WHEN b <> ' ' THEN a || b || c END]) AS g FROM x),
n AS (SELECT r, g, count(*) AS n FROM g WHERE g IS NOT NULL GROUP BY r, g),
k AS (SELECT lang, g, sum(n) AS n FROM n JOIN d USING (r) WHERE fold <> {HELD_OUT} AND lang IS NOT NULL AND NOT no_text GROUP BY lang, g),
known AS (SELECT lang, g, row_number() OVER (PARTITION BY lang ORDER BY n DESC, length(g), g) - 1 AS place FROM k QUALIFY place < {PROFILE}),
mine AS (SELECT r, g, row_number() OVER (PARTITION BY r ORDER BY n DESC, length(g), g) - 1 AS place FROM n QUALIFY place < {PROFILE}),
gained AS (SELECT r, lang, sum({PROFILE} - abs(known.place - mine.place)) AS gained FROM mine JOIN known USING (g) GROUP BY r, lang),
far AS (SELECT r, lang, {PROFILE} * n - coalesce(gained, 0) AS far, {PROFILE} * n AS farthest
    FROM (SELECT r, count(*) AS n FROM mine GROUP BY r) CROSS JOIN (SELECT DISTINCT lang FROM known) LEFT JOIN gained USING (r, lang)),
best AS (SELECT * FROM far QUALIFY row_number() OVER (PARTITION BY r ORDER BY far, lang) = 1)
SELECT doc_id, coalesce(fold = {HELD_OUT}, false) AS held_out, coalesce(best.lang, '{UNKNOWN}') AS lang_pred, coalesce(1 - far::DOUBLE / farthest, 0) AS score
FROM d LEFT JOIN best USING (r)"""
