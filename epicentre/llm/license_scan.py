"""License scans by templates in markup, compiled to automata over words.

A template is text with replaceable regions ``<<var;name=...;match=LO-HI>>`` (so many words of
any kind) or ``<<var;name=...;match=this|that one>>`` (one of these wordings), and optional
regions ``<<beginOptional>> ... <<endOptional>>``, which may be nested.  Case, punctuation and
white space don't count; the mandatory wording must match word by word.  Each template
becomes an automaton over words; it is started at the words that a match can begin with and
accepts the longest stretch.

The scan is a map over the documents: no shuffle, a bounded run of texts in memory, templates
as code.  A null text is empty and has no words and no labels.  A very long text is scanned whole,
in memory that grows with it alone.  Repeated rows are scanned alike.  An empty table gives an
empty result.  Overlapping places all count; of matches from one word the longest does.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epicentre.llm.common import LOWERED, slices
from epicentre.llm.license_texts import LICENSES

#: Fixed by the contract: phrase -> label.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Label -> template: whole licenses, and notices and passages that stand for them.  The quoted
#: notices are the public wordings of these licenses.
TEMPLATES = LICENSES | {
    "notice:mit": "<<beginOptional>>This <<var;name=work;match=1-6>> is <<endOptional>><<var;name=verb;match=released|licensed|distributed|available>> under the <<beginOptional>>terms of the <<endOptional>>MIT License",
    "notice:apache": "<<beginOptional>>This <<var;name=work;match=1-6>> is <<endOptional>>Licensed under the Apache License, <<beginOptional>>Version <<endOptional>><<var;name=version;match=1 0|1 1|2 0>>",
    "notice:gpl": "<<var;name=verb;match=released|licensed|distributed>> under the <<beginOptional>>terms of the <<endOptional>><<beginOptional>>GNU <<endOptional>><<beginOptional>>Lesser <<endOptional>>General Public License, <<beginOptional>>version <<var;name=version;match=1-2>><<endOptional>>",
    "notice:cc": "<<var;name=verb;match=released|licensed|distributed|available>> under <<beginOptional>>a <<endOptional>><<var;name=body;match=cc|creative commons>> <<var;name=kind;match=by|attribution|by sa|by nc|by nd|by nc sa|by nc nd>> <<beginOptional>><<var;name=version;match=1-2>><<endOptional>>",
    "text:mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        <<beginOptional>>and associated documentation files<<endOptional>> (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
        and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice
        <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software.""",
    "text:isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "text:bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted
        <<beginOptional>>(subject to the limitations in the disclaimer below)<<endOptional>> provided that the following conditions are met""",
    "text:apache-header": """you may not use this file except in compliance with the License. You may obtain a copy of the License at
        <<var;name=place;match=1-8>> Unless required by applicable law or agreed to in writing""",
    "copyright": "Copyright <<beginOptional>>(c) <<endOptional>><<var;name=years;match=1-3>> <<var;name=holder;match=1-8>> All rights reserved",
}

#: Word characters are all but the ASCII ones that are neither digit nor letter.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = r"[\x00-/:-@\[-`{-\x7f]+"
_IS_WORD = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])

SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def lower_words(text: str) -> list[str]:
    """The words, A-Z in lower case and all else as it stands."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


class Automaton:
    """A template as an automaton over words: per state its word steps, free steps and any-word steps."""

    def __init__(self, template: str):
        self.steps: list[dict[str, list[int]]] = []
        self.any: list[list[int]] = []
        self.free: list[list[int]] = []
        start = here = self._state()
        opened: list[int] = []
        for text, mark in re.findall(r"([^<]+)|<<(.*?)>>", template, re.S):
            if text:
                here = self._wording(here, lower_words(text))
            elif mark == "beginOptional":
                opened.append(here)
            elif mark == "endOptional":
                end = self._state()  # a state of its own, so that the way around meets the way through
                self.free[here].append(end)
                self.free[opened.pop()].append(end)
                here = end
            elif mark.startswith("var;"):
                here = self._replaceable(here, dict(x.split("=", 1) for x in mark.split(";")[1:])["match"])
            else:
                raise ValueError(f"unknown markup: <<{mark}>>")
        if opened:
            raise ValueError("an optional region isn't closed")
        self.end = here
        self.initial = self._closed({start})
        if self.end in self.initial or any(self.any[s] for s in self.initial):
            raise ValueError("a template must begin with wording")
        self.first = {w for s in self.initial for w in self.steps[s]}

    def _state(self) -> int:
        self.steps.append({})
        self.any.append([])
        self.free.append([])
        return len(self.steps) - 1

    def _wording(self, here: int, words: list[str]) -> int:
        for w in words:
            then = self._state()
            self.steps[here].setdefault(w, []).append(then)
            here = then
        return here

    def _replaceable(self, here: int, match: str) -> int:
        end = self._state()
        if count := re.fullmatch(r"(\d+)-(\d+)", match):
            for k in range(1, int(count[2]) + 1):
                if k > int(count[1]):
                    self.free[here].append(end)
                then = self._state()
                self.any[here].append(then)
                here = then
            self.free[here].append(end)
        else:
            for wording in match.split("|"):
                self.free[self._wording(here, lower_words(wording))].append(end)
        return end

    def _closed(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def accepts(self, words: list[str], at: int) -> int | None:
        """Where the longest match that starts at this word ends; None without one."""
        states, end = self.initial, None
        while states:
            if self.end in states:
                end = at
            if at == len(words):
                break
            states = self._closed({t for s in states for t in (*self.steps[s].get(words[at], ()), *self.any[s])})
            at += 1
        return end


class Scanner:
    """All phrases and templates, by the words that they can begin with."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.by_first: dict[str, list[tuple[bool, str, Automaton]]] = {}
        for is_base, named in ((True, {label: p for p, label in phrases.items()}), (False, templates)):
            for label, template in named.items():
                a = Automaton(template)
                for w in a.first:
                    self.by_first.setdefault(w, []).append((is_base, label, a))
        # a text without any of these has no match: the first words, which a phrase's second must follow
        firsts = {a for p in phrases for a in [_GAP.join(map(re.escape, lower_words(p)[:2]))]}
        for t in templates.values():
            firsts |= {re.escape(max(mandatory(t), key=len))}
        self.hint = "(?i)" + "|".join(sorted(firsts))

    def places(self, text: str) -> list[tuple[int, int, bool, str]]:
        """(first word, end, is a base phrase, label) of every accepted stretch, by its first word."""
        words = lower_words(text)
        return [(i, end, base, label) for i, w in enumerate(words) if w in self.by_first
                for base, label, a in self.by_first[w] if (end := a.accepts(words, i)) is not None]


def mandatory(template: str) -> list[str]:
    """The words that stand outside all regions."""
    depth, out = 0, []
    for text, mark in re.findall(r"([^<]+)|<<(.*?)>>", template, re.S):
        depth += (mark == "beginOptional") - (mark == "endOptional")
        if text and not depth:
            out += lower_words(text)
    return out


def count_words(text: pa.Array) -> np.ndarray:
    """Words of each text, from its bytes."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8)
    if offsets[-1] == offsets[0]:
        return np.zeros(len(text), np.int64)
    word = _IS_WORD[np.frombuffer(text.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]]
    at = offsets - offsets[0]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    opening = at[:-1][np.diff(at) > 0]
    starts[opening] = word[opening]
    run = np.concatenate([[0], np.cumsum(starts, dtype=np.int64)])
    return np.diff(run[at])


def _scan(phrases: dict[str, str], templates: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        for part in slices(batches, "text"):
            text, rows = part.column("text"), part.num_rows
            n_words = count_words(text)
            n_base, score = np.zeros(rows, np.int64), np.zeros(rows)
            first, last, base_labels, labels = [None] * rows, [None] * rows, [""] * rows, [""] * rows
            hinted = pc.fill_null(pc.match_substring_regex(text, scanner.hint), False).to_numpy(zero_copy_only=False)
            for k in np.flatnonzero(hinted).tolist():
                places = scanner.places(text[k].as_py())
                if not places:
                    continue
                if base := [(i, label) for i, _, is_base, label in places if is_base]:
                    n_base[k], first[k], last[k] = len(base), base[0][0], base[-1][0]
                    base_labels[k] = ",".join(sorted({x for _, x in base}))
                labels[k] = ",".join(sorted({x[3] for x in places}))
                covered = upto = 0
                for i, end, _, _ in places:
                    covered += max(0, end - max(i, upto))
                    upto = max(upto, end)
                score[k] = covered / n_words[k]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(n_words), pa.array(n_base), pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(base_labels), pa.array(labels), pa.array(score)],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return run


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per document (SCHEMA): base phrases, all labels, and the share of words under any of them."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(_scan(BASE_PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates), SCHEMA)


def license_places(docs: DataFrame) -> DataFrame:
    """op6: the contract's phrases and this library's templates."""
    return scan(docs)


# -- the same by regular expressions, in SQL ----------------------------------------------


def _expression(template: str) -> tuple[str, int]:
    """A template as a regular expression over words with a blank behind each, and the most words that it spans."""
    out, most = [], 0
    for text, mark in re.findall(r"([^<]+)|<<(.*?)>>", template, re.S):
        if text:
            most += len(lower_words(text))
            out += [w + " " for w in lower_words(text)]
        elif mark == "beginOptional":
            out.append("(?:")
        elif mark == "endOptional":
            out.append(")?")
        else:
            match = mark.split("match=")[1]
            if count := re.fullmatch(r"(\d+)-(\d+)", match):
                most += int(count[2])
                out.append("(?:[^ ]+ ){%s,%s}" % count.groups())
            else:  # longer wordings first: the longest match is wanted
                wordings = sorted((lower_words(x) for x in match.split("|")), key=len, reverse=True)
                most += len(wordings[0])
                out.append("(?:" + "|".join(" ".join(x) + " " for x in wordings) + ")")
    return "".join(out), most


def _places_sql(label: str, template: str, base: bool) -> str:
    x, most = _expression(template)
    return f"""SELECT r, '{label}' AS label, {base} AS base, i, length(x) - length(replace(x, ' ', '')) AS n
    FROM (SELECT r, i, regexp_extract(array_to_string(w[i + 1:i + {most}], ' ') || ' ', '^{x}') AS x
        FROM (SELECT r, w, unnest(range(len(w))) AS i FROM s WHERE regexp_matches(s, ' {x}'))) WHERE x <> ''"""


PLACES_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWERED}, '{WORD.pattern}') AS w FROM documents),
s AS (SELECT r, w, ' ' || array_to_string(w, ' ') || ' ' AS s FROM d WHERE len(w) > 0),
p AS ({" UNION ALL ".join([*(_places_sql(label, x, True) for x, label in BASE_PHRASES.items()), *(_places_sql(label, x, False) for label, x in TEMPLATES.items())])}),
b AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p WHERE base GROUP BY r),
l AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM p GROUP BY r),
c AS (SELECT r, count(*) AS covered FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS i FROM p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CASE WHEN len(w) > 0 THEN coalesce(covered, 0)::DOUBLE / len(w) ELSE 0.0::DOUBLE END AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN l USING (r) LEFT JOIN c USING (r)"""
