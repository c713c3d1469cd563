import re

import pytest

from epicentre.llm import license_scan as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    w = WORD.findall((text or "").translate(LOWER))
    hits = []
    for phrase, label in ls.BASE_PHRASES.items():
        x = phrase.split()
        hits += [(i, label) for i in range(len(w)) if w[i : i + len(x)] == x]
    return len(w), len(hits), min(hits)[0] if hits else None, max(hits)[0] if hits else None, ",".join(sorted({x for _, x in hits}))


def check(df):
    texts = sorted(((r.doc_id, *brute(r.text)) for r in df.collect()), key=repr)
    got = ls.license_places(df).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=repr) == texts
    for r in got:
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert (r.score > 0) == (r.labels != "")
    return {r.doc_id: r for r in got}


def test_base_matches_brute_force(sf001_docs):
    check(sf001_docs)


def test_phrases(docs_of):
    got = check(docs_of([
        (1, "CC-BY 4.0, cc by; CC  BY"), (2, "cc bye ccc by cc by"), (3, "ALL RIGHTS\nRESERVED. all rights all rights reserved"),
        (4, "GNU General Public License"), (5, "general public\x00license"), (6, "ccby")]))
    assert got[1].n_base == 3 and got[2].n_base == 0 and got[3].n_base == 2 and got[4].base_labels == "gpl" and got[5].n_base == 1 and got[6].n_base == 0


def test_odd_inputs(odd_docs, clash, docs_of):
    check(odd_docs)
    check(clash(odd_docs))
    assert check(docs_of([])) == {}


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software."""


def test_templates(docs_of):
    got = check(docs_of([
        (1, MIT), (2, MIT.replace("and\nassociated documentation files ", "")), (3, MIT.replace("merge", "melt")),
        (4, "This work is licensed under the GNU General Public License, version 3."), (5, "Licensed under the Apache License, Version 2.0."),
        (6, "Released under the MIT License"), (7, "Copyright (c) 2020 Ada Lovelace. All rights reserved"), (8, "licensed under CC BY-NC 4.0")]))
    assert "text:mit" in got[1].labels and "text:mit" in got[2].labels and got[1].score == 1
    assert "text:mit" not in got[3].labels
    assert got[4].labels == "gpl,notice:gpl" and got[5].labels == "notice:apache" and got[6].labels == "notice:mit"
    assert got[7].labels == "copyright,reserved" and got[8].labels == "cc-by,notice:cc"


@pytest.mark.parametrize(("template", "text", "end"), [
    ("a b", "A, b c", 2), ("a <<beginOptional>>x <<beginOptional>>y <<endOptional>><<endOptional>>b", "a x b", 3), ("a <<beginOptional>>x <<beginOptional>>y <<endOptional>><<endOptional>>b", "a x y b", 4),
    ("a <<beginOptional>>x <<beginOptional>>y <<endOptional>><<endOptional>>b", "a y b", None), ("a <<var;name=n;match=0-2>> b", "a b", 2), ("a <<var;name=n;match=1-2>> b", "a b", None),
    ("a <<var;name=n;match=1-2>> b", "a p q b", 4), ("a <<var;name=n;match=1-2>> b", "a p q r b", None), ("a <<var;name=n;match=x y|z>> b", "a x y b", 4), ("a <<var;name=n;match=x y|z>> b", "a z b", 3),
    ("a <<var;name=n;match=0-3>>", "a b", 2)])
def test_automaton(template, text, end):
    assert ls.Automaton(template).accepts(ls.lower_words(text), 0) == end


@pytest.mark.parametrize("template", ["<<var;name=n;match=0-1>> a", "<<beginOptional>>a<<endOptional>>", "a <<beginOptional>>b", "a <<nonsense>>"])
def test_unusable_templates_raise(template):
    with pytest.raises(ValueError, match=r"template|markup|closed"):
        ls.Automaton(template)
