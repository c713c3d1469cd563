"""Queries whose DuckDB SQL is another way to the same rows: models, distances and automata."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))

from check_oracle import canon  # noqa: E402

from epicentre.llm import katz, langid, license_scan as ls  # noqa: E402

QUERIES = {"op2": (katz.scored, katz.SCORED_SQL), "op6": (ls.license_places, ls.PLACES_SQL), "op9": (langid.identified, langid.IDENTIFIED_SQL)}


def agree(df, query, sql):
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    cur = con.execute(sql)
    want = canon([c[0] for c in cur.description], cur.fetchall())
    got = query(df)
    assert canon(got.columns, [tuple(r) for r in got.collect()]) == want


@pytest.mark.parametrize("name", QUERIES)
def test_given_table(sf001_docs, name):
    agree(sf001_docs, *QUERIES[name])


@pytest.mark.parametrize("name", QUERIES)
def test_odd_rows(odd_docs, docs_of, name):
    agree(odd_docs, *QUERIES[name])
    agree(docs_of([]), *QUERIES[name])


def test_few_counts(docs_of):
    """Models where nothing is discounted, and where Good-Turing gives no discount."""
    agree(docs_of([(1, "a a a a a a a a b b b b b b b b")] * 9), *QUERIES["op2"])
    agree(docs_of([(i, "a b") for i in range(40)] + [(40, "b a c"), (41, "z")]), *QUERIES["op2"])
    agree(docs_of([(i, " ".join("abcdefg"[(i * k) % 7] for k in range(1, 1 + i % 9))) for i in range(60)]), *QUERIES["op2"])


def test_ties_of_languages(docs_of):
    agree(docs_of([(i, t, "s", lang) for i, (t, lang) in enumerate([("ab ba", "y"), ("ab ba", "x"), ("ÄB ß", "x"), ("q", "z"), ("ab", None), ("1 2", "x")] * 6)]), *QUERIES["op9"])


AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so"""
MIT = GRANT + """, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

""" + AS_IS
BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
  1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
  2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
     disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""
BSD3 = BSD2.replace("THIS SOFTWARE IS PROVIDED BY", """* Neither the name of Ada's Engines, Inc. nor the names of its contributors may be used
to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY""").replace("1. ", "* ").replace("2. ", "* ")
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
WHOLE = {"license:mit": MIT, "license:mit-0": GRANT + ". " + AS_IS, "license:bsd-2-clause": BSD2, "license:bsd-3-clause": BSD3, "license:isc": ISC,
         "license:0bsd": ISC.replace(",\nprovided that the above copyright notice and this permission notice appear in all copies", ""), "license:apache-2.0-header": APACHE, "license:gpl-header": GPL}


def whole_labels(row):
    return {x for x in row.labels.split(",") if x.startswith("license:")}


def test_whole_licenses(docs_of):
    """Each text gets its own license and no other; an altered condition or disclaimer gets none."""
    labels = list(WHOLE)
    df = docs_of([(k, "Copyright 2020 Ada\n" + WHOLE[x]) for k, x in enumerate(labels)]
                 + [(100, MIT.replace("substantial portions", "small portions")), (101, MIT.replace("NONINFRINGEMENT", "TITLE")), (102, MIT.replace("AUTHORS OR", "WRITERS AND")),
                    (103, BSD3.replace("endorse", "sell")), (104, ISC + " " + MIT), (105, APACHE.replace("http://www.apache.org/licenses/LICENSE-2.0", "")), (106, "<!-- " + GPL.lower().replace(" ", "\n * ") + " -->")])
    got = {r.doc_id: r for r in ls.license_places(df).collect()}
    assert [whole_labels(got[k]) for k in range(len(labels))] == [{x} for x in labels]
    assert [whole_labels(got[k]) for k in range(100, 107)] == [set(), set(), {"license:mit"}, set(), {"license:isc", "license:mit"}, set(), {"license:gpl-header"}]
    assert all(got[k].score > 0.9 for k in range(len(labels)))
    agree(df, *QUERIES["op6"])


def test_overlaps_and_longest_matches(docs_of):
    agree(docs_of([
        (1, "Released under CC BY NC SA 4.0, released under cc by sa"), (2, "licensed under a creative commons by nc"), (3, "Copyright (c) 1 2 3 a b all rights reserved all rights reserved"),
        (4, "this this is is licensed under the MIT license"), (5, "distributed under the terms of the gnu lesser general public license version 2 1 of"), (6, "Ünder ÀLL all rights reserved"),
        (7, "Copyright x y all rights reserved. Copyright all rights reserved; copyright copyright b c all rights reserved")]), *QUERIES["op6"])
