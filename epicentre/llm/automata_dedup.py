"""Exact substring deduplication by suffix automata of reference shards.

A word is removed if a window of ``window`` words that covers it also stands in a document
with a smaller id.  Which documents can share a window is found by winnowing: the least hash
among a window's runs of ``run`` words is the same wherever the window stands, and windows
next to each other mostly have the same one.  The document with the least id that has such a
value is its reference.

Reference regions (the windows of a reference that have its values) are dealt into shards of
bounded size.  The other documents' regions with these values are streamed past the suffix
automaton of the shard, each of whose states knows the least document that it stands in;
matching statistics, cut at the window's length, tell which windows a smaller document has.
The automaton is sent where its regions are, and to several tasks if many documents stream
past it, instead of to all tasks: a document meets only shards that it shares a value with.

A window that its value's reference lacks can still stand in two other documents.  Such
windows are few (they cross the end of a shared passage or an edited word) and go through
the same steps once more, now with the whole window as the value, which settles them.

Null and empty texts have no words.  Documents with a null id neither lose words nor make
others lose some; rows that share an id don't either among themselves, each is judged by its
own text.
An empty table gives an empty result.  Texts keep the white space between kept words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from epicentre.llm.common import coded_words, may_be_in, mix, n_words_of, slices, starts_of, string_hashes, words_of, written

#: Fixed by the contract.
WINDOW = 50
#: Words of the runs whose hashes are compared; a window has WINDOW - RUN + 1 of them.
RUN = 25
#: Words of a shard's references, and of what one task streams past them (expected).
SHARD_WORDS, STREAM_WORDS = 100_000, 1_000_000
#: Runs of windows of one document and reference are one region if no more windows lie between.
BRIDGE = 25

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_REGION = "ref long, doc_id long, row long, start long, words array<long>"
_MATCHED = "doc_id long, row long, start long, stop long, words array<long>"


# -- windows and their values ------------------------------------------------------------


def _runs(h: np.ndarray, k: int) -> np.ndarray:
    acc = np.zeros(max(len(h) - k + 1, 0), np.uint64)
    for j in range(k):
        acc = mix(acc + h[j : len(h) - k + 1 + j] + np.uint64(0x9E3779B97F4A7C15))
    return acc


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w values in a row."""
    n, have = max(len(x) - w + 1, 0), 1
    while have < w and len(x):
        step = min(have, w - have)
        x = np.minimum(x[: len(x) - step], x[step:])
        have += step
    return x[:n]


def window_values(h: np.ndarray, counts: np.ndarray, window: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in the row and value of every window of the rows' words."""
    values = _least(_runs(h, run), window - run + 1)
    n = np.maximum(counts - window + 1, 0)
    row = np.repeat(np.arange(len(counts)), n)
    place = np.arange(int(n.sum())) - np.repeat(starts_of(n), n)
    return row, place, values[place + np.repeat(starts_of(counts), n)] if len(row) else np.zeros(0, np.uint64)


def _text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for part in slices(batches, "text"):
        codes, distinct, counts = coded_words(part.column("text"))
        yield part, string_hashes(distinct)[codes], counts


def _list(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], np.diff(offsets).astype(np.int64)


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for a in range(0, batch.num_rows, 4096):
            part = batch.slice(a, 4096)
            words, counts = _list(part.column("words"))
            yield part, words.view(np.uint64), counts


def _values(rows, window: int, run: int):
    """(value, doc_id), once for windows in a row."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, h, counts in rows(batches):
            row, _, value = window_values(h, counts, window, run)
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
            doc = part.column("doc_id").to_numpy()[row[new]]
            yield pa.RecordBatch.from_arrays([pa.array(value[new].view(np.int64)), pa.array(doc)], names=["value", "doc_id"])

    return go


def _regions(rows, window: int, run: int):
    """Regions of rows that carry, sorted, the shared values of their document and the values' references."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, h, counts in rows(batches):
            row, place, value = window_values(h, counts, window, run)
            shared, n_shared = _list(part.column("vals"))
            refs, _ = _list(part.column("refs"))
            ref = np.full(len(row), -1, np.int64)
            has = np.zeros(len(row), bool)
            at = starts_of(n_shared)
            first = np.searchsorted(row, np.arange(len(counts) + 1))
            for r in range(len(counts)):
                mine = shared[at[r] : at[r] + n_shared[r]]
                if len(mine) and first[r] < first[r + 1]:
                    v = value[first[r] : first[r + 1]].view(np.int64)
                    i = np.minimum(np.searchsorted(mine, v), len(mine) - 1)
                    has[first[r] : first[r + 1]] = mine[i] == v
                    ref[first[r] : first[r + 1]] = refs[at[r] : at[r] + n_shared[r]][i]
            keep = np.flatnonzero(has)
            keep = keep[np.lexsort((place[keep], ref[keep], row[keep]))]
            row, place, ref = row[keep], place[keep], ref[keep]
            if not len(row):
                continue
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (ref[1:] != ref[:-1]) | (place[1:] - place[:-1] > BRIDGE)
            a = np.flatnonzero(new)
            b = np.append(a[1:], len(row)) - 1
            size = place[b] - place[a] + window
            offset = starts_of(counts)[row[a]] + place[a]
            take = np.arange(int(size.sum())) + np.repeat(offset - starts_of(size), size)
            begin = place[a] + (part.column("start").to_numpy()[row[a]] if "start" in part.schema.names else 0)
            words = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(h[take].view(np.int64)))
            of = lambda name: pa.array(part.column(name).to_numpy()[row[a]])  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([pa.array(ref[a]), of("doc_id"), of("row"), pa.array(begin.astype(np.int64)), words], names=["ref", "doc_id", "row", "start", "words"])

    return go


# -- the automaton -----------------------------------------------------------------------


class SuffixAutomaton:
    """Of several word sequences; each state knows the least document that its strings stand in."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.least = [-1], [0], [1 << 62]

    def add(self, words: list[int], doc: int) -> None:
        """The sequences of the documents, in any order; they don't join up."""
        nexts, link, size, least = self.next, self.link, self.size, self.least
        last = 0
        for c in words:
            q = nexts[last].get(c)
            if q is not None and size[q] == size[last] + 1:  # stands in an earlier sequence
                last = q
                if doc < least[q]:
                    least[q] = doc
                continue
            if q is None:
                cur = len(size)
                nexts.append({})
                link.append(0)
                size.append(size[last] + 1)
                least.append(doc)
                p = last
                while p != -1 and c not in nexts[p]:
                    nexts[p][c] = cur
                    p = link[p]
                if p != -1:
                    q = nexts[p][c]
                    link[cur] = q if size[q] == size[p] + 1 else self._split(p, c, q)
                last = cur
            else:
                last = self._split(last, c, q)
                if doc < least[last]:
                    least[last] = doc

    def _split(self, p: int, c: int, q: int) -> int:
        nexts, link, size = self.next, self.link, self.size
        clone = len(size)
        nexts.append(dict(nexts[q]))
        link.append(link[q])
        size.append(size[p] + 1)
        self.least.append(self.least[q])
        link[q] = clone
        while p != -1 and nexts[p].get(c) == q:
            nexts[p][c] = clone
            p = link[p]
        return clone

    def finish(self) -> None:
        """Hand each state's least document to the shorter strings that end with it."""
        for s in np.argsort(-np.array(self.size), kind="stable").tolist():
            p = self.link[s]
            if p >= 0 and self.least[s] < self.least[p]:
                self.least[p] = self.least[s]

    def covered(self, words: list[int], doc: int, window: int) -> list[int]:
        """The starts of those windows of ``words`` that stand in a document less than ``doc``."""
        nexts, link, size, least = self.next, self.link, self.size, self.least
        v = n = 0
        out = []
        for i, c in enumerate(words):
            while v and c not in nexts[v]:
                v = link[v]
                n = size[v]
            if c in nexts[v]:
                v = nexts[v][c]
                n += 1
                if n > window:
                    n = window
                while size[link[v]] >= n and v:  # the state of just these n words
                    v = link[v]
                if n == window and least[v] < doc:
                    out.append(i - window + 1)
        return out


def _stretches(starts: np.ndarray, window: int, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows at these (sorted) starts as stretches of words; windows up to ``gap`` apart are joined."""
    cut = np.flatnonzero(np.diff(starts) > gap)
    return starts[np.concatenate([[0], cut + 1])], starts[np.append(cut, len(starts) - 1)] + window


def _match(window: int, last: bool):
    """One shard: its references' automaton, and what the other documents' regions have in common with it."""

    def go(group: pa.Table) -> pa.Table:
        ref, doc, line, start = (group[c].to_numpy() for c in ("ref", "doc_id", "row", "start"))
        h, counts = _list(pa.concat_arrays(group["words"].chunks))
        at = starts_of(counts)
        own = np.flatnonzero(ref == doc)
        own = own[np.lexsort((start[own], doc[own]))]
        symbols = np.unique(np.concatenate([h[at[r] : at[r] + counts[r]] for r in own])) if len(own) else np.zeros(0, np.int64)
        found = np.searchsorted(symbols, h)
        known = np.append(symbols, 0)[found] == h
        codes = np.where(known & (found < len(symbols)), found, -1)
        automaton = SuffixAutomaton()
        for r in own:
            automaton.add(codes[at[r] : at[r] + counts[r]].tolist(), int(doc[r]))
        automaton.finish()
        out: list[tuple[int, int, int, int, np.ndarray | None]] = []
        for r in np.flatnonzero(ref != doc).tolist():
            words = codes[at[r] : at[r] + counts[r]].tolist()
            hit = np.array(automaton.covered(words, int(doc[r]), window), np.int64)
            if len(hit):
                out += [(int(doc[r]), int(line[r]), int(start[r] + a), int(start[r] + b), None) for a, b in zip(*_stretches(hit, window, window), strict=True)]
            if not last:
                rest = np.setdiff1d(np.arange(counts[r] - window + 1), hit)
                if len(rest):
                    out += [(int(doc[r]), int(line[r]), int(start[r] + a), int(start[r] + b), h[at[r] + a : at[r] + b]) for a, b in zip(*_stretches(rest, window, 1), strict=True)]
        types = [pa.int64()] * 4 + [pa.list_(pa.int64())]
        names = ["doc_id", "row", "start", "stop", "words"]
        return pa.table({n: pa.array([x[i] for x in out], t) for i, (n, t) in enumerate(zip(names, types, strict=True))})

    return go


# -- the steps ---------------------------------------------------------------------------


def _round(source: DataFrame, rows, window: int, run: int, last: bool, name: str) -> DataFrame:
    """_MATCHED: stretches to remove (no words) and, unless it is the last round, stretches that aren't settled."""
    values = source.mapInArrow(_values(rows, window, run), "value long, doc_id long")
    shared = values.groupBy("value").agg(F.min("doc_id").alias("ref"), F.max("doc_id").alias("most")).where("ref < most").drop("most")
    held = values.join(shared, "value").distinct()
    # at most one entry for each window of a document
    held = held.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("value", "ref"))).alias("x")).select("doc_id", F.col("x.value").alias("vals"), F.col("x.ref").alias("refs"))
    held = written(held, f"substrings-values{name}")
    near = may_be_in(source, "doc_id", held.select("doc_id"), "__near").where("__near").drop("__near")
    regions = near.join(held, "doc_id").mapInArrow(_regions(rows, window, run), _REGION)
    regions = written(regions, f"substrings-regions{name}")

    is_ref = F.col("ref") == F.col("doc_id")
    n = F.size("words").cast("long")
    total = regions.agg(F.sum(F.when(is_ref, n)), F.sum(F.when(~is_ref, n))).first()
    shards = max(1, -(-(total[0] or 0) // SHARD_WORDS), -(-(total[1] or 0) // STREAM_WORDS))
    # a reference that many documents stream past gets tasks of its own
    busy = regions.where(~is_ref).groupBy("ref").agg(F.sum(n).alias("load")).where(F.col("load") > STREAM_WORDS).select("ref", F.ceil(F.col("load") / STREAM_WORDS).cast("int").alias("ways"))
    d = regions.join(written(busy, f"substrings-busy{name}"), "ref", "left")
    mine = F.when(is_ref, F.sequence(F.lit(0), F.col("ways") - 1)).otherwise(F.array(F.pmod(F.xxhash64("doc_id", "start"), F.col("ways")).cast("int")))
    d = d.withColumn("way", F.explode(F.when(F.col("ways").isNull(), F.array(F.lit(-1))).otherwise(mine)))
    d = d.withColumn("shard", F.when(F.col("ways").isNull(), F.pmod(F.xxhash64("ref"), F.lit(shards))).otherwise(F.col("ref")))
    return written(d.select("shard", "way", "ref", "doc_id", "row", "start", "words").groupBy("shard", "way").applyInArrow(
        _match(window, last), _MATCHED), f"substrings-matched{name}")


def repeated_stretches(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """doc_id, row, start, stop (words, from 0): what is to be removed; stretches of one document may overlap.

    ``row`` is a hash of the text; it tells rows apart that share an id.
    """
    d = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), F.col("text").cast("string").alias("text"))
    once = _round(d, _text_rows, window, run, False, "1")
    open_ones = once.where("words IS NOT NULL").select("doc_id", "row", "start", "words")
    again = _round(open_ones, _word_rows, window, window, True, "2")
    return once.where("words IS NULL").select("doc_id", "row", "start", "stop").unionByName(again.select("doc_id", "row", "start", "stop"))


def _kept_text(text: str, cuts: list[dict]) -> tuple[str, int]:
    """The text without these stretches of words, and how many words went; white space stays where it is before a kept word."""
    at = [m.span() for m in _WORD.finditer(text)]
    keep = np.ones(len(at), bool)
    for c in cuts:
        keep[c["start"] : c["stop"]] = False
    out, upto = [], 0
    for i, (a, b) in enumerate(at):
        if keep[i]:
            out.append(text[upto if out else a : b])
        upto = b
    if out and keep[-1]:
        out.append(text[upto:])
    return "".join(out), int(len(at) - keep.sum())


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        done = [_kept_text(t or "", c) for t, c in zip(part.column("text").to_pylist(), part.column("__cuts").to_pylist(), strict=True)]
        columns = [c for n, c in zip(part.schema.names, part.columns, strict=True) if n not in ("text", "__cuts")]
        names = [n for n in part.schema.names if n not in ("text", "__cuts")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([t for t, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=[*names, "text", "__gone"])


def without_repeats(docs: DataFrame, window: int = WINDOW, run: int = RUN, removed: str | None = None) -> DataFrame:
    """``docs`` with repeated stretches cut from ``text``; ``removed`` names a column for the number of words that went.

    Only texts that lose words are joined with their stretches; the others stay as they are.
    """
    own = docs.columns
    cuts = repeated_stretches(docs, window, run).groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).agg(F.collect_list(F.struct("start", "stop")).alias("__cuts"))
    cuts = written(cuts, "substrings-cuts")
    seen = may_be_in(docs, "doc_id", cuts.select("__id"), "__near")
    near = seen.where("__near").drop("__near").join(cuts, (F.col("doc_id").cast("long") == F.col("__id")) & (F.xxhash64("text") == F.col("__row")), "left").drop("__id", "__row")
    cut = near.where("__cuts IS NOT NULL")
    schema = StructType([f for f in docs.schema if f.name != "text"] + [StructField("text", StringType()), StructField("__gone", LongType())])
    as_was = near.where("__cuts IS NULL").select(*own).unionByName(seen.where("NOT __near").select(*own)).withColumn("__gone", F.lit(0).cast("long"))
    out = as_was.unionByName(cut.mapInArrow(_cut, schema).select(*own, "__gone"))
    return out.select(*own, *([F.col("__gone").alias(removed)] if removed else []))


def kept_words(docs: DataFrame) -> DataFrame:
    """op3: what is left of every document."""
    d = without_repeats(docs.select("doc_id", "text"), removed="n_removed")
    left = words_of(F.col("text"))
    return d.select("doc_id", (n_words_of(F.col("text")) + F.col("n_removed")).alias("n_words"), "n_removed", F.sha2(F.array_join(left, " "), 256).alias("kept_sha256"))


KEPT_SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT r, doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
hit AS (SELECT r, i FROM (SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY k) AS least FROM win) WHERE least < doc_id),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS p FROM hit),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS t FROM (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w) ANTI JOIN gone USING (r, p) GROUP BY r),
n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN n USING (r) LEFT JOIN kept USING (r)
"""
