"""Packing tokenised documents into fixed windows, best fit decreasing.

A document's ids are cut into full windows and a rest.  The rests of a block of documents
are placed from the longest to the shortest, each into the open window that it fits most
tightly; a segment tree over remaining capacities finds it in log(window) steps.  Blocks are
runs of an input split, so nothing is shuffled, a task holds one block at a time, and a task
that is run again reads the same split and packs it the same way.  The few windows that a
block leaves less full than MIN_FILL are laid out as sequences of power-of-two lengths,
which need no padding.

A null text is an empty one: its only id is the end mark.  Repeated rows are packed as often
as they stand there.  An empty table gives an empty result.  Null ids of documents are kept.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epicentre.llm.common import coded_words, slices, starts_of

WINDOW = 4096
#: Fixed by the contract: the id that ends a document.
END_ID = 2
#: Ids that a task packs at a time.
BLOCK_IDS = 1 << 20
#: A window under this share is cut into powers of two.
MIN_FILL = 0.98
#: Strings whose ids a worker remembers, in each of two generations.
CACHE = 100_000
#: Bytes of text that a task turns into ids at a time.
SLICE = 6 << 20
#: Characters that are encoded at a time where texts are encoded as wholes.
WHOLE_CHARS = 1 << 20

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

_stores: dict[str, "_Ids"] = {}


class _Ids:
    """The ids of strings, encoded once while they are remembered; and which shortcuts this tokenizer allows.

    ``by_words``: a text's ids are those of its blank-separated strings, one after the other.
    ``plain``: moreover, an ASCII word has the ids of its lower-case form, and a full stop or comma behind
    it has its own.  ``direct``: such a word can skip the steps before the model.  Each is taken only
    where the probes bear it out, and where no entry of the vocabulary could break it.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.encoder, self.young, self.old = Tokenizer.from_file(path), {}, {}
        self.model = self.encoder.model
        added = [t.content for t in self.encoder.get_added_tokens_decoder().values()]
        self.by_words = self._by_words(added)
        self.plain = self.by_words and self._plain(added)
        self.direct = self.plain and all(self._direct(w) == self._ids(w) for w in ("a", "the", "licensed", "qzxwvj", "abcdefghijklmnopqrstuvwxyz"))

    def _ids(self, text: str) -> list[int]:
        return self.encoder.encode(text, add_special_tokens=False).ids

    def _direct(self, word: str) -> list[int]:
        return [t.id for t in self.model.tokenize(word)]

    def _by_words(self, added: list[str]) -> bool:
        # an entry with a blank (or its sign) between other characters can reach across words
        if any(re.search(r"\S[\s\u2581\u0120]+\S", t) for t in self.encoder.get_vocab(with_added_tokens=True)):
            return False
        strings = ["the", "of", "Word", "I'll", "7", "12.5", ".", "(x)", "-", "\u00fcn\u00ef", "\u4e2d\u6587", "\u0301", *added]
        gaps = [" ", "  ", "\t", "\n", "\r\n", "\x0b", "\x0c", " \n\n "]
        ids = {w: self._ids(w) for w in strings}
        return not any(self._ids(g) for g in gaps) and all(
            self._ids(f"{a}{g}{b}") == ids[a] + ids[b] and self._ids(f"{g}{a}{g}") == ids[a]
            for k, a in enumerate(strings) for b in (strings if k < 12 else strings[:12]) for g in gaps)

    def _plain(self, added: list[str]) -> bool:
        if any(re.fullmatch(r"[A-Za-z.,]+", t) for t in added):
            return False
        words = ["a", "I", "The", "LICENSED", "qZxwvj", "McDonald", "AbcdefghijklmnopqrstuvwxyZ", "etc", "U"]
        return all(self._ids(w + end) == self._ids(w.lower()) + self._ids(end) for w in words for end in ("", ".", ","))

    def whole(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, encoded as a whole."""
        run, held = [], 0
        for k, t in enumerate(texts):
            run.append(t)
            held += len(t)
            if held >= WHOLE_CHARS or k == len(texts) - 1:
                for e in self.encoder.encode_batch_fast(run, add_special_tokens=False):
                    yield np.array(e.ids, np.uint32)
                run, held = [], 0

    def of(self, words: list[str]) -> list[bytes]:
        if len(self.young) > CACHE:  # what wasn't asked for since the last time is forgotten
            self.old, self.young = self.young, {}
        young, old, out, new, direct = self.young, self.old, [], [], self.direct
        for k, w in enumerate(words):
            ids = young.get(w)
            if ids is None:
                ids = old.get(w)
                if ids is None and direct and w.isascii() and w.isalpha() and w.islower():
                    ids = array("I", self._direct(w)).tobytes()
                if ids is None:
                    new.append(k)
                else:
                    young[w] = ids
            out.append(ids)
        for i in range(0, len(new), 8192):
            part = [words[k] for k in new[i : i + 8192]]
            for k, w, e in zip(new[i : i + 8192], part, self.encoder.encode_batch_fast(part, add_special_tokens=False), strict=True):
                out[k] = young[w] = array("I", e.ids).tobytes()
        return out


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` with these starts and sizes, one after the other."""
    take = np.repeat(starts - starts_of(sizes), sizes)
    take += np.arange(len(take))
    return flat[take]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(text: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts (without end marks), one after the other, and how many each text has.

    Equal to encoding each text as a whole.  Where the tokenizer allows it (see _Ids), only
    distinct words are encoded.
    """
    if path not in _stores:
        _stores[path] = _Ids(path)
    store = _stores[path]
    if not store.by_words:
        ids = list(store.whole(pc.fill_null(text, "").to_pylist()))
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.array([len(x) for x in ids], np.int64)
    codes, distinct, counts = coded_words(text)
    if not len(codes):
        return np.zeros(0, np.uint32), np.zeros(len(counts), np.int64)
    plain = pc.match_substring_regex(distinct, "^[A-Za-z]+[.,]?$") if store.plain else pa.array(np.zeros(len(distinct), bool))
    words = pc.if_else(plain, pc.utf8_rtrim(pc.ascii_lower(distinct), ".,"), distinct)
    ends = np.where(plain, pc.ends_with(distinct, "."), False) + 2 * np.where(plain, pc.ends_with(distinct, ","), False)
    looked_up = words.dictionary_encode()
    blobs = store.of([*looked_up.dictionary.to_pylist(), "", ".", ","])
    flat = np.frombuffer(b"".join(blobs), dtype="<u4")
    sizes = np.fromiter(map(len, blobs), dtype=np.int64, count=len(blobs)) // 4
    starts = starts_of(sizes)
    # each distinct string is a word and what stands behind it
    two = np.stack([looked_up.indices.to_numpy().astype(np.int64), ends + len(blobs) - 3], axis=1).reshape(-1)
    flat = _gather(flat, starts[two], sizes[two])
    sizes = sizes[two].reshape(-1, 2).sum(axis=1)
    per_word = sizes[codes]
    bounds = np.concatenate([[0], np.cumsum(per_word)])
    ends_at = np.cumsum(counts)
    return _gather(flat, starts_of(sizes)[codes], per_word), bounds[ends_at] - bounds[ends_at - counts]


class OpenWindows:
    """Open windows by remaining capacity: a segment tree whose nodes count the windows below them."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.at: dict[int, list[int]] = {}

    def add(self, capacity: int, name: int) -> None:
        self.at.setdefault(capacity, []).append(name)
        i = capacity + self.leaves
        while i:
            self.count[i] += 1
            i >>= 1

    def tightest(self, need: int) -> int | None:
        """The least capacity >= need that an open window has."""
        count, i = self.count, need + self.leaves
        if count[i]:
            return need
        while i > 1 and (i & 1 or not count[i + 1]):
            i >>= 1
        if i <= 1:
            return None
        i += 1
        while i < self.leaves:
            i = 2 * i if count[2 * i] else 2 * i + 1
        return i - self.leaves

    def take(self, capacity: int) -> int:
        i = capacity + self.leaves
        while i:
            self.count[i] -= 1
            i >>= 1
        return self.at[capacity].pop()


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Window and offset of each length (all < window), longest first; and how full each window gets."""
    where, offset, filled = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    free = OpenWindows(window)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        room = free.tightest(n)
        if room is None:
            w, room = len(filled), window
            filled.append(0)
        else:
            w = free.take(room)
        where[i], offset[i] = w, window - room
        filled[w] += n
        if room > n:
            free.add(room - n, w)
    return where, offset, filled


def pack_block(n_ids: np.ndarray, window: int, min_fill: float, first: int) -> tuple[np.ndarray, ...]:
    """Pieces of documents with so many ids, in the documents' order: document, start, length, sequence, offset."""
    full, rest = n_ids // window, n_ids % window
    doc = np.repeat(np.arange(len(n_ids)), full)
    start = (np.arange(len(doc)) - np.repeat(starts_of(full), full)) * window
    some = np.flatnonzero(rest)
    where, offset, filled = best_fit(rest[some], window)
    low = np.array([f < min_fill * window for f in filled], dtype=bool)
    whole = ~low[where] if len(where) else np.zeros(0, bool)
    at = first + len(doc)  # windows of rests are numbered after the full ones
    out = [
        np.stack([doc, start, np.full(len(doc), window), first + np.arange(len(doc)), np.zeros(len(doc), np.int64)], axis=1),
        np.stack([some, full[some] * window, rest[some], at + where, offset], axis=1)[whole],
    ]
    at += len(filled)
    cut = []
    for w in np.flatnonzero(low).tolist():
        mine = np.flatnonzero(where == w)
        todo = [(int(some[i]), int(full[some[i]] * window), int(rest[some[i]])) for i in mine[np.argsort(offset[mine])]]
        left = filled[w]
        while left:
            size = room = 1 << (left.bit_length() - 1)
            while room:
                d, s, n = todo.pop(0)
                m = min(n, room)
                cut.append((d, s, m, at, size - room))
                if n > m:
                    todo.insert(0, (d, s + m, n - m))
                room -= m
            left -= size
            at += 1
    if cut:
        out.append(np.array(cut, dtype=np.int64))
    pieces = np.concatenate(out)
    pieces = pieces[np.lexsort((pieces[:, 1], pieces[:, 0]))]
    return (*pieces.T, at)


def _packer(path: str, window: int, block: int, min_fill: float, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get()
        names = (part.partitionId() if part else 0) << 40
        ids, sizes, docs, held, used = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, sizes, docs, held, used
            n_ids = np.concatenate(sizes)
            doc, start, length, seq, offset, used = pack_block(n_ids, window, min_fill, used)
            data = np.concatenate(ids).astype("<u4")
            bounds = np.concatenate([[0], np.cumsum(length)]) * 4
            blob = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
            doc_id = pa.concat_arrays(docs).take(pa.array(doc))
            out = pa.RecordBatch.from_arrays(
                [doc_id, pa.array(start), pa.array(length), blob, pa.array(n_ids[doc]), pa.array(names + seq), pa.array(offset)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            ids, sizes, docs, held = [], [], [], 0
            return out

        for part_of in slices(batches, "text", SLICE):
            flat, counts = encode(part_of.column("text"), path)
            ends = np.cumsum(counts)
            ids.append(np.insert(flat, ends, end_id))
            sizes.append(counts + 1)
            docs.append(part_of.column("doc_id").cast(pa.int64()))
            held += len(ids[-1])
            if held >= block:
                yield flush()
        if held:
            yield flush()

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, block_ids: int = BLOCK_IDS, min_fill: float = MIN_FILL,
         end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents (SCHEMA); ``ids`` holds a piece's ids as little-endian unsigned 32-bit integers.

    ``tokenizer`` is the path of a tokenizer file that every executor can read; any tokenizer of that
    library will do.  ``end_id`` ends each document.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(_packer(tokenizer or default_tokenizer(), window, block_ids, min_fill, end_id), SCHEMA)


def packed_pieces(docs: DataFrame) -> DataFrame:
    """op1: one row per piece, its ids as a checksum."""
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
