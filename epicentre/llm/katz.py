"""Language-model scores by a Katz backoff bigram model learnt from the documents themselves.

Model.  Counts of words and word pairs over the training documents; a document is its words
and one end mark, and its first word follows a start mark.  Counts up to CUTOFF are discounted
by Good-Turing (where the counts of counts give no discount between 0 and 1, by absolute
discounting).  For a pair (h, w) that was seen, P(w|h) = d c(h,w) / c(h); else it is
alpha(h) P(w), and for a context that never occurred P(w).  alpha(h) is what the discounts
leave of h, divided by what P leaves to words not seen after h, so every distribution sums to
exactly one over the known words and one unknown word, which gets the discounted mass of P.
Where nothing is discounted, one is added to the denominator and left to the unseen.

Execution.  Documents are turned into blocks of a few million words inside the scan's tasks.
The two tables (words by their hash, pairs by their context's) are dealt over partitions that
grow with the text.  A block sends each partition its distinct entries with their counts, in
order, and gets the totals back in that order; with these at hand it evaluates each of its
tokens from the pair down to the unknown word.  So only distinct entries of a block are
shuffled, as compressed arrays.  A context that holds many tokens is split over partitions by
the word that follows; its statistics are sums, which the block adds up.

``docs`` must be a table read from files: blocks are made anew in each pass and known by a
checksum; if they differ, the run fails (write the table first).  Words are compared by 64-bit
hashes.  Null and empty texts have the end mark only; a very long text is one document of one
block, however long.  Documents with a null id are scored but
not learnt from.  Repeated rows count as often as they stand there.  With nothing to learn
from, all tokens are unknown and have probability 1.  An empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epicentre.llm.common import CRC32_OF_ID, LOWERED, WORD, coded_words, crc32_of_id, mix, slices, starts_of, string_hashes, written

#: Fixed by the contract: the documents with this remainder aren't learnt from.
FOLDS, HELD_OUT = 7, 2
#: Counts above this aren't discounted.
CUTOFF = 5
#: Tokens in a block, and bytes of text for each partition of the tables.
BLOCK_TOKENS, BYTES_PER_PART = 1_500_000, 10 << 20
#: Hashes of the end and start marks; no word is hashed to these but by chance.
END, START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
WORDS, PAIRS = 0, 1

SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


# -- arrays as bytes ---------------------------------------------------------------------


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Compressed: integers in the narrowest type that holds them, hashes as differences, bytes of like weight together."""
    head, body = [struct.pack("<B", len(arrays))], []
    for a in arrays:
        hashes = a.dtype == np.uint64
        if hashes:
            a = np.diff(a, prepend=np.uint64(0))  # small where the hashes are sorted
        elif a.dtype.kind in "iu":
            a = a.astype(np.min_scalar_type(int(a.max(initial=0))))
        a = np.ascontiguousarray(a)
        head.append(struct.pack("<?2sq", hashes, a.dtype.str[1:].encode(), len(a)))
        body.append(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    data = b"".join(head + body)
    return struct.pack("<q", len(data)) + pa.compress(data, codec="zstd", asbytes=True)


def unpack_arrays(blob: bytes) -> list[np.ndarray]:
    data = pa.decompress(blob[8:], decompressed_size=struct.unpack_from("<q", blob)[0], codec="zstd", asbytes=True)
    n, out = data[0], []
    at = 1 + 11 * n
    for i in range(n):
        hashes, kind, size = struct.unpack_from("<?2sq", data, 1 + 11 * i)
        t = np.dtype("<" + kind.decode())
        a = np.ascontiguousarray(np.frombuffer(data, np.uint8, size * t.itemsize, at).reshape(t.itemsize, size).T).reshape(-1).view(t)
        out.append(np.cumsum(a, dtype=np.uint64) if hashes else a)
        at += size * t.itemsize
    return out


# -- blocks ------------------------------------------------------------------------------


class Block:
    """Whole documents: ids, whether they are learnt from and held out, their tokens as codes into sorted hashes."""

    def __init__(self, doc_id: np.ndarray, flags: np.ndarray, n_tokens: np.ndarray, vocab: np.ndarray, codes: np.ndarray):
        self.doc_id, self.flags, self.n_tokens, self.vocab, self.codes = doc_id, flags, n_tokens, vocab, codes

    def name(self) -> int:
        x = self.vocab[self.codes] + mix(np.arange(len(self.codes), dtype=np.uint64))
        y = mix(self.doc_id.astype(np.uint64)) + mix(self.n_tokens.astype(np.uint64) * np.uint64(8) + self.flags.astype(np.uint64)) + np.arange(len(self.doc_id), dtype=np.uint64)
        return int((mix(x).sum(dtype=np.uint64) ^ mix(mix(y)).sum(dtype=np.uint64)).astype(np.int64))

    def packed(self) -> bytes:
        order = np.argsort(-np.bincount(self.codes, minlength=len(self.vocab)), kind="stable")  # frequent words get small codes
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        return pack_arrays(self.doc_id.astype(np.uint64), self.flags, self.n_tokens, self.vocab[order], place[self.codes])

    @classmethod
    def unpacked(cls, blob: bytes) -> Block:
        doc_id, flags, n_tokens, vocab, codes = unpack_arrays(blob)
        order = np.argsort(vocab)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return cls(doc_id.astype(np.int64), flags, n_tokens.astype(np.int64), vocab[order], place[codes])

    def learnt(self) -> np.ndarray:
        """For each token, whether its document is learnt from."""
        return np.repeat((self.flags & 1).astype(bool), self.n_tokens)

    def contexts(self) -> np.ndarray:
        """For each token the code of what it follows; the start mark's code is the size of the vocabulary."""
        h = np.concatenate([[len(self.vocab)], self.codes[:-1]]) if len(self.codes) else self.codes
        h = h.copy()
        h[starts_of(self.n_tokens)] = len(self.vocab)
        return h


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_TOKENS) -> Iterator[Block]:
    """Blocks of rows (doc_id, flags, text), the end mark put behind each text."""
    ids, flags, sizes, vocabs, codes, held = [], [], [], [], [], 0

    def block() -> Block:
        vocab, where = np.unique(np.concatenate([*vocabs, [END]]), return_inverse=True)
        cuts = np.cumsum([0, *map(len, vocabs)])
        all_codes = []
        for (c, counts), a, b in zip(codes, cuts, cuts[1:], strict=False):
            all_codes.append(np.insert(where[a:b][c], np.cumsum(counts), where[-1]))
        return Block(np.concatenate(ids), np.concatenate(flags), np.concatenate(sizes), vocab, np.concatenate(all_codes))

    for part in slices(batches, "text"):
        c, distinct, counts = coded_words(part.column("text"), lower=True)
        ids.append(part.column("doc_id").fill_null(-1).to_numpy().astype(np.int64))
        flags.append(part.column("flags").to_numpy().astype(np.uint8))
        sizes.append(counts + 1)
        vocabs.append(string_hashes(distinct))
        codes.append((c, counts))
        held += int(sizes[-1].sum())
        if held >= limit:
            yield block()
            ids, flags, sizes, vocabs, codes, held = [], [], [], [], [], 0
    if held:
        yield block()


# -- what a block asks of the tables -----------------------------------------------------


class WordAsk:
    """A block's distinct words in the order of (partition, hash)."""

    def __init__(self, block: Block, parts: int):
        part = (mix(block.vocab) % np.uint64(parts)).astype(np.int64)
        self.order = np.argsort(part, kind="stable")
        self.parts, first = np.unique(part[self.order], return_index=True)
        self.cuts = [*first.tolist(), len(part)]

    def slices(self) -> Iterator[tuple[int, np.ndarray]]:
        for p, a, b in zip(self.parts.tolist(), self.cuts, self.cuts[1:], strict=False):
            yield p, self.order[a:b]


class PairAsk:
    """A block's distinct pairs in the order of (partition, context, word), the codes being sorted as the hashes are."""

    def __init__(self, block: Block, parts: int, totals: np.ndarray, train_docs: int, train_tokens: int):
        v = len(block.vocab)
        self.keys, self.token = np.unique(block.contexts() * np.int64(v + 1) + block.codes, return_inverse=True)
        self.h, self.w = self.keys // (v + 1), self.keys % (v + 1)
        self.h_hash = np.concatenate([block.vocab, [START]])
        # a context with more than half a partition's share of tokens is split
        self.h_total = np.concatenate([totals, [train_docs]])
        self.split = np.maximum(1, self.h_total * 2 * parts // max(train_tokens, 1))
        ways = self.split[self.h]
        sub = (mix(block.vocab[self.w] + np.uint64(1)) % ways.astype(np.uint64)).astype(np.int64)
        part = _pair_part(self.h_hash[self.h], sub, parts)
        self.order = np.argsort(part, kind="stable")
        self.parts, first = np.unique(part[self.order], return_index=True)
        self.cuts = [*first.tolist(), len(part)]
        # split contexts are asked for in each of their partitions, also where the block has no pair
        wide = np.flatnonzero(self.split > 1)
        wide = wide[np.isin(wide, self.h)]
        x, s = np.repeat(wide, self.split[wide]), np.concatenate([np.arange(n) for n in self.split[wide]] or [np.zeros(0, np.int64)])
        at = _pair_part(self.h_hash[x], s, parts)
        self.wide: dict[int, np.ndarray] = {int(p): np.unique(x[at == p]) for p in np.unique(at)}

    def slices(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(partition, pairs, contexts in order, split contexts)"""
        own = dict(zip(self.parts.tolist(), zip(self.cuts, self.cuts[1:], strict=False), strict=True))
        none = np.zeros(0, np.int64)
        for p in sorted({*own, *self.wide}):
            a, b = own.get(p, (0, 0))
            pairs = self.order[a:b]
            yield p, pairs, np.unique(self.h[pairs]), self.wide.get(p, none)


def _pair_part(h_hash: np.ndarray, sub: np.ndarray, parts: int) -> np.ndarray:
    return (mix(h_hash + sub.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(parts)).astype(np.int64)


# -- counting ----------------------------------------------------------------------------


def counts_of_counts(counts: np.ndarray) -> np.ndarray:
    """How many counts are 1, 2, ... CUTOFF + 1."""
    return np.bincount(counts[(counts > 0) & (counts <= CUTOFF + 1)], minlength=CUTOFF + 2)[1:].astype(np.int64)


def discounts(n: list[int]) -> np.ndarray:
    """The factor for each count 0 .. CUTOFF (0 unused), from the counts of counts 1 .. CUTOFF + 1."""
    k, d = CUTOFF, np.ones(CUTOFF + 1)
    absolute = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    common = (k + 1) * n[k] / n[0] if n[0] else 1.0
    for r in range(1, k + 1):
        turing = ((r + 1) * n[r] / (r * n[r - 1]) - common) / (1 - common) if n[r - 1] and common < 1 else 0.0
        d[r] = turing if 0 < turing < 1 else 1 - absolute / r
    return d


class Unigrams:
    """P(w) from the total count of a word, given N, the counts of counts and their discounts."""

    def __init__(self, tokens: int, n: list[int]):
        self.tokens, self.d = tokens, discounts(n)
        free = sum((1 - self.d[r]) * r * n[r - 1] for r in range(1, CUTOFF + 1))
        self.over = tokens if free > 0 else tokens + 1
        self.unknown = (free if free > 0 else 1.0) / self.over

    def p(self, totals: np.ndarray) -> np.ndarray:
        return np.where(totals > 0, totals * self.d[np.minimum(totals, CUTOFF) * (totals <= CUTOFF)] / self.over, self.unknown)


def _word_rows(parts: int):
    """Pass 1: (part, block, hashes and counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            counts = np.bincount(block.codes[block.learnt()], minlength=len(block.vocab))
            rows = [(p, pack_arrays(block.vocab[i], counts[i])) for p, i in WordAsk(block, parts).slices()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in rows], pa.int64()), pa.array([block.name()] * len(rows), pa.int64()), pa.array([x for _, x in rows], pa.binary())], names=["part", "block", "ask"])

    return run


def _word_totals(group: pa.Table) -> pa.Table:
    """The totals of one partition's words, told to each block in the order that it asked in; counts of counts once."""
    asked = [unpack_arrays(x.as_py()) for x in group["ask"]]
    values, where = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
    totals = np.bincount(where, weights=np.concatenate([a[1] for a in asked]), minlength=len(values)).astype(np.int64)
    cuts = np.cumsum([0, *[len(a[0]) for a in asked]])
    told = [pack_arrays(totals[where[a:b]]) for a, b in zip(cuts, cuts[1:], strict=False)]
    stats = [int(totals.sum()), int((totals > 0).sum()), *counts_of_counts(totals).tolist()]
    return _told(group, told, stats, WORDS)


def _told(group: pa.Table, told: list[bytes], stats: list[int], kind: int) -> pa.Table:
    n = len(told)
    return pa.table({
        "block": group["block"], "kind": pa.array([kind] * n, pa.int32()), "part": group["part"], "told": pa.array(told, pa.binary()),
        "stats": pa.array([stats] + [None] * (n - 1), pa.list_(pa.int64()))})


_TOLD = "block long, kind int, part long, told binary, stats array<long>"


def _word_answers(block: Block, parts: int, told: dict[tuple[int, int], bytes]) -> np.ndarray:
    totals = np.zeros(len(block.vocab), np.int64)
    for p, i in WordAsk(block, parts).slices():
        totals[i] = unpack_arrays(told[WORDS, p])[0]
    return totals


def _met(left: pa.Table, right: pa.Table) -> tuple[list[Block], dict[tuple[int, int], bytes]]:
    """A block (twice, if another is just like it) and what it was told."""
    told = {(k, p): x for k, p, x in zip(right["kind"].to_pylist(), right["part"].to_pylist(), right["told"].to_pylist(), strict=True)}
    if bool(told) != bool(left.num_rows):
        raise RuntimeError("the documents' partitions changed between two passes: write the table first")
    return [Block.unpacked(x.as_py()) for x in left["data"]], told


def _pair_rows(parts: int, train_docs: int, words: Unigrams):
    """Pass 2: (part, block, distinct pairs with their counts and the totals of their words)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found, told = _met(left, right)
        rows = []
        for block in found:
            totals = _word_answers(block, parts, told)
            ask = PairAsk(block, parts, totals, train_docs, words.tokens)
            counts = np.bincount(ask.token[block.learnt()], minlength=len(ask.keys))
            for part, pairs, h, wide in ask.slices():
                runs = np.bincount(np.searchsorted(h, ask.h[pairs]), minlength=len(h))
                w, at = np.unique(ask.w[pairs], return_inverse=True)
                rows.append((part, left["block"][0].as_py(), pack_arrays(ask.h_hash[h], runs, block.vocab[w], totals[w], at, counts[pairs], ask.h_hash[wide])))
        return pa.table({k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate((("part", pa.int64()), ("block", pa.int64()), ("ask", pa.binary())))})

    return run


def _pair_totals(words: Unigrams):
    """One partition's pairs: totals, and of contexts that need a backoff weight what it is made of."""
    return lambda group: _pair_group(group, words)


def _pair_group(group: pa.Table, words: Unigrams) -> pa.Table:
    asked = [unpack_arrays(x.as_py()) for x in group["ask"]]
    h = np.concatenate([np.repeat(a[0], a[1]) for a in asked])
    w = np.concatenate([a[2][a[4]] for a in asked])
    keys, first, where = np.unique(mix(h) ^ mix(w + np.uint64(7)) * np.uint64(0xD6E8FEB86659FD93), return_index=True, return_inverse=True)
    totals = np.bincount(where, weights=np.concatenate([a[5] for a in asked]).astype(np.int64), minlength=len(keys)).astype(np.int64)
    p1 = words.p(np.concatenate([a[3][a[4]] for a in asked]).astype(np.int64)[first])
    contexts, of = np.unique(h[first], return_inverse=True)
    seen = totals > 0
    at, n = of[seen], len(contexts)
    parts = [np.bincount(at[totals[seen] == r], minlength=n) for r in range(1, CUTOFF + 1)]
    rest = np.bincount(at, weights=np.where(totals[seen] > CUTOFF, totals[seen], 0), minlength=n).astype(np.int64)
    covered = np.bincount(at, weights=p1[seen], minlength=n)
    plain = sum(parts) == 0  # nothing of these is discounted
    told, a = [], 0
    for hs, runs, _, _, idx, _, wide in asked:
        mine = totals[where[a : a + len(idx)]]
        a += len(idx)
        # hs and wide that this partition doesn't know have no pairs here
        unseen = np.bincount(np.repeat(np.arange(len(hs)), runs), weights=mine == 0, minlength=len(hs)) > 0
        ask = np.concatenate([hs[unseen & ~np.isin(hs, wide)], wide])
        i = np.minimum(np.searchsorted(contexts, ask), max(n - 1, 0))
        known = contexts[i] == ask if n else np.zeros(len(ask), bool)
        i = i[known]
        told.append(pack_arrays(mine, plain[np.searchsorted(contexts, hs)].astype(np.uint8), ask[known], *[x[i] for x in parts], rest[i], covered[i]))
    return _told(group, told, counts_of_counts(totals).tolist(), PAIRS)


# -- evaluation --------------------------------------------------------------------------


def _evaluate(parts: int, train_docs: int, vocabulary: int, words: Unigrams, d: np.ndarray):
    """Pass 3: the scores of a block's documents, each token from the pair down to the unknown word."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found, told = _met(left, right)
        out = []
        for block in found:
            totals = _word_answers(block, parts, told)
            p1 = words.p(totals)
            ask = PairAsk(block, parts, totals, train_docs, words.tokens)
            v = len(block.vocab)
            c = np.zeros(len(ask.keys), np.int64)
            plain = np.zeros(v + 1, bool)
            stats, covered = np.zeros((CUTOFF + 1, v + 1), np.int64), np.zeros(v + 1)
            by_hash = np.argsort(ask.h_hash, kind="stable")
            for part, pairs, h, _ in ask.slices():
                mine, flat, of, *sums, shares = unpack_arrays(told[PAIRS, part])
                c[pairs] = mine
                plain[h] = flat.astype(bool)
                at = by_hash[np.searchsorted(ask.h_hash, of, sorter=by_hash)]
                for r, x in enumerate(sums):
                    stats[r, at] += x.astype(np.int64)
                covered[at] += shares
            c_h = ask.h_total
            wide = ask.split > 1
            plain[wide] = (stats[:CUTOFF].sum(axis=0) == 0)[wide]
            over = np.where(plain, c_h + 1, c_h).astype(float)  # nothing discounted: one more, left to the unseen
            with np.errstate(divide="ignore", invalid="ignore"):
                kept = (sum(d[r] * r * stats[r - 1] for r in range(1, CUTOFF + 1)) + stats[CUTOFF]) / over
                alpha = np.where(c_h > 0, (1 - kept) / (1 - covered), 1.0)
                log_seen = np.log10(c * d[np.minimum(c, CUTOFF) * (c <= CUTOFF)] / over[ask.h])
                log_backed = np.log10(alpha[ask.h]) + np.log10(p1[ask.w])
            log_p = np.where(c > 0, log_seen, log_backed)
            # in wide floats, so that a sum of very many logarithms is as good as one of few; each document has a token
            summed = lambda x, at=starts_of(block.n_tokens): np.add.reduceat(x.astype(np.longdouble), at).astype(float)
            base = np.log10((totals + 1) / (words.tokens + vocabulary + 1))
            out.append(pa.table({
                "doc_id": pa.array(block.doc_id, mask=(block.flags & 4) > 0), "held_out": pa.array((block.flags & 2) > 0), "n_tokens": pa.array(block.n_tokens),
                "n_known": pa.array(summed(totals[block.codes] > 0).astype(np.int64)), "train_tokens": pa.array(np.full(len(block.doc_id), words.tokens)),
                "base_score": pa.array(summed(base[block.codes])), "score": pa.array(summed(log_p[ask.token]))}))
        return pa.concat_tables(out) if out else pa.table({"doc_id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()), **{k: pa.array([], pa.int64()) for k in ("n_tokens", "n_known", "train_tokens")}, **{k: pa.array([], pa.float64()) for k in ("base_score", "score")}})

    return run


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        yield pa.RecordBatch.from_arrays([pa.array([block.name()], pa.int64()), pa.array([block.packed()], pa.binary())], names=["block", "data"])


def _stats(told: DataFrame, size: int) -> list[int]:
    sums = told.where("stats IS NOT NULL").agg(*[F.sum(F.get("stats", F.lit(i))) for i in range(size)]).first()
    return [int(x or 0) for x in sums]


def score(docs: DataFrame, learn: str = "learn", held_out: str = "held_out") -> DataFrame:
    """SCORES for rows (doc_id, text, learn, held_out)."""
    flags = F.col(learn).cast("int") + 2 * F.col(held_out).cast("int") + 4 * F.col("doc_id").isNull().cast("int")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), flags.cast("byte").alias("flags"), F.col("text").cast("string").alias("text"))
    size, train_docs = docs.agg(F.sum(F.octet_length("text")), F.count_if(learn)).first()
    parts = max(1, -(-(size or 0) // BYTES_PER_PART))

    asked = d.mapInArrow(_word_rows(parts), "part long, block long, ask binary")
    word_told = written(asked.groupBy("part").applyInArrow(_word_totals, _TOLD), "katz-words")
    tokens, vocabulary, *n = _stats(word_told, CUTOFF + 3)
    words = Unigrams(tokens, n)

    rows = d.mapInArrow(_block_rows, "block long, data binary").groupBy("block")
    tell = lambda t: t.select("block", "kind", "part", "told").groupBy("block")
    asked = rows.cogroup(tell(word_told)).applyInArrow(_pair_rows(parts, train_docs, words), "part long, block long, ask binary")
    pair_told = written(asked.groupBy("part").applyInArrow(_pair_totals(words), _TOLD), "katz-pairs")
    d2 = discounts(_stats(pair_told, CUTOFF + 1))

    return rows.cogroup(tell(word_told.unionByName(pair_told))).applyInArrow(_evaluate(parts, train_docs, vocabulary, words, d2), SCORES)


def scored(docs: DataFrame) -> DataFrame:
    """op2: learn from the training folds, score every document."""
    fold = F.pmod(crc32_of_id(F.col("doc_id")), F.lit(FOLDS))
    d = docs.select("doc_id", "text")
    return score(d.withColumns({"learn": F.coalesce(fold != HELD_OUT, F.lit(False)), "held_out": F.coalesce(fold == HELD_OUT, F.lit(False))}))


#: A blank stands for the end mark and an empty word for the start mark; no word is like them.
SCORED_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {CRC32_OF_ID} % {FOLDS} AS fold,
    list_append(regexp_extract_all({LOWERED}, '{WORD}'), ' ') AS w FROM documents),
t AS (SELECT r, coalesce(fold <> {HELD_OUT}, false) AS learn, unnest(list_prepend('', w[1:len(w) - 1])) AS h, unnest(w) AS w FROM d),
words AS (SELECT w, count(*) AS c FROM t WHERE learn GROUP BY w),
pairs AS (SELECT h, w, count(*) AS c FROM t WHERE learn GROUP BY h, w),
contexts AS (SELECT h, count(*) AS c FROM t WHERE learn GROUP BY h),
size AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM words),
-- how many counts are 1 to 6, of words (1) and of pairs (2), and what a count is multiplied by
few AS (SELECT o, [count(*) FILTER (c = 1), count(*) FILTER (c = 2), count(*) FILTER (c = 3), count(*) FILTER (c = 4), count(*) FILTER (c = 5), count(*) FILTER (c = 6)] AS n
    FROM (SELECT 1 AS o, c FROM words UNION ALL SELECT 2, c FROM pairs) GROUP BY o),
turing AS (SELECT o, k, n[k] AS of_k, CASE WHEN n[1] > 0 AND n[2] > 0 THEN n[1] / (n[1] + 2 * n[2]) ELSE 0.5 END AS absolute,
    CASE WHEN n[1] > 0 THEN 6 * n[6] / n[1] ELSE 1.0 END AS common, CASE WHEN n[k] > 0 THEN (k + 1) * n[k + 1] / (k * n[k]) END AS ratio FROM few, range(1, 6) x(k)),
kept AS (SELECT o, k, of_k, CASE WHEN common < 1 AND (ratio - common) / (1 - common) > 0 AND (ratio - common) / (1 - common) < 1 THEN (ratio - common) / (1 - common) ELSE 1 - absolute / k END AS d FROM turing),
free AS (SELECT coalesce(sum((1 - d) * k * of_k), 0) AS free FROM kept WHERE o = 1),
over AS (SELECT CASE WHEN free > 0 THEN n ELSE n + 1 END AS over, CASE WHEN free > 0 THEN free ELSE 1.0 END / CASE WHEN free > 0 THEN n ELSE n + 1 END AS unknown FROM size, free),
one AS (SELECT w, c, c * coalesce(d, 1.0) / over AS p FROM words CROSS JOIN over LEFT JOIN kept ON o = 1 AND k = c),
seen AS (SELECT h, pairs.w, pairs.c, pairs.c * coalesce(d, 1.0) AS left_of, k IS NOT NULL AS few, p FROM pairs JOIN one ON one.w = pairs.w LEFT JOIN kept ON o = 2 AND k = pairs.c),
-- a context of which nothing is discounted gives one more to the unseen
context AS (SELECT h, contexts.c + CASE WHEN bool_or(few) THEN 0 ELSE 1 END AS over, fsum(left_of) AS left_of, fsum(p) AS covered FROM seen JOIN contexts USING (h) GROUP BY h, contexts.c),
scores AS (SELECT r, count(*) AS n_tokens, count(one.c) AS n_known, fsum(log10((coalesce(one.c, 0) + 1) / (n * 1.0::DOUBLE + v + 1))) AS base_score,
    fsum(CASE WHEN seen.c IS NOT NULL THEN log10(seen.left_of / context.over)
        ELSE log10(coalesce((1 - context.left_of / context.over) / (1 - covered), 1.0)) + log10(coalesce(one.p, unknown)) END) AS score
    FROM t CROSS JOIN size CROSS JOIN over LEFT JOIN one ON one.w = t.w LEFT JOIN context ON context.h = t.h LEFT JOIN seen ON seen.h = t.h AND seen.w = t.w GROUP BY r)
SELECT doc_id, coalesce(fold = {HELD_OUT}, false) AS held_out, n_tokens, n_known, n AS train_tokens, base_score, score FROM d JOIN scores USING (r) CROSS JOIN size"""
