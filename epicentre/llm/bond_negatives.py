"""Hard negatives by a vertical branch-and-bound scan of decomposed vectors (BOND).

A block of vectors is held by dimension.  For one anchor the dimensions are read in the order
of its components' descending magnitude; after each few of them, every candidate's score lies
between its partial sum plus the least and plus the greatest that the unread dimensions can
still add (from the block's minimum and maximum of each dimension).  Candidates whose interval
can't matter any more leave the bitmap, and their columns are read no further.

1. Positives: among the rows of the anchor's label, a candidate leaves when ``k`` others are
   certainly better.  Rows of a label stand in blocks of bounded size, so a hot label is many
   tasks.
2. Negatives: each positive opens a window of scores, from ``LOW_PERCENT`` of its score up to
   it.  A candidate leaves when its interval misses every window, or ``k`` others that are
   certainly inside a window are certainly better there.  All rows stand in blocks, each
   anchor block meets each of them, and the best of all blocks are merged exactly.

Components are ``floor(256 * x)``; sums are exact 64-bit integers (they must fit).  Vectors
that are null, or hold a null or non-finite component, and rows with a null label or id take
no part.  Where rows share an id, the least (vector, label) counts.  Vectors of different
lengths aren't compared.  Ties of score go to the smaller id.  Groups of equal vectors are
ordinary candidates.  An anchor without positives, and an empty table, give no rows.  Texts
don't occur.  Only the named columns are read, so further ones can't clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epicentre.llm.common import written

#: Fixed by the contract.
SCALE, TOP, ANCHOR_EVERY, SHIFT_EVERY, LABELS, LOW_PERCENT = 256, 5, 100, 7, 10, 80
#: Vectors and anchors in a block (expected numbers).
ROW_BLOCK, ANCHOR_BLOCK = 4096, 1024
#: Dimensions read between two looks at the bitmap.
STEP = 8

_POSITIVES = "anchor_id long, positive_id long, score long"
_NEGATIVES = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def quantised(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, dim, vec (array<bigint>): one row per id that takes part."""
    finite = lambda v: F.coalesce(~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")), F.lit(False))
    d = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("x"))
    d = d.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite))
    one = d.groupBy("vec_id").agg(F.min(F.struct(F.transform("x", lambda v: F.floor(v.cast("double") * SCALE)).alias("vec"), "label")).alias("r"))
    return one.select("vec_id", F.col("r.label").alias("label"), F.size("r.vec").alias("dim"), F.col("r.vec").alias("vec"))


def _by_dimension(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    """One contiguous line for each dimension."""
    flat = pa.concat_arrays(column.chunks).flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(rows, -1).T)


class _Block:
    """Vectors by dimension, their ids and labels, and each dimension's range."""

    def __init__(self, rows: pa.Table):
        self.lines = _by_dimension(rows["vec"], rows.num_rows)
        self.ids = rows["vec_id"].to_numpy()
        self.labels = rows["label"].to_numpy()
        self.low, self.high = self.lines.min(axis=1, initial=1 << 62), self.lines.max(axis=1, initial=-(1 << 62))

    def scan(self, anchor: np.ndarray, alive: np.ndarray, sift) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and exact scores of the candidates that are left, and the components that were read.

        ``alive`` are the places to begin with; ``sift(partial, least, most)`` gives the mask of those
        that still matter, when the unread dimensions add between ``least`` and ``most``.
        """
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack((anchor * self.low, anchor * self.high))
        least, most = (np.cumsum(e[order][::-1])[::-1] for e in (ends.min(axis=0), ends.max(axis=0)))
        partial, read = np.zeros(len(alive), np.int64), 0
        for a in range(0, len(order), STEP):
            dims = order[a : a + STEP]
            lines = self.lines[dims] if len(alive) == len(self.ids) else self.lines[np.ix_(dims, alive)]
            partial = partial + anchor[dims] @ lines
            read += lines.size
            if a + STEP < len(order) and len(alive):
                keep = sift(partial, least[a + STEP], most[a + STEP])
                if not keep.all():
                    alive, partial = alive[keep], partial[keep]
        return alive, partial, read


def _kth(values: np.ndarray, k: int) -> int | None:
    """The k-th greatest; None if there are fewer."""
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else None


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties by the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def positives_of(block: _Block, anchor: np.ndarray, anchor_id: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores of the anchor's k best other rows of the block, and the components that were read."""

    def sift(partial, least, most):
        floor = _kth(partial, k)
        return np.ones(len(partial), bool) if floor is None else partial + most >= floor + least

    alive, scores, read = block.scan(anchor, np.flatnonzero(block.ids != anchor_id), sift)
    best = _first(scores, block.ids[alive], k)
    return block.ids[alive][best], scores[best], read


def negatives_of(block: _Block, anchor: np.ndarray, label: int, windows: list[int], k: int, percent: int = LOW_PERCENT) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """For each window (a positive's score) ids and scores of its k best rows of another label."""
    bottoms = [-(-percent * int(top) // 100) for top in windows]  # rounded up

    def sift(partial, least, most):
        low, high = partial + least, partial + most
        keep = np.zeros(len(partial), bool)
        for bottom, top in zip(bottoms, windows, strict=True):
            fits = (high >= bottom) & (low <= top)
            inside = low[(low >= bottom) & (high <= top)]
            floor = _kth(inside, k)
            keep |= fits if floor is None else fits & (high >= floor)
        return keep

    alive, scores, read = block.scan(anchor, np.flatnonzero(block.labels != label), sift)
    ids, found = block.ids[alive], []
    for bottom, top in zip(bottoms, windows, strict=True):
        at = np.flatnonzero((scores >= bottom) & (scores <= top))
        best = at[_first(scores[at], ids[at], k)]
        found.append((ids[best], scores[best]))
    return found, read


def _positive_pairs(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if rows.num_rows and anchors.num_rows:
            block = _Block(rows)
            vectors = _by_dimension(anchors["vec"], anchors.num_rows).T
            for name, vector in zip(anchors["vec_id"].to_numpy(), vectors, strict=True):
                ids, scores, _ = positives_of(block, vector, name, k)
                for part, new in zip(out, (np.full(len(ids), name), ids, scores), strict=True):
                    part.append(new)
        return _as_table(out, ("anchor_id", "positive_id", "score"))

    return run


def _negative_pairs(k: int, percent: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: tuple[list, ...] = ([], [], [], [], [])
        if rows.num_rows and anchors.num_rows:
            block = _Block(rows)
            vectors = _by_dimension(anchors["vec"], anchors.num_rows).T
            facts = zip(anchors["vec_id"].to_numpy(), anchors["label"].to_numpy(), vectors, anchors["positives"].to_pylist(), strict=True)
            for name, label, vector, positives in facts:
                found, _ = negatives_of(block, vector, label, [p["score"] for p in positives], k, percent)
                for p, (ids, scores) in zip(positives, found, strict=True):
                    n = len(ids)
                    for part, new in zip(out, (np.full(n, name), np.full(n, p["positive_id"]), np.full(n, p["score"]), ids, scores), strict=True):
                        part.append(new)
        return _as_table(out, ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"))

    return run


def _as_table(parts: tuple[list, ...], names: tuple[str, ...]) -> pa.Table:
    return pa.table({n: np.concatenate(p).astype(np.int64) if p else np.zeros(0, np.int64) for n, p in zip(names, parts, strict=True)})


def _best(d: DataFrame, by: list[str], score: str, ident: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(ident))
    return d.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(n, size: int):
    return F.greatest(F.lit(1), F.ceil(n / size)).cast("int")


def _every(n):
    return F.explode(F.sequence(F.lit(0), n - 1))


def mine(vectors: DataFrame, anchors: DataFrame, k: int = TOP, percent: int = LOW_PERCENT, row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` as ``quantised`` gives them; ``anchors`` has the vec_id of some of them.
    """
    base = written(vectors, "bond-vectors")
    asked = written(base.join(anchors.select("vec_id").distinct(), "vec_id", "left_semi"), "bond-anchors")
    place = lambda n: F.pmod(F.xxhash64("vec_id"), n).cast("int")

    # positives: a label's rows against its anchors, each side in blocks
    kind = ["dim", "label"]
    rows_of = base.groupBy(*kind).agg(_blocks(F.count("*"), row_block).alias("row_blocks"))
    sizes = rows_of.join(asked.groupBy(*kind).agg(_blocks(F.count("*"), anchor_block).alias("anchor_blocks")), kind)
    keys = [*kind, "r", "q"]
    rows = base.join(sizes, kind).withColumn("r", place(F.col("row_blocks"))).withColumn("q", _every(F.col("anchor_blocks")))
    asking = asked.join(sizes, kind).withColumn("q", place(F.col("anchor_blocks"))).withColumn("r", _every(F.col("row_blocks")))
    found = rows.select(*keys, "vec_id", "vec").groupBy(*keys).cogroup(asking.select(*keys, "vec_id", "vec").groupBy(*keys)).applyInArrow(_positive_pairs(k), _POSITIVES)
    positives = _best(found, ["anchor_id"], "score", "positive_id", k)
    per_anchor = positives.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "score"))).alias("positives"))
    wanted = written(asked.join(per_anchor, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"), "bond-positives")

    # negatives: all rows against all anchors, in blocks
    n_rows, n_anchors = F.lit(-(-base.count() // row_block) or 1), F.lit(-(-wanted.count() // anchor_block) or 1)
    keys = ["dim", "r", "q"]
    rows = base.withColumn("r", place(n_rows)).withColumn("q", _every(n_anchors))
    asking = wanted.withColumn("q", place(n_anchors)).withColumn("r", _every(n_rows))
    found = rows.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(_negative_pairs(k, percent), _NEGATIVES)
    best = _best(found, ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", k)
    return best.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """op13: anchors are the rows whose id is divisible by 100; labels are changed as the contract says."""
    label = F.when(F.col("vec_id") % SHIFT_EVERY == 0, (F.col("label").cast("long") + 1) % LABELS).otherwise(F.col("label").cast("long"))
    d = quantised(embeddings.select("vec_id", "embedding", label.alias("label")))
    return mine(d, d.where(F.col("vec_id") % ANCHOR_EVERY == 0).select("vec_id"))


HARD_NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.vec, c.vec)::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
QUALIFY rank <= 5
"""
