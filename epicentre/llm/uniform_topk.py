"""Exact top-k search by inner product with a uniform threshold, in three phases.

The dimensions are dealt into ``lists`` ranges; a vector's score is the sum of its entries in
these lists.  Each list stands in tasks of its own: one holds its range of a block of vectors, in
the order of their lengths there, and meets a block of queries.

1. Gather: every list gives each query's k best entries.  It reads its vectors by descending
   length and stops where length times the query's length can't reach the k-th best so far.
   The scores of just these vectors are computed, and the k-th best of them is a safe cutoff:
   the answer holds nothing below it.
2. Broadcast the cutoff with the queries.  A vector that reaches it must have an entry of at
   least cutoff / lists in some list, so the entries at or above that uniform threshold are
   sufficient.  Vectors too short in the list for it, or too short elsewhere to make up for the
   rest of the cutoff, aren't sent; of the former no entry is computed.
3. Resolve the scores of just the vectors that were sent, and take the k best.

Equal vectors are one candidate with its smallest ids, and one query; they are put back at
the end, so large groups of copies cost no more than one vector.  Components are
``floor(256 * x)``; sums are exact (64-bit integers).

Very long vectors are dealt out like others.  Vectors that are null, or hold a null or non-finite component, take no part.  Vectors of
different lengths aren't compared.  Rows with a null id take no part; where rows share an id,
the least vector counts.  Ties go to the smaller id.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epicentre.llm.common import written

#: Fixed by the contract.
SCALE, TOP, QUERY_EVERY = 256, 5, 50
LISTS = 2
#: Vectors and queries in a block (expected numbers).
ROW_BLOCK, QUERY_BLOCK = 4096, 2048

_FOUND = "query long, vector long, entry long"
#: Rows of a list that are read between two looks at the bounds.
STEP = 512


def quantised(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, vec (array<bigint>): one row per id that takes part."""
    x = F.col(vector)
    finite = lambda v: F.coalesce(~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")), F.lit(False))
    d = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x")).where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
    d = d.where(F.forall("x", finite))
    return d.groupBy("vec_id").agg(F.min(F.transform("x", lambda v: F.floor(v.cast("double") * SCALE))).alias("vec"))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return pa.concat_arrays(column.chunks).flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties by the smaller id."""
    if len(score) > k:
        floor = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= floor)
    else:
        near = np.arange(len(score))
    return near[np.lexsort((ids[near], -score[near]))][:k]


class _List:
    """One range of a block's dimensions, longest vectors first; floats where these are exact, as they are faster."""

    def __init__(self, rows: pa.Table, queries: pa.Table):
        x, q = _matrix(rows["part"], rows.num_rows), _matrix(queries["part"], queries.num_rows)
        most = (np.abs(q).max(initial=0) + 1.0) * (np.abs(x).max(initial=0) + 1.0) * max(x.shape[1], 1)
        kind = np.float64 if most < 2.0**52 else np.int64
        lengths = np.sqrt(np.square(x.astype(np.float64)).sum(axis=1))
        order = np.argsort(-lengths, kind="stable")
        self.x, self.q = x[order].astype(kind), q.astype(kind)
        self.ids, self.lengths, self.rest = rows["gid"].to_numpy()[order], lengths[order], rows["rest"].to_numpy()[order]
        self.names, self.q_lengths, self.q_rest = queries["gid"].to_numpy(), np.sqrt(np.square(q.astype(np.float64)).sum(axis=1)), queries["rest"].to_numpy()
        self.computed = 0

    def _reach(self, queries: np.ndarray, at: int) -> np.ndarray:
        """What no entry from row ``at`` on exceeds, for each query."""
        return self.q_lengths[queries] * self.lengths[at] * (1 + 1e-9) + 1e-6

    def entries(self, queries: np.ndarray, a: int) -> np.ndarray:
        part = self.x[a : a + STEP]
        self.computed += len(queries) * len(part)
        return self.q[queries] @ part.T

    def best(self, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(query, ids, entries): each query's k best entries."""
        n = len(self.names)
        held, ids = np.full((n, k), -np.inf), np.zeros((n, k), np.int64)
        exact = np.zeros((n, k), np.int64)
        open_ = np.arange(n)
        for a in range(0, len(self.ids), STEP):
            open_ = open_[self._reach(open_, a) >= held[open_, -1]]
            if not len(open_):
                break
            new = self.entries(open_, a)
            for row, i in enumerate(open_):
                all_ = np.concatenate((exact[i][held[i] > -np.inf], new[row].astype(np.int64)))
                names = np.concatenate((ids[i][held[i] > -np.inf], self.ids[a : a + STEP]))
                top = _best(all_, names, k)
                held[i, : len(top)], exact[i, : len(top)], ids[i, : len(top)] = all_[top], all_[top], names[top]
        return [(int(self.names[i]), ids[i][held[i] > -np.inf], exact[i][held[i] > -np.inf]) for i in range(n)]

    def sufficient(self, cutoffs: np.ndarray, lists: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(query, ids, entries): the entries at cutoff / lists or above whose vectors may reach the cutoff."""
        out, open_ = [], np.arange(len(self.names))
        for a in range(0, len(self.ids), STEP):
            open_ = open_[self._reach(open_, a) * lists >= cutoffs[open_]]
            if not len(open_):
                break
            new = self.entries(open_, a)
            ids, rest = self.ids[a : a + STEP], self.rest[a : a + STEP]
            for row, i in enumerate(open_):
                elsewhere = self.q_rest[i] * rest * (1 + 1e-9) + 1e-6
                elsewhere = elsewhere + np.abs(new[row]) * 1e-9
                keep = (new[row] >= -(-int(cutoffs[i]) // lists)) & (new[row] + elsewhere >= cutoffs[i])
                if keep.any():
                    out.append((int(self.names[i]), ids[keep], new[row][keep].astype(np.int64)))
        return out


def _scan(k: int, lists: int, cutoff: bool):
    """For a list's block of rows and one of queries: phase 1, or phase 2 if the queries carry a cutoff."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and queries.num_rows:
            one = _List(rows, queries)
            found = one.sufficient(queries["cutoff"].to_numpy(), lists) if cutoff else one.best(k)
        parts = [np.full(len(ids), name) for name, ids, _ in found], [ids for _, ids, _ in found], [e for _, _, e in found]
        columns = [np.concatenate(p).astype(np.int64) if p else np.zeros(0, np.int64) for p in parts]
        return pa.table(dict(zip(("query", "vector", "entry"), columns, strict=True)))

    return run


def _first(d: DataFrame, by: str, order: list, k: int, name: str = "rank") -> DataFrame:
    return d.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col(name) <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int = TOP, lists: int = LISTS, row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best of all vectors but its own.

    ``vectors`` has vec_id and vec; ``queries`` the vec_id of some of them.
    """
    more = k + 1  # a query's own row is among its best and falls out at the end
    base = written(vectors, "topk-vectors")
    first = _first(base, "vec", [F.col("vec_id")], more)
    groups = written(first.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("gid", F.get("ids", 0)).withColumn("dim", F.size("vec")), "topk-groups")
    asked = written(queries.select("vec_id").join(base, "vec_id").join(groups.select("vec", "gid"), "vec").select(F.col("vec_id").alias("query_id"), "gid"), "topk-queries")
    wanted = written(groups.join(asked.select("gid").distinct(), "gid", "left_semi").select("gid", "vec", "dim"), "topk-query-vectors")
    n_rows, n_queries = -(-groups.count() // row_block) or 1, -(-wanted.count() // query_block) or 1

    def in_lists(d: DataFrame) -> DataFrame:
        """Each vector's range of each list, and its length in the other dimensions."""
        length = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")))
        cut = lambda i: F.floor(F.col("dim") * i / F.lit(lists)).cast("int")
        part = lambda i: F.slice("vec", cut(F.lit(i)) + 1, cut(F.lit(i + 1)) - cut(F.lit(i)))
        rest = lambda i: F.concat(F.slice("vec", 1, cut(F.lit(i))), F.slice("vec", cut(F.lit(i + 1)) + 1, F.size("vec")))
        ranges = F.array(*[F.struct(F.lit(i).alias("l"), part(i).alias("part"), length(rest(i)).alias("rest")) for i in range(lists)])
        return d.withColumn("__list", F.explode(ranges)).select(*[c for c in d.columns if c != "vec"], "__list.*")

    def scanned(q: DataFrame, cutoff: bool) -> DataFrame:
        block = lambda n: F.pmod(F.xxhash64("gid"), F.lit(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        keys = ["dim", "l", "r", "q"]
        left = in_lists(groups.select("dim", "gid", "vec")).withColumn("r", block(n_rows)).withColumn("q", every(n_queries)).groupBy(*keys)
        right = in_lists(q).withColumn("q", block(n_queries)).withColumn("r", every(n_rows)).groupBy(*keys)
        return left.cogroup(right).applyInArrow(_scan(more, lists, cutoff), _FOUND)

    def resolved(pairs: DataFrame) -> DataFrame:
        """query, vector, score of these pairs alone."""
        product = F.aggregate(F.zip_with("qv", "xv", lambda a, b: a * b), F.lit(0).cast("bigint"), lambda t, v: t + v)
        d = pairs.select("query", "vector").distinct()
        d = d.join(wanted.select(F.col("gid").alias("query"), F.col("vec").alias("qv")), "query").join(groups.select(F.col("gid").alias("vector"), F.col("vec").alias("xv")), "vector")
        return d.select("query", "vector", product.alias("score"))

    order = [F.col("score").desc(), F.col("vector")]
    seen = _first(resolved(scanned(wanted, False)), "query", order, more)
    # with fewer than k rows in all there is no cutoff: everything is sufficient
    cutoffs = seen.groupBy("query").agg(F.min("score").alias("s"), F.count("*").alias("n")).select(
        F.col("query").alias("gid"), F.when(F.col("n") < more, F.lit(-(1 << 62))).otherwise(F.col("s")).alias("cutoff"))
    cutoffs = written(cutoffs, "topk-cutoffs")
    best = written(_first(resolved(scanned(wanted.join(cutoffs, "gid"), True)), "query", order, more).drop("rank"), "topk-groups-found")

    listed = best.join(groups.select(F.col("gid").alias("vector"), "ids"), "vector").select("query", "score", F.explode("ids").alias("vec_id"))
    listed = _first(listed, "query", [F.col("score").desc(), F.col("vec_id")], more).drop("rank")
    out = asked.join(listed, F.col("gid") == F.col("query")).where(F.col("query_id") != F.col("vec_id"))
    return _first(out, "query_id", [F.col("score").desc(), F.col("vec_id")], k).select("query_id", "rank", "vec_id", "score")


def top_scores(embeddings: DataFrame) -> DataFrame:
    """op7: the five best of all other rows for every row whose id is divisible by 50."""
    d = quantised(embeddings)
    return search(d, d.where(F.col("vec_id") % QUERY_EVERY == 0).select("vec_id"))


TOP_SCORES_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vec, c.vec)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
