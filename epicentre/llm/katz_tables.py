"""Katz backoff models of any order, stored as tables that score any documents.

``fit`` counts the n-grams of the training texts and writes three tables under one path, the
first two partitioned by order:

  grams     order, h (context), low (the context without its first word), w, c, p: the discounted
            probability of w after h
  contexts  order, h, c, alpha: the backoff weight
  orders    order, entries, tokens, discounts, unknown: one row for each order

``score`` evaluates recursively: a token that the table of the highest order has takes its
probability there; else the weight of its context counts and the next lower order is asked, down
to single words and the unknown word.  The probabilities after any context sum to exactly one
over the known words and one unknown word, since a weight is what the discounts leave of its
context, divided by what the lower order leaves to words not seen there.

Words, marks, discounts and the treatment of contexts in which nothing is discounted are those of
``katz``, which is the same model of order 2 for texts that are learnt from and scored at once:
there, blocks of text ask for their entries once for both.  Here tables are joined, so learning
and scoring are apart and any order goes, at the cost of shuffling each text's entries.

Scale.  Tasks count n-grams slice by slice before anything is shuffled.  Contexts that hold many
rows only ever meet one row of theirs in a join, so their rows can be split at run time (AQE).
Each level is written, which cuts the lineage.

Null and empty texts have the end mark only; very long texts are counted whole, in a slice of
their own.  Rows that share an id are scored apart; equal rows count as often as they stand
there.  With nothing to learn from, all tokens are unknown and have probability 1.  An empty
table gives an empty result; columns but doc_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epicentre.llm.common import coded_words, mix, slices, starts_of, string_hashes, written
from epicentre.llm.katz import CUTOFF, END, START, Unigrams, discounts
from epicentre.session import scratch_path

COUNTED = "order int, h long, low long, w long, c long"
STORED = {"grams": "h long, low long, w long, c long, p double", "contexts": "h long, c long, alpha double"}
ENTRIES = "row long, doc_id long, hs array<long>, w long, n long"


def _tokens(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, the end mark behind each text, and the tokens of each text."""
    codes, distinct, counts = coded_words(text, lower=True)
    return np.insert(string_hashes(distinct)[codes], np.cumsum(counts), END), counts + 1


def _contexts(tokens: np.ndarray, counts: np.ndarray, order: int) -> list[np.ndarray]:
    """For k = 1 .. order, the hash of the k - 1 tokens before each; start marks stand before a text."""
    place = np.arange(len(tokens)) - np.repeat(starts_of(counts), counts)
    out = [np.zeros(len(tokens), np.uint64)]
    for k in range(1, order):
        before = np.where(place >= k, np.roll(tokens, k), START)
        out.append(mix(out[-1] * np.uint64(0xD6E8FEB86659FD93) + before))
    return out


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first row of each distinct combination of the keys, and how many rows have it."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order)))


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            tokens, counts = _tokens(part.column("text"))
            low = np.zeros(len(tokens), np.uint64)
            for k, h in enumerate(_contexts(tokens, counts, order), 1):
                at, c = _runs(tokens, h)
                columns = [np.full(len(at), k, np.int32), *[x[at].view(np.int64) for x in (h, low, tokens)], c.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["order", "h", "low", "w", "c"])
                low = h

    return run


def _entries(order: int):
    """Per text its distinct tokens with their contexts of all orders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            tokens, counts = _tokens(part.column("text"))
            contexts = _contexts(tokens, counts, order)
            row = np.repeat(np.arange(part.num_rows), counts)
            at, n = _runs(tokens, contexts[-1], row)  # the longest context has all shorter ones in it
            hs = np.stack([h[at].view(np.int64) for h in contexts], axis=1).reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * order, pa.int32()), pa.array(hs))
            yield pa.RecordBatch.from_arrays(
                [part.column("row").take(pa.array(row[at])), part.column("doc_id").take(pa.array(row[at])), lists, pa.array(tokens[at].view(np.int64)), pa.array(n.astype(np.int64))],
                names=["row", "doc_id", "hs", "w", "n"])

    return run


def _discounted(c: Column, d: list[float]) -> Column:
    return c * F.when(c <= CUTOFF, F.get(F.array(*[F.lit(float(x)) for x in d]), c.cast("int"))).otherwise(F.lit(1.0))


def _stored(spark: SparkSession, path: str, name: str, order: int) -> DataFrame:
    return spark.read.schema(STORED[name]).parquet(f"{path}/{name}/order={order}")


class Model:
    """A stored model: ``Model(spark, path)`` opens what ``fit`` has written."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.orders = spark.read.parquet(f"{path}/orders")
        rows = {r.order: r for r in self.orders.collect()}  # one for each order
        self.order, self.unknown = max(rows), rows[1].unknown

    def grams(self, order: int) -> DataFrame:
        return _stored(self.spark, self.path, "grams", order)

    def contexts(self, order: int) -> DataFrame:
        return _stored(self.spark, self.path, "contexts", order)


def fit(docs: DataFrame, order: int = 3, path: str | None = None) -> Model:
    """Learn from the texts of ``docs`` and store the model under ``path`` (which must be free)."""
    if order < 1:
        raise ValueError("a model has an order of at least 1")
    spark = docs.sparkSession
    path = path or scratch_path(spark, "llm-katz-model")
    texts = docs.select(F.col("text").cast("string").alias("text"))
    counts = texts.mapInArrow(_count(order), COUNTED).groupBy("order", "h", "low", "w").agg(F.sum("c").alias("c"))
    counts = written(counts, "katz-counts", partition_by=["order"])
    few = [F.count_if(F.col("c") == r).alias(f"n{r}") for r in range(1, CUTOFF + 2)]
    sizes = {r.order: r for r in counts.groupBy("order").agg(F.count("*").alias("entries"), F.sum("c").alias("tokens"), *few).collect()}
    info = []
    for k in range(1, order + 1):
        n = [int(sizes[k][f"n{r}"]) if k in sizes else 0 for r in range(1, CUTOFF + 2)]
        entries, tokens = (int(sizes[k].entries), int(sizes[k].tokens)) if k in sizes else (0, 0)
        d = discounts(n).tolist()
        left = _discounted(F.col("c"), d)
        grams = counts.where(F.col("order") == k).drop("order")
        unknown = None
        if k == 1:
            words = Unigrams(tokens, n)
            unknown = float(words.unknown)
            grams = grams.withColumn("p", left / F.lit(float(words.over)))
        else:
            lower = _stored(spark, path, "grams", k - 1)
            lower = lower.select(F.col("h").alias("l_h"), F.col("w").alias("l_w"), F.col("p").alias("l_p"))
            # what was seen after a context was seen after the shorter one too
            known = written(grams.join(lower, (F.col("low") == F.col("l_h")) & (F.col("w") == F.col("l_w"))).select("h", "low", "w", "c", "l_p"), f"katz-known{k}")
            per = known.groupBy("h").agg(F.sum("c").alias("c"), F.sum(left).alias("left"), F.sum("l_p").alias("covered"), F.bool_or(F.col("c") <= CUTOFF).alias("few"))
            # where nothing is discounted, one is added and left to the unseen
            per = per.withColumn("over", F.col("c") + F.when(F.col("few"), 0).otherwise(1))
            per = written(per.select("h", "c", "over", ((1 - F.col("left") / F.col("over")) / (1 - F.col("covered"))).alias("alpha")), f"katz-contexts{k}")
            per.select("h", "c", "alpha").write.parquet(f"{path}/contexts/order={k}")
            grams = known.join(per.select(F.col("h").alias("c_h"), "over"), F.col("h") == F.col("c_h")).select("h", "low", "w", "c", (left / F.col("over")).alias("p"))
        grams.select("h", "low", "w", "c", "p").write.parquet(f"{path}/grams/order={k}")
        info.append((k, entries, tokens, d, unknown))
    spark.createDataFrame(info, "order int, entries long, tokens long, discounts array<double>, unknown double").coalesce(1).write.parquet(f"{path}/orders")
    return Model(spark, path)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_backed_off (tokens that a lower order gave), n_unknown, score (log10) of each row."""
    d = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    todo = written(d.mapInArrow(_entries(model.order), ENTRIES), "katz-entries").withColumn("log", F.lit(0.0))
    own, done = ["row", "doc_id", "n", "log"], []
    for k in range(model.order, 0, -1):
        grams = model.grams(k).select(F.col("h").alias("g_h"), F.col("w").alias("g_w"), "p")
        met = todo.join(grams, (F.get("hs", F.lit(k - 1)) == F.col("g_h")) & (F.col("w") == F.col("g_w")), "left").drop("g_h", "g_w")
        if k == 1:
            log = F.col("log") + F.log10(F.coalesce("p", F.lit(model.unknown)))
            done.append(met.select(*own[:3], log.alias("log"), F.lit(k).alias("order"), F.col("p").isNull().alias("unknown")))
            break
        met = written(met, f"katz-met{k}")
        done.append(met.where("p IS NOT NULL").select(*own[:3], (F.col("log") + F.log10("p")).alias("log"), F.lit(k).alias("order"), F.lit(False).alias("unknown")))
        weights = model.contexts(k).select(F.col("h").alias("c_h"), "alpha")
        todo = met.where("p IS NULL").drop("p").join(weights, F.get("hs", F.lit(k - 1)) == F.col("c_h"), "left")
        todo = todo.select("row", "doc_id", "hs", "w", "n", (F.col("log") + F.coalesce(F.log10("alpha"), F.lit(0.0))).alias("log"))
    every = done[0]
    for x in done[1:]:
        every = every.unionByName(x)
    lower = F.when(F.col("order") < model.order, F.col("n")).otherwise(0)
    return every.groupBy("row", "doc_id").agg(
        F.sum("n").alias("n_tokens"), F.sum(lower).alias("n_backed_off"), F.sum(F.when(F.col("unknown"), F.col("n")).otherwise(0)).alias("n_unknown"), F.sum(F.col("n") * F.col("log")).alias("score")).drop("row")
