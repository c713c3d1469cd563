"""Sharding by sampled splitters (DataFrame functions only): shards of near equal bytes.

Records are ordered by a key (the hash of the text, so that equal texts stand together),
then by a hash of the id.  A size-weighted sample of keys gives quantile splitters; these cut
the key space into many more ranges than there are shards.  A range that turns out overfull,
as when one text has very many copies, is subdivided by the hash of the id.  Exact bytes and
rows of the cells so made tell where each shard begins; inside a cell a running sum places
each record.  So shards differ by no more than about one record, no task handles more than a
cell, and equal texts share a shard unless a boundary runs through them.

A null text has no bytes; its size is that of an empty one.  Very long texts are measured and
hashed whole.  Equal texts stand in the order of a hash of their ids, equal ids in any order.
Repeated rows each get their own slot.  An empty table gives an empty result.  All input
columns are carried along; the results stand in one struct column, whose name gets underscores
after it if the input has such a column.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epicentre.llm.common import free_name, written

SHARDS = 24
#: Ranges for each shard, and for each so many bytes; and the most splitters there are.  With more
#: data ranges are subdivided as overfull ones are, into cells of BYTES_PER_RANGE at any size; the
#: driver gets the splitters and one line for each cell.
RANGES_PER_SHARD, BYTES_PER_RANGE, MAX_RANGES = 16, 1 << 30, 20_000
#: Expected sampled keys for each range.
SAMPLES_PER_RANGE = 12
#: A range with more than so many times the mean bytes is subdivided.
OVERFULL = 1.5
#: Fixed by the contract: bytes that each record has beside its text.
RECORD_BYTES = 8


def _numbers(values: list[int]) -> Column:
    """A literal array<bigint>, written as one string that is parsed once, when the plan is made."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def _rank(key: Column, splitters: list[int]) -> Column:
    """How many of the sorted splitters are <= key, by halving steps."""
    n = len(splitters)
    if not n:
        return F.lit(0)
    values = _numbers(splitters)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= n) & (F.get(values, at + step - 1) <= key), at + step).otherwise(at))


def _measures(text: str, doc_id: str) -> dict[str, Column]:
    return {
        "__size": F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint") + RECORD_BYTES,
        "__key": F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
        "__tie": F.xxhash64(F.col(doc_id), F.lit(8)),
    }


def assign(docs: DataFrame, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id", out: str = "sharding") -> DataFrame:
    """``docs`` with a struct ``out``: size, shard (from 0) and slot (gapless from 0 in each shard).

    The last step sorts the rows with all their columns; who needs no texts measures first (``measured``) and
    leaves them out.
    """
    return _assigned(measured(docs, text, doc_id), shards, doc_id, free_name(docs.columns, out))


def measured(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with what a record's place depends on: its size and two hashes."""
    return docs.select("*", *[c.alias(n) for n, c in _measures(text, doc_id).items()])


def _assigned(docs: DataFrame, shards: int, doc_id: str, out: str) -> DataFrame:
    own = [c for c in docs.columns if c not in ("__size", "__key", "__tie")]
    # sizes and hashes only: what follows until the last step sees nothing else
    slim = written(docs.select(F.col(doc_id).alias("__id"), "__size", "__key", "__tie"), "sharding-sizes")
    total = slim.agg(F.sum("__size")).first()[0] or 0
    ranges = min(MAX_RANGES, max(shards * RANGES_PER_SHARD, total // BYTES_PER_RANGE))
    step = max(1.0, total / (ranges * SAMPLES_PER_RANGE))
    chance = F.pmod(F.xxhash64("__key", "__tie", F.lit(9)), F.lit(1 << 40)) / float(1 << 40)
    sampled = sorted(r[0] for r in slim.where(chance < F.col("__size") / step).select("__key").collect())
    splitters = sorted({sampled[len(sampled) * i // ranges] for i in range(1, ranges)}) if sampled else []

    ranked = slim.withColumn("__range", _rank(F.col("__key"), splitters))
    filled = dict(ranked.groupBy("__range").agg(F.sum("__size")).collect())
    mean = min(max(1.0, total / ranges), BYTES_PER_RANGE)
    pieces = [1 if filled.get(r, 0) <= OVERFULL * mean else -int(-filled[r] // mean) for r in range(len(splitters) + 1)]
    first, last = [], 0  # the cells of a range follow each other
    for n in pieces:
        first.append(last)
        last += n

    def celled(d: DataFrame) -> DataFrame:
        r = F.col("__range")
        return d.withColumn("__cell", F.get(_numbers(first), r) + F.pmod("__tie", F.get(_numbers(pieces), r)))

    order = Window.partitionBy("__cell").orderBy("__key", "__tie", doc_id)
    cells = {r[0]: (r[1], r[2]) for r in celled(ranked).groupBy("__cell").agg(F.sum("__size"), F.count("*")).collect()}
    bytes_before, rows_before, b, n = [], [], 0, 0
    for c in range(last):
        bytes_before.append(b)
        rows_before.append(n)
        b, n = b + cells.get(c, (0, 0))[0], n + cells.get(c, (0, 0))[1]

    def placed(d: DataFrame, order: Window) -> DataFrame:
        before = F.get(_numbers(bytes_before), F.col("__cell")) + F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__size")
        row = F.get(_numbers(rows_before), F.col("__cell")) + F.row_number().over(order) - 1
        middle = (2 * before + F.col("__size")).cast("decimal(38,0)")  # twice the place of the record's middle byte
        return d.withColumns({"__row": row, "__shard": F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(2 * max(total, 1)))).cast("int")})

    # rows before each shard: all rows of the cells before the one that the boundary runs
    # through, and those of that one cell that lie before it
    through = {s: max(0, bisect_right(bytes_before, s * total // shards) - 1) for s in range(1, shards)} if last else {}
    inside = celled(ranked).where(F.col("__cell").isin(sorted(set(through.values()))) if through else F.lit(False))
    by_id = Window.partitionBy("__cell").orderBy("__key", "__tie", "__id")
    counts = {(c, s): n for c, s, n in placed(inside, by_id).groupBy("__cell", "__shard").count().collect()}
    starts = {s: rows_before[c] + sum(n for (k, x), n in counts.items() if k == c and x < s) for s, c in through.items()}
    first_row = _numbers([starts.get(s, 0) for s in range(shards)])

    d = placed(celled(docs.withColumn("__range", _rank(F.col("__key"), splitters))), order)
    return d.select(*own, F.struct(F.col("__size").alias("size"), F.col("__shard").alias("shard"), (F.col("__row") - F.get(first_row, F.col("__shard"))).alias("slot")).alias(out))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The records in one folder for each shard, by ``shard``, with their ``slot``.

    Where the input has such columns, the new ones have underscores after their names.
    """
    out = free_name(docs.columns, "sharding")
    shard, slot = free_name(docs.columns, "shard"), free_name(docs.columns, "slot")
    d = assign(docs, shards)
    d.select(*docs.columns, F.col(f"{out}.shard").alias(shard), F.col(f"{out}.slot").alias(slot)).write.partitionBy(shard).parquet(path)


def shard_rows(docs: DataFrame) -> DataFrame:
    """op8: where each document goes, by the law ``bytes``."""
    d = measured(docs.select("doc_id", "text")).withColumn("text_crc32", F.crc32(F.coalesce(F.col("text"), F.lit("")))).drop("text")
    d = _assigned(d, SHARDS, "doc_id", "sharding")
    return d.select(
        "doc_id", F.col("sharding.size").alias("size"), "text_crc32",
        F.lit("bytes").alias("law"), F.col("sharding.shard").alias("shard"), F.col("sharding.slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
