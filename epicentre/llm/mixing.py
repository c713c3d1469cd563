"""Mixing sources to target weights by capped water-filling.

Targets.  Sources in code-point order (null last) weigh 5, 2, 1, 5, ...; a source may be
taken at most three times over.  With the cap-to-weight ratios in order, the sources below the
water level are clamped at their cap and what they can't take is shared by weight among the
rest; the level follows from running sums, so no rounds are needed.

Sampling.  A source whose target is r + f times its size takes every document r times and
some once more: those with the smallest seeded hash, up to the target.  Where the next one no
longer fits, the largest documents that still fit are added, again and again until none fits,
which at least halves what is left each time; and at last one that is too long by less than
what is left.  So a source ends nearer to its target than its shortest document left over.

Scale.  Sources are ordered in ranges, with running sums from one range to the next, so no task
holds all of them.  Which documents fill a source up is a rule on their size and hash, with a
few numbers for each source, however many documents that takes.

Sizes are words, of very long texts as of others; a null text has none.  A document of size 0
is taken 0 words.  Rows that share id and size are drawn alike as one document; filling ends
at the first of these that doesn't fit.  An empty table gives an empty result.  Documents of
one size and hash are taken together.  All input columns are carried along; the results stand in
one struct column, whose name gets underscores after it if the input has such a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epicentre.llm.common import free_name, n_words_of, written

#: Fixed by the contract.
WEIGHTS, MAX_EPOCHS = (5, 2, 1), 3
SEED = 20_011
#: A hash has so many bits; where a need is met is searched by so many of them at a time.
BITS, STEP, FILL_STEP = 36, 12, 18

RULES = "array<struct<hi bigint, size bigint, edge bigint>>"


def _same(a: str, b: str) -> Column:
    """Equal sources; null is one of them."""
    return F.col(a).eqNullSafe(F.col(b))


def _before(d: DataFrame, order: list[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """``d`` with the sum of each of ``sums`` over the rows that stand before in this order (0 at the first).

    A task sorts one range of the rows; the ranges' totals are one row for each.
    """
    parts = written(d.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), name)
    back = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy(F.col("__part").alias("__p")).agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    totals = totals.select("__p", *[F.coalesce(F.sum(f"__{n}").over(back), F.lit(0)).alias(f"__{n}") for n in sums])
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    d = parts.join(totals, F.col("__part") == F.col("__p"))
    return d.select(*[F.col(c) for c in parts.columns if c != "__part"], *[(F.col(f"__{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for n, c in sums.items()])


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source_size, target.  ``sized`` has source and size."""
    name = F.col("source").asc_nulls_last()
    per = _before(sized.groupBy("source").agg(F.sum("size").alias("source_size")), [name], {"rank": F.lit(1)}, "mixing-sources")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("rank", F.lit(len(weights))).cast("int"))
    d = per.withColumn("w", weight).withColumn("cap", F.col("source_size") * float(max_epochs)).withColumn("ratio", F.col("cap") / F.col("w"))
    d = written(_before(d, [F.col("ratio"), name], {"capped": F.col("cap"), "heavy": F.col("w")}, "mixing-ratios"), "mixing-levels")
    total, heavy = d.agg(F.sum("source_size"), F.sum("w")).first()
    # the level if this source and all of higher ratio were not clamped
    level = (F.lit(float(total or 0)) - F.col("capped")) / (F.lit(float(heavy or 0)) - F.col("heavy"))
    # the first in order: of equal ratios, that of the highest level
    low = d.where(level <= F.col("ratio")).agg(F.min(F.struct("ratio", (-level).alias("level")))["level"]).first()[0]
    water = None if low is None else -low
    return d.select("source", "source_size", (F.col("cap") if water is None else F.least(F.col("cap"), F.lit(water) * F.col("w"))).alias("target"))


def _unit(seed: int, *cols: str) -> Column:
    """A seeded integer of BITS bits."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << BITS))


def _drawn(docs: DataFrame, seed: int) -> DataFrame:
    return docs.withColumn("__size", n_words_of(F.col("text"))).withColumn("__u", _unit(seed, "doc_id", "__size"))


def _edges(d: DataFrame, need: DataFrame, step: int, name: str) -> DataFrame:
    """of, edge: the least hash at which the rows (source, size, u) of a source exceed its need (of, left); none where they don't."""
    found = need
    for bits in range(step, BITS + 1, step):
        cell = F.shiftright("u", BITS - bits)
        inner = d if bits == step else d.join(found.drop("left"), _same("source", "of") & (F.shiftright(cell, step) == F.col("cell"))).select(d["*"])
        sums = inner.groupBy("source", cell.alias("at")).agg(F.sum("size").alias("s"))
        run = sums.withColumn("run", F.sum("s").over(Window.partitionBy("source").orderBy("at"))).join(found.select("of", "left"), _same("source", "of"))
        first = run.where(F.col("run") > F.col("left")).groupBy("source").agg(F.min(F.struct("at", (F.col("left") - F.col("run") + F.col("s")).alias("left"))).alias("x"))
        found = first.select(F.col("source").alias("of"), F.col("x.at").alias("cell"), F.col("x.left").alias("left"))
        if step == STEP or bits == BITS:  # few rows are of one size: their steps are one job
            found = written(found, f"mixing-{name}{bits}")
    return found.select("of", F.col("cell").alias("edge"))


def _takes(rules: Column, size: Column, u: Column) -> Column:
    """Whether one of the rules takes a document: of sizes up to hi all above ``size``, and of that size those before the edge."""
    return F.exists(rules, lambda r: (size <= r["hi"]) & ((size > r["size"]) | ((size == r["size"]) & (u < r["edge"]))))


def _extra(at: str = "") -> Column:
    """Whether a row (size, u) is taken once more by its source's plan, whose columns begin with ``at``."""
    c = lambda n: F.col(f"{at}{n}")
    size, u = (F.col("size"), F.col("u")) if not at else (F.col("__size"), F.col("__u"))
    return ((u < c("edge")) & (c("need") > 0)) | _takes(c("rules"), size, u)


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Two small written tables: per source its target, where its hash range ends and the rules that fill it up; and one more document of some."""
    sized = written(_drawn(docs.select("doc_id", "source", "text"), seed).select("doc_id", "source", F.col("__size").alias("size"), F.col("__u").alias("u")), "mixing-sizes")
    targets = written(source_targets(sized, weights, max_epochs), "mixing-targets")
    r = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    t = targets.withColumnRenamed("source", "name").withColumn("whole", r).withColumn("need", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("bigint"))
    edges = _edges(sized, t.select(F.col("name").alias("of"), F.col("need").alias("left")), STEP, "edge")
    # without an edge the whole source fits (a need of 0 takes nothing)
    state = t.join(edges, _same("name", "of"), "left").select(
        "name", "source_size", "target", "whole", "need", F.coalesce("edge", F.lit(1 << BITS)).alias("edge"),
        F.array().cast(RULES).alias("rules"), F.lit(None).cast("bigint").alias("was"))

    def weighed(state: DataFrame, name: str) -> DataFrame:
        """With ``left``: what the source still needs; and whether a document fits that, and the last rule took anything."""
        state = written(state, f"{name}-rules")  # so that its size is known: a row for each source
        taken = sized.join(state.select("name", "need", "edge", "rules"), _same("source", "name"))
        got = taken.groupBy("source").agg(F.sum(F.when(_extra(), F.col("size")).otherwise(0)).alias("got"), F.min(F.when(~_extra() & (F.col("size") > 0), F.col("size"))).alias("least"))
        left = F.col("need") - F.col("got")
        return written(state.join(got, _same("name", "source")).select(
            *[F.col(c) for c in state.columns if c not in ("left", "live", "was")], left.alias("left"), ((left >= F.coalesce("least", left + 1)) & (F.col("was").isNull() | (left < F.col("was")))).alias("live")), name)

    def rest_of(state: DataFrame) -> DataFrame:
        d = sized.join(state, _same("source", "name")).where(~_extra() & (F.col("size") > 0))
        return d.select(sized["*"], "left", "source_size")

    # fill the rest: the largest documents that fit, until none does
    state, k = weighed(state, "mixing-fill0"), 0
    while not (live := state.where("live")).isEmpty():
        rest = rest_of(live).where(F.col("size") <= F.col("left"))
        sums = rest.groupBy("source", "size").agg(F.sum("size").alias("s"), F.max("left").alias("left"))
        run = sums.withColumn("run", F.sum("s").over(Window.partitionBy("source").orderBy(F.col("size").desc())))
        over = F.col("run") > F.col("left")
        full = written(run.groupBy("source").agg(F.max("left").alias("hi"), F.max(F.when(over, F.struct("size", (F.col("left") - F.col("run") + F.col("s")).alias("left")))).alias("x")), f"mixing-full{k}")
        short = full.where("x IS NOT NULL").select(F.col("source").alias("of"), F.col("x.size").alias("of_size"), F.col("x.left").alias("left"))
        equal = sized.join(live.select("name", "need", "edge", "rules"), _same("source", "name")).where(~_extra())
        equal = equal.join(short.select(F.col("of").alias("of_"), "of_size"), _same("source", "of_") & (F.col("size") == F.col("of_size"))).select(sized["*"])
        edges = _edges(equal, short, FILL_STEP, f"fill{k}-").withColumnRenamed("edge", "at")
        rules = full.join(edges, _same("source", "of"), "left").select("source", F.array(F.struct(
            "hi", F.coalesce("x.size", F.lit(0)).alias("size"), F.coalesce("at", F.lit(0)).alias("edge"))).cast(RULES).alias("rule"))
        state = state.join(rules, _same("name", "source"), "left").select(
            *[F.col(c) for c in state.columns if c not in ("rules", "live", "left")],
            F.concat("rules", F.coalesce("rule", F.array().cast(RULES))).alias("rules"),
            # a source without a rule this time is done
            F.when(F.col("rule").isNotNull(), F.col("left")).otherwise(F.lit(0)).alias("was"))
        k += 1
        state = weighed(state, f"mixing-fill{k}")
    # one more document, where that comes nearer than what is left
    one = rest_of(state.where("left > 0")).groupBy("source", "u", "doc_id").agg(F.sum("size").alias("size"), F.max("left").alias("left"), F.max("source_size").alias("source_size"))
    one = one.where((F.col("size") > F.col("left")) & (F.col("size") < 2 * F.col("left"))).groupBy("source").agg(F.min(F.struct("size", "u", "doc_id")).alias("b"))
    return state, written(one.select(F.col("source").alias("p_source"), F.col("b.u").alias("p_u"), F.col("b.doc_id").alias("p_id")), "mixing-one-more")


def chosen(docs: DataFrame, out: str = "mix", seed: int = SEED, **how) -> DataFrame:
    """``docs`` with a struct ``out``: size, source_size, target, times (copies that the mix takes).

    The tables of the plan have a row for each source, so the texts stay where they are.
    """
    own, out = docs.columns, free_name(docs.columns, out)
    state, one = plan(docs, seed=seed, **how)
    state = state.select(*[F.col(c).alias(f"__e_{c}") for c in state.columns])
    one = one.select(*[F.col(c).alias(f"__{c}") for c in one.columns], F.lit(True).alias("__p_more"))
    d = _drawn(docs, seed)
    d = d.join(state, d["source"].eqNullSafe(state["__e_name"]), "left")
    d = d.join(one, d["source"].eqNullSafe(one["__p_source"]) & (d["__u"] == one["__p_u"]) & d["doc_id"].eqNullSafe(one["__p_id"]), "left")
    extra = _extra("__e_") | F.coalesce("__p_more", F.lit(False))
    return d.select(*own, F.struct(F.col("__size").alias("size"), F.col("__e_source_size").alias("source_size"), F.col("__e_target").alias("target"), (F.col("__e_whole") + extra.cast("bigint")).alias("times")).alias(out))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken."""
    out = free_name(docs.columns, "__mix")
    d = chosen(docs, out=out, **how).where(F.col(f"{out}.times") > 0)
    return d.withColumn(free_name(d.columns, "__copy"), F.explode(F.sequence(F.lit(1), F.col(f"{out}.times").cast("int")))).select(*docs.columns)


def mixed_sizes(docs: DataFrame) -> DataFrame:
    """op5: the words that the mix takes of each document."""
    d = chosen(docs.select("doc_id", "source", "text"))
    return d.select("doc_id", *[F.col(f"mix.{c}").alias(c) for c in ("size", "source_size", "target")], (F.col("mix.times") * F.col("mix.size")).alias("taken"))
