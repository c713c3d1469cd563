"""Keyed upsert (MERGE) as DataFrame joins, and latest-row-per-key dedupe.

``merge_rows`` gives the rows that a MERGE inserts or updates, whole; a keyed table commits just
those.  The target is read once, past the source's keys unless these are many; which side is
broadcast or whether both shuffle is left to Spark, which knows the written sizes and adapts at
run time.

Target and source keys must be unique and not null; deduplicate the source first.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

_S = "__src_"  # prefix for source columns after the join
_T_PRESENT = "__tgt_present"

#: A key with more rows than this is reduced before the shuffle; at most so many keys are.
FREQUENT_ROWS, FREQUENT_KEYS = 100_000, 1000

#: Pairs of places (days, say) that rows of one key may have in target and source, for a merge to leave other places alone.
MATCHED_PLACES = 1000

Side = Callable[[str], Column]


class KeyCounts(NamedTuple):
    """Distinct keys, rows without one, the most frequent keys, and all that have several rows (None if too many)."""

    keys: int
    none: int
    frequent: list
    repeated: list | None


def key_counts(df: DataFrame, key: str) -> tuple[int, int, list]:
    """Number of distinct keys, of rows without one, and the most frequent keys (a bounded list).

    Reads the key alone. If there are more frequent keys than the list takes, each of the others has
    less than a thousandth of all rows.
    """
    return count_keys(df, key)[:3]


def count_keys(df: DataFrame, key: str) -> KeyCounts:
    """``key_counts``, and the keys with several rows, where these are no more than the bounded list takes."""
    seen = Observation(f"keys-{uuid.uuid4().hex[:8]}")
    known = F.col(key).isNotNull()
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).observe(
        seen, F.count_if(known).alias("keys"), F.sum(F.when(~known, F.col("__n"))).alias("none"))
    several = counts.where((F.col("__n") > 1) & F.col(key).isNotNull()).orderBy(F.col("__n").desc()).limit(FREQUENT_KEYS + 1).collect()
    often = [r[0] for r in several[:FREQUENT_KEYS] if r["__n"] > FREQUENT_ROWS]
    repeated = [r[0] for r in several] if len(several) <= FREQUENT_KEYS else None
    return KeyCounts(int(seen.get["keys"] or 0), int(seen.get["none"] or 0), often, repeated)


def dedupe_counted(df: DataFrame, key: str, order_by: str, counts: KeyCounts) -> DataFrame:
    """``dedupe_latest`` of rows whose keys were counted: where few keys repeat, or none, the rows of all others
    go as they come, unshuffled and unsorted."""
    if counts.repeated is None:
        return dedupe_latest(df, key, order_by, counts.frequent)
    rows = df.filter(F.col(key).isNotNull())
    if not counts.repeated:
        return rows
    several = F.col(key).isin(counts.repeated)
    return rows.filter(~several).unionByName(_latest(rows.filter(several), key, order_by))


def dedupe_latest(df: DataFrame, key: str, order_by: str, frequent: Sequence | None = None) -> DataFrame:
    """One row per key: the largest ``order_by``; ties by a hash of the row.  Null keys are left out.

    A max() over a packed struct has a map-side partial step, so a key repeated in a third of all
    rows is one row per task before the shuffle.  The step sorts all rows of a task, of whatever size
    the input's splits are; a caller who knows the ``frequent`` keys (``key_counts``) has it for these
    alone, and the others are sorted after the shuffle, in its even parts.
    """
    rows = df.filter(F.col(key).isNotNull())
    if frequent is None:
        return _latest(rows, key, order_by)
    if not frequent:
        return _latest(rows.repartition(key), key, order_by)
    often = F.col(key).isin(list(frequent))
    return _latest(rows.filter(~often).repartition(key), key, order_by).unionByName(_latest(rows.filter(often), key, order_by))


def _latest(df: DataFrame, key: str, order_by: str) -> DataFrame:
    packed = F.struct(
        F.col(order_by).alias("__order"),
        F.xxhash64(*[F.col(c) for c in df.columns]).alias("__tiebreak"),
        *[F.col(c) for c in df.columns if c != key],
    )
    latest = df.groupBy(key).agg(F.max(packed).alias("__w"))
    return latest.select(*[F.col(key) if c == key else F.col("__w")[c].alias(c) for c in df.columns])


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    key: str,
    *,
    update_cols: Sequence[str] | None = None,
    condition: Callable[[Side, Side], Column] | None = None,
    on_update: Mapping[str, Column] | None = None,
    on_insert: Mapping[str, Column] | None = None,
    keys: DataFrame | None = None,
    past_keys: bool = True,
) -> DataFrame:
    """The new rows of MERGE ... USING ``source`` ON key.

    WHEN MATCHED [AND condition(tgt, src)] THEN UPDATE SET ``update_cols`` from the
    source (all shared non-key columns if None) and ``on_update`` values;
    WHEN NOT MATCHED THEN INSERT the source row, ``on_insert`` filling columns the
    source lacks. Columns that only the source has are appended, null in rows that don't take them.

    The target is first reduced to the source's keys, which reads the source twice: ``keys``, a
    written table that holds all of them (and maybe more), spares that. With ``past_keys`` off
    the target is joined as it is, for a source with a large share of its keys.
    """
    hits = target.join((source if keys is None else keys).select(key), key, "left_semi").select(*target.columns) if past_keys else target
    hits = hits.withColumn(_T_PRESENT, F.lit(True))
    src = source.select(*[F.col(c).alias(_S + c) for c in source.columns])
    joined = src.join(hits, F.col(key) == F.col(_S + key), "left")
    is_insert, takes, new, _ = _rule(target, source, key, update_cols, condition, on_update, on_insert)
    return joined.filter(is_insert | takes).select(*[c.alias(n) for n, c in new.items()])


def merge_all(
    target: DataFrame,
    source: DataFrame,
    key: str,
    changed: str,
    *,
    update_cols: Sequence[str] | None = None,
    condition: Callable[[Side, Side], Column] | None = None,
    on_update: Mapping[str, Column] | None = None,
    on_insert: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The whole target after the MERGE of ``merge_rows``, from one join: for a source that changes much of it.

    ``changed`` is a column of the target alone (the number of a row's commit): null in the rows that the MERGE
    inserts or updates.
    """
    src = source.select(*[F.col(c).alias(_S + c) for c in source.columns])
    joined = src.join(target.withColumn(_T_PRESENT, F.lit(True)), F.col(key) == F.col(_S + key), "full")
    is_insert, takes, new, stored = _rule(target, source, key, update_cols, condition, on_update, on_insert)
    renewed = is_insert | (F.col(_S + key).isNotNull() & takes)
    new[changed] = F.lit(None).cast(target.schema[changed].dataType)
    return joined.select(*[F.when(renewed, c).otherwise(stored[n]).alias(n) for n, c in new.items()])


class Matches(NamedTuple):
    """Rows that a MERGE inserts or updates, and the places (target, source) of the keys on both sides (None if too many)."""

    changed: int
    places: list[tuple[int, int]] | None

    def replaced(self) -> list[int] | None:
        """The target's places that may have keys of the source (None if too many)."""
        return None if self.places is None else sorted({at for at, _ in self.places})

    def target(self, place: Column) -> Column:
        """Whether a target row's key may be in the source: no row of another place has it there."""
        return F.lit(True) if self.places is None else place.isin(self.replaced())

    def source(self, place: Column) -> Column:
        """Whether a source row's key may be in the target."""
        return F.lit(True) if self.places is None else place.isin(sorted({to for _, to in self.places}))


def matches(joined: DataFrame, takes: Column, at: str, to: str) -> Matches:
    """Of source rows ``joined`` with their target rows' place ``at`` (null: unmatched) and their own ``to``."""
    seen = Observation(f"matches-{uuid.uuid4().hex[:8]}")
    # observed past the shuffle: what is before one that turns out empty is dropped at run time, and its counts with it
    pairs = joined.groupBy(at, to).agg(F.count(F.lit(1)).alias("__n"), F.count_if(takes).alias("__taken")).observe(seen, F.sum("__taken").alias("changed"))
    top = pairs.where(F.col(at).isNotNull()).orderBy(F.col("__n").desc()).limit(MATCHED_PLACES + 1)
    found = [(r[at], r[to]) for r in top.collect()]
    return Matches(int(seen.get["changed"] or 0), found if len(found) <= MATCHED_PLACES else None)


def match_merged(target: DataFrame, source: DataFrame, key: str, order_by: str, place: Column) -> Matches:
    """``count_merged``, with the places of the keys on both sides; ``place``, never null, is made of columns of either.

    Of a key's several rows in the source, only the last place is told."""
    newest = source.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(order_by).alias("__new"), F.max(place).alias("__to"))
    stored = target.select(key, F.col(order_by).alias("__old"), place.alias("__at"))
    takes = F.col("__at").isNull() | (F.col("__new") > F.col("__old"))
    return matches(newest.join(stored, key, "left"), takes, "__at", "__to")


def merge_apart(target: DataFrame, source: DataFrame, fresh: DataFrame, shared: Column, key: str, changed: str, rest: bool = True, **how) -> DataFrame:
    """``merge_all`` of ``source`` and ``fresh`` together, joining no more than it must.

    No key of ``fresh`` is in the target, and no row of the target that isn't ``shared`` (true or false, never null) has
    a key of the source: these stay and are inserted as they come, unshuffled and unsorted. Without ``rest``, those that
    stay are left out, for a table that keeps them where they are."""
    whole = merge_all(target.where(shared), source, key, changed, **how)
    on_insert = how.get("on_insert") or {}
    # plain values: with the conditions of a merge, the code of a wide row can outgrow what the JVM compiles
    value = {c: F.col(c) if c in fresh.columns else on_insert.get(c, F.lit(None)) for c in whole.columns if c != changed}
    inserted = fresh.select(*[value.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in whole.schema.fields])
    # scans first, as their tasks are less even than those of the join
    plain = inserted.unionByName(target.where(~shared), allowMissingColumns=True) if rest else inserted
    return plain.unionByName(whole)


def _rule(target, source, key, update_cols, condition, on_update, on_insert) -> tuple[Column, Column, dict[str, Column], dict[str, Column]]:
    """Of joined rows: whether one is inserted, whether a matched one is updated, its new values, and those stored."""
    on_update, on_insert = dict(on_update or {}), dict(on_insert or {})
    added = [c for c in source.columns if c not in target.columns]
    out_cols = [*target.columns, *added]
    upd = {c for c in source.columns if c != key} if update_cols is None else set(update_cols)
    types = {f.name: f.dataType for f in (*source.schema.fields, *target.schema.fields)}

    def t(c: str) -> Column:
        return F.col(c) if c in target.columns else F.lit(None).cast(types[c])

    def s(c: str) -> Column:
        return F.col(_S + c) if c in source.columns else F.lit(None).cast(types[c])

    def updated(c: str) -> Column:
        return on_update[c] if c in on_update else s(c) if c in upd else t(c)

    def inserted(c: str) -> Column:
        return s(c) if c in source.columns else on_insert.get(c, F.lit(None))

    is_insert = F.col(_T_PRESENT).isNull()
    takes = F.coalesce(condition(t, s), F.lit(False)) if condition else F.lit(True)
    new = {c: F.when(is_insert, inserted(c)).otherwise(updated(c)).cast(types[c]) for c in out_cols}
    return is_insert, takes, new, {c: t(c) for c in out_cols}


def count_merged(target: DataFrame, source: DataFrame, key: str, order_by: str) -> int:
    """Number of rows of ``merge_rows`` that take a source row if its ``order_by`` is strictly newer: reads these and the
    keys alone. A key of the source may have several rows, of which the newest counts."""
    return match_merged(target, source, key, order_by, F.lit(0)).changed


def merge_upsert(target: DataFrame, source: DataFrame, key: str, **how) -> DataFrame:
    """The whole next version of ``target``: its rows that stay, and ``merge_rows``."""
    rows = merge_rows(target, source, key, **how)
    kept = target.join(rows.select(key), key, "left_anti").select(*target.columns)
    return kept.unionByName(rows, allowMissingColumns=True)
