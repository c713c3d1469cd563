"""Written tables in the shared folder.

Nothing is ever written over files that a reader may hold.  A plain table is a directory for
each version, complete once Spark's ``_SUCCESS`` is there.  A keyed table is a base directory
and a few directories of later rows; one small text names them, and a commit writes new files
first and then the next text.  A run that dies before that leaves the old table whole.  What a
newer version has replaced is removed when that version is ``keep_for`` old, by the file
system's own times, so a job that began no longer ago than that finds all its files, in
whatever process it runs.  Intermediate tables belong to the run that writes them, which removes
just its own.

This covers one writer for each table and any number of readers, on any Hadoop file system.
Where the session has a table format with MERGE, use that instead: the operators give it the
same changed rows.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT = "__commit"
_FAILED = "__failed"

#: Ranges of an ordered base that have bounds of their own; rows of a file of it, and fewest rows that are worth a task.
RANGES, ROWS_A_FILE, ROWS_A_TASK = 64, 500_000, 20_000


def _place(at: Column, bounds: list[tuple[float, int]], above: int) -> Column:
    """The number of the first bound that isn't below ``at``, ``above`` if all are: a binary search."""
    if not bounds:
        return F.lit(above)
    mid = len(bounds) // 2
    value, number = bounds[mid]
    return F.when(at <= value, _place(at, bounds[:mid], number)).otherwise(_place(at, bounds[mid + 1:], above))


class TableStore:
    def __init__(self, spark: SparkSession, root: str, keep_for: dt.timedelta = dt.timedelta(days=1)):
        self.spark, self.root, self.keep_for = spark, root.rstrip("/"), keep_for
        self._own: Scratch | None = None

    # -- the file system, for small metadata on the driver --
    def _path(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def times(self, path: str) -> dict[str, int]:
        """Names in a folder with the times of their last change (ms), in order of name."""
        fs, p = self._path(path)
        return dict(sorted((st.getPath().getName(), st.getModificationTime()) for st in fs.listStatus(p))) if fs.exists(p) else {}

    def names(self, path: str) -> list[str]:
        return list(self.times(path))

    def expired(self, since: int, now: int) -> bool:
        return now - since > self.keep_for.total_seconds() * 1000

    def complete(self, path: str) -> bool:
        fs, p = self._path(f"{path}/_SUCCESS")
        return fs.exists(p)

    def remove(self, path: str) -> None:
        fs, p = self._path(path)
        fs.delete(p, True)

    def read_text(self, path: str) -> str:
        fs, p = self._path(path)
        stream = fs.open(p)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_text(self, path: str, text: str) -> None:
        """A new file, all of it or none; an error if it is there already."""
        fs, tmp = self._path(f"{path}.{uuid.uuid4().hex[:8]}.tmp")
        out = fs.create(tmp, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        _, final = self._path(path)
        if fs.exists(final) or not fs.rename(tmp, final):
            fs.delete(tmp, False)
            raise RuntimeError(f"{path} was committed by another writer")

    # -- plain tables --
    def _versions(self, name: str) -> list[str]:
        return [n for n in self.names(f"{self.root}/{name}") if n.startswith("v") and n[1:].isdigit()]

    def _newest(self, name: str) -> str | None:
        return next((v for v in reversed(self._versions(name)) if self.complete(f"{self.root}/{name}/{v}")), None)

    def exists(self, name: str) -> bool:
        return self._newest(name) is not None

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame | None:
        v = self._newest(name)
        if v is None:
            return None if schema is None else self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.root}/{name}/{v}")

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write the next version and read it back, which cuts the lineage."""
        have = self._versions(name)
        path = f"{self.root}/{name}/v{int(have[-1][1:]) + 1 if have else 1:06d}"
        df.write.parquet(path)
        times = {v: t for v, t in self.times(f"{self.root}/{name}").items() if v in self._versions(name)}
        versions = list(times)
        for v, later in zip(versions, versions[1:], strict=False):
            if self.expired(times[later], times[versions[-1]]):
                self.remove(f"{self.root}/{name}/{v}")
        return self.spark.read.parquet(path)

    # -- intermediate tables --
    def run(self) -> Scratch:
        """A folder for the intermediate tables of one run; leave it as a context, and it is gone."""
        return Scratch(self)

    def scratch(self, name: str, df: DataFrame) -> DataFrame:
        """An intermediate table of this store's user, kept until drop_scratch()."""
        self._own = self._own or self.run()
        return self._own.write(name, df)

    def drop_scratch(self) -> None:
        """Remove what this object's scratch() wrote, and nothing of other runs."""
        if self._own is not None:
            self._own.drop()
            self._own = None


class Scratch:
    """Intermediate tables of one run, in a folder of its own.

    What a run that died has left is removed by a later run when it is ``keep_for`` old.
    """

    def __init__(self, store: TableStore):
        self.store, self.name = store, uuid.uuid4().hex[:16]
        folder = f"{store.root}/_scratch"
        fs, p = store._path(f"{folder}/{self.name}")
        fs.mkdirs(p)
        times = store.times(folder)
        for n, t in times.items():
            if n != self.name and store.expired(t, times[self.name]):
                store.remove(f"{folder}/{n}")

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written and read back."""
        path = f"{self.store.root}/_scratch/{self.name}/{name}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        return self.store.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        self.store.remove(f"{self.store.root}/_scratch/{self.name}")

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop()


class AppendTable:
    """Rows that are stored once for each key, in a directory for each append; none is written again.

    An append that dies leaves a directory without ``_SUCCESS``, which no reader sees; when it
    is repeated, the rows that had come are known by their keys.
    """

    def __init__(self, store: TableStore, name: str, key: str):
        self.store, self.key = store, key
        self.root = f"{store.root}/{name}"

    def read(self) -> DataFrame | None:
        parts = [f"{self.root}/{n}" for n in self.store.names(self.root) if self.store.complete(f"{self.root}/{n}")]
        return self.store.spark.read.option("mergeSchema", "true").parquet(*parts) if parts else None

    def append(self, rows: DataFrame) -> int:
        """Add the rows whose keys aren't there; gives their number."""
        from pyspark.sql import Observation

        have = self.read()
        new = rows.dropDuplicates([self.key])
        if have is not None:
            new = new.join(have.select(self.key), self.key, "left_anti").select(*rows.columns)
        seen = Observation(f"rows-{uuid.uuid4().hex[:8]}")
        folder = f"{self.root}/{uuid.uuid4().hex[:16]}"
        new.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(folder)
        n = int(seen.get["n"] or 0)
        if not n:
            self.store.remove(folder)
        return n


class Manifests:
    """A table whose newest numbered text says which of its files count."""

    def __init__(self, store: TableStore, name: str):
        self.store, self.name = store, name
        self.root = f"{store.root}/{name}"

    def state(self) -> dict | None:
        """The newest manifest, None if the table isn't there."""
        have = [n for n in self.store.names(f"{self.root}/manifests") if n.endswith(".json")]
        return json.loads(self.store.read_text(f"{self.root}/manifests/{have[-1]}")) if have else None

    def _put(self, state: dict) -> None:
        folder = f"{self.root}/manifests"
        have = [n for n in self.store.names(folder) if n.endswith(".json")]
        number = int(have[-1][:-5]) + 1 if have else 1
        self.store.create_text(f"{folder}/{number:08d}.json", json.dumps(state))
        self._expire()

    def _expire(self) -> None:
        """Remove manifests that were replaced ``keep_for`` ago, and files that only these named.

        The kept manifests are read for it only when the oldest is twice that old, so an ordinary commit
        reads none of them.
        """
        folder = f"{self.root}/manifests"
        times = {n: t for n, t in self.store.times(folder).items() if n.endswith(".json")}
        names, now = list(times), max(times.values())
        old = [n for n, later in zip(names, names[1:], strict=False) if self.store.expired(times[later], now)]
        if not old or not self.store.expired(times[old[0]] + int(self.store.keep_for.total_seconds() * 1000), now):
            return
        for n in old:
            self.store.remove(f"{folder}/{n}")
        self._clean([json.loads(self.store.read_text(f"{folder}/{n}")) for n in names[len(old):]], now)

    def _clean(self, kept: list[dict], now: int) -> None:
        """Remove the files that no kept manifest counts and that are ``keep_for`` old."""
        raise NotImplementedError

    def exists(self) -> bool:
        return self.state() is not None

    def last_commit(self) -> int:
        s = self.state()
        return s["last"] if s else 0

    def notes(self) -> dict:
        s = self.state()
        return s["notes"] if s else {}


class PartitionedTable(Manifests):
    """Rows by a partition column; a commit replaces whole partitions and writes no others.

    Each commit writes its partitions by dynamic partition overwrite, in folders of its own number
    under the partition's: a commit that died and is repeated replaces just what it had written, and
    files that a reader may hold are never touched.  A reader takes each partition's newest commit.
    Columns that a commit is the first to have are appended, null in other partitions.
    """

    def __init__(self, store: TableStore, name: str, by: str):
        super().__init__(store, name)
        self.by = by

    def read(self, state: dict | None = None) -> DataFrame | None:
        s = state or self.state()
        if s is None:
            return None
        schema = T.StructType.fromJson(s["schema"])
        kinds = T.StructType([*schema.fields, T.StructField(COMMIT, T.LongType())])
        rows = self.store.spark.read.schema(kinds).parquet(f"{self.root}/data").where(F.col(COMMIT).between(s["base"], s["last"]))
        newest = rows.groupBy(F.col(self.by).alias("__by")).agg(F.max(COMMIT).alias("__newest"))
        of = F.col(self.by).eqNullSafe(F.col("__by")) & (F.col(COMMIT) == F.col("__newest"))
        return rows.join(newest, of, "left_semi").select(*schema.names)

    def commit(self, rows: DataFrame, replace_all: bool = False, notes: dict | None = None) -> DataFrame:
        """Replace the partitions of these rows, or the whole table; gives the table."""
        s = self.state() or {"base": 1, "last": 0, "schema": rows.schema.jsonValue(), "notes": {}}
        number = s["last"] + 1
        old = T.StructType.fromJson(s["schema"])
        schema = rows.schema if replace_all else T.StructType([*old.fields, *(f for f in rows.schema.fields if f.name not in old.names)])
        columns = [F.col(c).cast(schema[c].dataType).alias(c) for c in rows.columns]
        writer = rows.select(*columns, F.lit(number).cast("long").alias(COMMIT)).repartition(self.by).write
        writer.partitionBy(self.by, COMMIT).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{self.root}/data")
        new = {"base": number if replace_all else s["base"], "last": number, "schema": schema.jsonValue(), "notes": s["notes"] if notes is None else notes}
        self._put(new)
        return self.read(new)

    def _clean(self, kept: list[dict], now: int) -> None:
        oldest = min(s["last"] for s in kept)
        base = min(s["base"] for s in kept)
        for part in self.store.names(f"{self.root}/data"):
            times = self.store.times(f"{self.root}/data/{part}") if "=" in part else {}
            numbers = sorted(int(n.partition("=")[2]) for n in times if n.startswith(f"{COMMIT}="))
            counted = [n for n in numbers if n <= oldest]  # of these the oldest kept manifest takes the newest
            for n in counted:
                if (n < counted[-1] or n < base) and self.store.expired(times[f"{COMMIT}={n}"], now):
                    self.store.remove(f"{self.root}/data/{part}/{COMMIT}={n}")


class Staying(NamedTuple):
    """Rows of a keyed table that stay in their files, how many of them fail each check, and the files."""

    rows: int
    checks: dict[str, int]
    files: list


class KeyedTable(Manifests):
    """Rows by key, with small commits: a base, and directories of rows written since.

    A commit appends the rows that it changed or added, whole, stamped with a number that
    always rises.  A reader takes the base without the keys that came later, and of these the
    newest row.  When ``FOLD`` directories are of one order of size (a power of ``FOLD``), they
    are folded into one of the next, which leaves their newest rows: so a row is folded once for
    each order of size, however small the commits are, and there are fewer than ``FOLD``
    directories of each.  The base is rewritten only when what came later has grown to
    ``MAX_SHARE`` of its rows.  A commit that touches only some places (days, say) of a large
    share of the rows writes these anew; the rows of other places stay in the older base's files.
    """

    #: Directories that are folded into one (and of the base, fewer than so many); share of the base's rows at which the base
    #: is rewritten; least share of the rows in older files that must be current for these to stay.
    FOLD, MAX_SHARE, CURRENT_SHARE = 8, 0.25, 1 / 3

    def __init__(self, store: TableStore, name: str, key: str, order_by: list[str] | None = None, checks: Mapping[str, Column] | None = None,
                 place: Column | None = None):
        """``checks`` tell whether a row fails; each write counts such rows, in its manifest. At most 63.

        ``order_by`` names the columns that the base is ranged by, the first of them a date or a number; ``place`` is
        a number of each row, never null and the same for many, that a commit may leave whole places alone by: where the
        base is ranged by a date, its day (some day for null)."""
        super().__init__(store, name)
        self.key, self.order_by, self.checks, self.place = key, order_by, dict(checks or {}), place

    # a manifest: base, base_rows, base_commit, base_checks, commits [[directory, last number, rows, checks]], last, notes, and
    # kept [[directory, last number, rows, places that aren't current in it]]: the older files of the base, whose rows and checks count in it

    def _clean(self, kept: list[dict], now: int) -> None:
        used = {"manifests"}.union(*({s["base"], *(k[0] for k in s.get("kept", [])), *(c[0] for c in s["commits"])} for s in kept))
        for n, t in self.store.times(self.root).items():
            if n not in used and self.store.expired(t, now):  # a younger one may be about to be named
                self.store.remove(f"{self.root}/{n}")

    def _write(self, df: DataFrame, ordered: bool, like: DataFrame | None = None) -> tuple[str, int, dict[str, int]]:
        """``like`` has about the values of the order columns that ``df`` has, where those are dear to make."""
        from pyspark.sql import Observation

        if ordered and self.order_by:
            df = self._ranged(df, df if like is None else like).sortWithinPartitions(*self.order_by)
        # in no order, rows are written as their join or scan gives them: in even parts, as keys are unique
        seen = Observation(f"rows-{uuid.uuid4().hex[:8]}")
        # what is observed is interpreted for each row: the checks are compiled into the bits of one number
        failed = F.lit(0).cast("long")
        for i, fails in enumerate(self.checks.values()):
            failed = failed.bitwiseOR(F.when(fails, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
        df = df.withColumn(_FAILED, failed).observe(seen, F.count(F.lit(1)).alias("n"), F.bit_or(_FAILED).alias("failed")).drop(_FAILED)
        folder = uuid.uuid4().hex[:16]
        df.write.parquet(f"{self.root}/{folder}")
        counts = seen.get
        return folder, int(counts["n"] or 0), self._counted(folder, int(counts["failed"] or 0))

    def _counted(self, folder: str, failed: int) -> dict[str, int]:
        """Failures of each check in written rows: only where some row has failed are its columns read back."""
        again = {n: fails for i, (n, fails) in enumerate(self.checks.items()) if failed >> i & 1}
        found = {}
        if again:
            found = self.store.spark.read.parquet(f"{self.root}/{folder}").agg(*[F.count_if(c).alias(n) for n, c in again.items()]).first().asDict()
        return {n: int(found.get(n, 0)) for n in self.checks}

    def _ranged(self, df: DataFrame, like: DataFrame) -> DataFrame:
        """``df`` in even ranges of the first order column, a value of many rows over several.

        The bounds come from that column of ``like`` alone; ``repartitionByRange`` would make all rows of ``df``
        twice, once for its sample.
        """
        lead, kind = F.col(self.order_by[0]), df.schema[self.order_by[0]].dataType
        if not isinstance(kind, (T.DateType, T.NumericType)):
            return df.repartitionByRange(*self.order_by, self.key)
        at = F.coalesce((F.unix_date(lead) if isinstance(kind, T.DateType) else lead).cast("double"), F.lit(float("-inf")))
        parts = [(i + 1) / RANGES for i in range(RANGES - 1)]
        rows, cuts = like.select(at.alias("at")).agg(F.count(F.lit(1)), F.percentile_approx("at", parts)).first()
        tasks = self.store.spark.sparkContext.defaultParallelism
        files = max(1, math.ceil(rows / ROWS_A_FILE), min(tasks, math.ceil(rows / ROWS_A_TASK)))
        ranges = min(files, RANGES)
        cuts = [cuts[(i + 1) * RANGES // ranges - 1] for i in range(ranges - 1)] if rows else []
        first, times = {}, {}
        for i, c in enumerate(cuts):
            first.setdefault(c, i)
            times[c] = times.get(c, 0) + 1
        each = -(-files // ranges)
        low, span = _place(at, list(first.items()), len(cuts)), F.lit(1)
        for c, n in times.items():
            span = F.when(at == c, F.lit(n + 1)).otherwise(span) if n > 1 else span
        spread = F.pmod(F.xxhash64(self.key), span * each).cast("int")
        return df.repartitionById(each * ranges, low * each + spread)

    def failures(self, check: str) -> int | None:
        """Failures of a check as the writes counted them; None where they can't tell.

        Rows that a later write has replaced were counted too: only zeros are sure to hold for the table.
        """
        s = self.state()
        counts = [(s.get("base_checks") or {}).get(check), *[(c[3] if len(c) > 3 else {}).get(check) for c in s["commits"]]] if s else [None]
        return 0 if all(n == 0 for n in counts) else counts[0] if len(counts) == 1 else None

    def read(self, with_commit: bool = False, since: int | None = None, state: dict | None = None) -> DataFrame | None:
        """The current rows; with ``since``, only those written by later commits."""
        s = state or self.state()
        if s is None:
            return None
        spark = self.store.spark
        base = self._base(s, since)
        later = [c for c in s["commits"] if since is None or c[1] > since]
        out = base
        if later:
            new = self._runs(later)
            if since is not None:
                new = new.where(F.col(COMMIT) > since)
            keys = new.select(self.key)
            # the base streams past the keys of the later commits, which compact() keeps few
            out = new if base is None else base.join(keys, self.key, "left_anti").select(*base.columns).unionByName(new, allowMissingColumns=True)
        if out is None:
            out = spark.read.parquet(f"{self.root}/{s['base']}").limit(0)
        return out if with_commit else out.drop(COMMIT)

    def _base(self, s: dict, since: int | None = None) -> DataFrame | None:
        """The rows of the base, each in one of its directories; with ``since``, only those of later commits, None if there are none."""
        if since is not None and s["base_commit"] <= since:
            return None
        base = self.store.spark.read.parquet(f"{self.root}/{s['base']}")
        for folder, last, _, gone in s.get("kept", []):
            if since is None or last > since:
                rows = self.store.spark.read.parquet(f"{self.root}/{folder}")
                base = base.unionByName(rows.where(~self.place.isin(gone) & self._outside(gone, rows)), allowMissingColumns=True)
        return base if since is None else base.where(F.col(COMMIT) > since)

    def _outside(self, gone: list[int], rows: DataFrame) -> Column:
        """Where the base is ranged by the date whose day is the place, the same in bounds that let whole files be skipped."""
        if not self.order_by or not isinstance(rows.schema[self.order_by[0]].dataType, T.DateType):
            return F.lit(True)
        date, out = F.col(self.order_by[0]), F.lit(True)
        first = [g for g in gone if g - 1 not in set(gone)]
        last = [g for g in gone if g + 1 not in set(gone)]
        for low, high in zip(first, last, strict=True):
            out = out & (date.isNull() | (date < F.date_from_unix_date(F.lit(low))) | (date > F.date_from_unix_date(F.lit(high))))
        return out

    def _runs(self, runs: list) -> DataFrame:
        """The newest rows of these directories; which they are is told by keys and numbers alone."""
        new = self.store.spark.read.option("mergeSchema", "true").parquet(*[f"{self.root}/{c[0]}" for c in runs])
        if len(runs) == 1:
            return new
        newest = new.groupBy(self.key).agg(F.max(COMMIT).alias(COMMIT))
        return new.join(newest, [self.key, COMMIT], "left_semi").select(*new.columns)

    def rebuild(self, df: DataFrame, notes: dict | None = None) -> None:
        """Replace the whole table."""
        last = self.last_commit() + 1
        folder, rows, checks = self._write(df.withColumn(COMMIT, F.lit(last).cast("long")), True)
        self._put({"base": folder, "base_rows": rows, "base_commit": last, "base_checks": checks, "commits": [], "last": last, "notes": notes or {}})

    def commit(self, rows: DataFrame, notes: dict | None = None) -> int:
        """Add changed or new rows, one for each key; gives their number.  No rows, no commit."""
        s = self.state()
        last = s["last"] + 1
        folder, n, checks = self._write(rows.withColumn(COMMIT, F.lit(last).cast("long")), False)
        if not n:
            self.store.remove(f"{self.root}/{folder}")
            if notes is not None and notes != s["notes"]:
                self._put(s | {"notes": notes})
            return 0
        self._put(s | {"commits": [*s["commits"], [folder, last, n, checks]], "last": last, "notes": s["notes"] if notes is None else notes})
        if self.outgrows(n, s):
            self.compact()
        else:
            self.fold()
        return n

    def fold(self) -> None:
        """Fold the directories of an order of size that has ``FOLD`` of them, and so on upwards."""
        while True:
            s = self.state()
            orders: dict[int, list] = {}
            for c in s["commits"]:
                orders.setdefault(int(math.log(max(c[2], 1), self.FOLD) + 1e-9), []).append(c)
            full = next((runs for _, runs in sorted(orders.items()) if len(runs) >= self.FOLD), None)
            if full is None:
                return
            folder, rows, checks = self._write(self._runs(full).hint("rebalance"), False)  # few rows of many files
            rest = [c for c in s["commits"] if c not in full]
            self._put(s | {"commits": sorted([*rest, [folder, max(c[1] for c in full), rows, checks]], key=lambda c: c[1])})

    def outgrows(self, changed: int, state: dict) -> bool:
        """Whether a commit of so many rows leads to a new base."""
        return changed + sum(c[2] for c in state["commits"]) > self.MAX_SHARE * max(state["base_rows"], 1)

    def staying(self, gone: Sequence[int] | None, state: dict) -> Staying | None:
        """The rows of ``state`` outside the places ``gone``, if a ``commit_all`` may leave them in their files: None if
        the places aren't known, rows of later commits lie over the base, or the files hold too few current rows or are too many."""
        if self.place is None or gone is None or state["commits"]:
            return None
        files = [[state["base"], state["base_commit"], state["base_rows"] - state.get("kept_rows", 0), []], *state.get("kept", [])]
        if len(files) >= self.FOLD:
            return None
        known = state.get("base_checks") or {}
        failing = [n for n in self.checks if known.get(n) != 0]
        counts = [F.count_if(self.checks[n]).alias(n) for n in failing]
        left = self._base(state).where(~self.place.isin(list(gone))).agg(F.count(F.lit(1)).alias("__rows"), *counts).first().asDict()
        if not left["__rows"] or left["__rows"] < self.CURRENT_SHARE * sum(f[2] for f in files):
            return None
        return Staying(left["__rows"], {n: left.get(n, 0) for n in self.checks}, [[*f[:3], sorted({*f[3], *gone})] for f in files])

    def commit_all(self, table: DataFrame, state: dict, notes: dict | None = None, like: DataFrame | None = None, stay: Staying | None = None) -> None:
        """A commit that leads to a new base, as that base: ``table`` is the whole table after it, made from ``state``, and
        has no commit in the rows that it changes or adds. So they are written once, not as a directory first.
        Rows that ``stay`` (``staying`` of the same state) are not in ``table``, and not written."""
        last = state["last"] + 1
        folder, rows, checks = self._write(table.withColumn(COMMIT, F.coalesce(COMMIT, F.lit(last).cast("long"))), True, like)
        if self.state() != state:
            raise RuntimeError(f"{self.root} was committed by another writer")
        new = {"base": folder, "base_rows": rows, "base_commit": last, "base_checks": checks, "commits": [], "last": last,
               "notes": state["notes"] if notes is None else notes}
        if stay:
            new |= {"base_rows": rows + stay.rows, "base_checks": {n: c + stay.checks[n] for n, c in checks.items()}, "kept": stay.files, "kept_rows": stay.rows}
        self._put(new)

    def compact(self) -> None:
        """Write the current rows as a new base; each keeps the number of its commit."""
        s = self.state()
        if s["commits"]:
            later = self.store.spark.read.option("mergeSchema", "true").parquet(*[f"{self.root}/{c[0]}" for c in s["commits"]])
            like = self._base(s).unionByName(later, allowMissingColumns=True)
            folder, rows, checks = self._write(self.read(with_commit=True, state=s), True, like)
            self._put(s | {"base": folder, "base_rows": rows, "base_commit": s["last"], "base_checks": checks, "commits": [], "kept": [], "kept_rows": 0})
