"""Conversation structure repair by Wagner-Fischer alignment to an alternating grammar.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles.  Its turns are aligned
to each length of the grammar's string (with and without the leading ``s``, or from the middle
of it) by edit operations: Keep 0, Rerole to user or assistant 2, Delete 3 (required for blank
and repeated turns), Insert an empty user or assistant turn 2; a truncated turn that stays
adds 1.  All lengths are columns of one table, as each target is the start of the next.  A
greedy alignment gives an incumbent cost; Ukkonen's bands leave out the cells whose surplus of
insertions or deletions, or whose cost, is past it.  Cells carry their backtraced audit, the
initials of the edits in order, and of equal costs the ASCII-least audit stays.

Alignments compose.  A block of turns is aligned from every state of the grammar to every
other; audits of a block all end with an edit that consumes its last turn, so no audit is the
beginning of another, and the least audit of blocks in a row is made of least audits.  So a
conversation of any length is aligned in blocks of at most ``BLOCK`` turns.

Turns are ranged by conversation, turn, role and text, so a conversation with a third of all
rows stands in many partitions.  A conversation that lies inside a partition is repaired as
its turns stream past.  Those that may cross a border (at most two in a partition), or have
more than ``HELD_BYTES`` of text, are cut into blocks that are aligned in tasks of their own;
one task then joins a conversation's block costs and audits (about ten bytes a turn, never
texts), and each block is repaired by its part of the audit.  The SHA-256 of a whole
conversation can only be taken in order, so that one column streams a conversation through
one task, a batch at a time.

Null roles and texts count as one space (so the text is blank), also in the damage's key.  Turns with equal
numbers are ordered by role and text; null turn numbers come first.  Null conversation ids are
one conversation.  Repeated rows are turns of their own, duplicates of the first.  Roles other
than system, user, assistant are kept nowhere unless they begin with the same letter; an empty
role never.  Very long texts pass as single values.  An empty table gives an empty result.  Only the
named columns are read, so further ones can't clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epicentre.llm.common import SPACES, written

#: Fixed by the contract: the costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
LEGAL = frozenset({"su", "ua", "au"})
ROLES = {"u": "user", "a": "assistant"}
#: Turns that are aligned at once, and bytes of a conversation's texts that a task holds.
BLOCK, HELD_BYTES = 256, 16 << 20
#: An exit that costs so much more than the greedy alignment is never worth taking: its state can be
#: had for two insertions, and the best state saves one deletion.
SLACK = 8

#: States of the grammar: nothing yet, after the system turn, a user turn is due, an assistant turn is due.
EMPTY, OPENED, USER, ASSISTANT = range(4)
#: What completes the grammar from there.
TAILS = {EMPTY: "", OPENED: "II", USER: "", ASSISTANT: "I"}

_SPACE = " \t\n\v\f\r"
_ORDER = ["conv_id", "turn", "role", "text", "copy"]
_FACTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


# -- alignment ------------------------------------------------------------------------
def _due(target: str, j: int) -> str:
    """Letter j of the target that begins with s, u or a."""
    if target == "s":
        return "s" if j == 0 else "ua"[(j - 1) % 2]
    return "ua"[j % 2] if target == "u" else "au"[j % 2]


def _greedy(codes: str, target: str) -> int:
    """The cost of an alignment that only keeps, reroles and deletes."""
    cost = j = 0
    for c in codes:
        due, low = _due(target, j), c.lower()
        if c == "d" or (due == "s" and low != "s"):
            cost += DELETE
            continue
        cost += (low != due) * REROLE + (c != low) * TRUNCATED
        j += 1
    return cost


def align(codes: str, target: str) -> dict[int, tuple[int, str]]:
    """Length -> cost and audit of the best alignment of all turns to so much of the target.

    ``codes``: s, u, a, x (another role) for each turn, upper case if truncated, d if it must be
    deleted.  The last edit consumes the last turn; insertions after it are the next block's.
    """
    bound = _greedy(codes, target) + SLACK
    less, more = bound // DELETE, bound // INSERT
    row: dict[int, tuple[int, str]] = {0: (0, "")}
    for i, c in enumerate(codes):
        low, cut = c.lower(), (c != c.lower()) * TRUNCATED
        new: dict[int, tuple[int, str]] = {}
        before = None  # the cell to the left, insertions included
        for j in range(max(0, i - less), i + more + 1):
            cell = row.get(j)
            if before is not None and _due(target, j - 1) != "s":
                put = (before[0] + INSERT, before[1] + "I")
                cell = put if cell is None or put < cell else cell
            if cell is not None and cell[0] > bound:
                cell = None
            if cell is not None:
                gone = (cell[0] + DELETE, cell[1] + "D")
                if gone[0] <= bound and (j not in new or gone < new[j]):
                    new[j] = gone
                due = _due(target, j)
                if c != "d" and (low == due or due != "s"):
                    kept = (cell[0] + cut, cell[1] + "K") if low == due else (cell[0] + REROLE + cut, cell[1] + "R")
                    if kept[0] <= bound and (j + 1 not in new or kept < new[j + 1]):
                        new[j + 1] = kept
            before = cell
        row = new
    return row


def _exit(state: int, target: str, length: int) -> int:
    if not length:
        return state
    if target == "s":
        return OPENED if length == 1 else (USER if length % 2 else ASSISTANT)
    return ASSISTANT if (length % 2 == 1) == (target == "u") else USER


@lru_cache(maxsize=1 << 14)
def block_paths(codes: str, entries: tuple[int, ...]) -> tuple[tuple[int, int, int, str], ...]:
    """(state before, state after, cost, audit): the best of all lengths that lead from one to the other."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for target, starts in (("s", (EMPTY,)), ("u", (EMPTY, OPENED, USER)), ("a", (ASSISTANT,))):
        starts = tuple(s for s in starts if s in entries)
        if not starts:
            continue
        for length, found in align(codes, target).items():
            for s in starts:
                key = (s, _exit(s, target, length))
                if key not in best or found < best[key]:
                    best[key] = found
    return tuple((s, e, *found) for (s, e), found in sorted(best.items()))


def _step(states: dict[int, tuple[int, tuple]], paths) -> dict[int, tuple[int, tuple]]:
    """States after a block: cost and the audits of the blocks so far."""
    out: dict[int, tuple[int, tuple]] = {}
    for s, e, cost, audit in paths:
        if s in states:
            new = (states[s][0] + cost, (*states[s][1], audit))
            if e not in out or new < out[e]:
                out[e] = new
    return out


ALL_STATES = (EMPTY, OPENED, USER, ASSISTANT)


def best_audit(codes: str, block: int = BLOCK) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    states: dict[int, tuple[int, tuple]] = {EMPTY: (0, ())}
    for a in range(0, len(codes), block):
        piece = codes[a : a + block]
        moved = _step(states, block_paths(piece, (EMPTY,) if a == 0 else ALL_STATES))
        states = {s: (cost, ("".join(parts),)) for s, (cost, parts) in moved.items()}
    return min((cost + INSERT * len(TAILS[s]), "".join(parts) + TAILS[s]) for s, (cost, parts) in states.items())


# -- turns ----------------------------------------------------------------------------
_WORD = re.compile(rf"[^{SPACES}]")


def code_of(role: str, text: str) -> str:
    """b for blank; else the role's class, upper case if the text is truncated."""
    if not _WORD.search(text):
        return "b"
    c = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return c if text.rstrip(_SPACE)[-1] in ".!?" else c.upper()


def applied(turns, audit: str, state: int) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that an audit leaves, from a state of the grammar on."""
    rows = iter(turns)
    for edit in audit:
        if edit == "D":
            next(rows)
            continue
        role, text = next(rows) if edit != "I" else (None, "")
        if edit == "K" and state == EMPTY and role[:1] == "s":
            state = OPENED
        else:
            if edit != "K":
                role = ROLES["a" if state == ASSISTANT else "u"]
            state = USER if state == ASSISTANT else ASSISTANT
        yield edit, role, text


class _Turns:
    """One conversation as its turns stream past."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.numbers, self.bytes = conv_id, [], [], 0

    def add(self, turn, role: str, text: str) -> None:
        self.turns.append((role, text))
        self.numbers.append(turn)
        self.bytes += len(text) + 64

    def facts(self) -> tuple[dict[str, int], str]:
        """gaps, blank, duplicate, truncated, illegal, cost; and the audit."""
        seen, codes, count = set(), [], {"b": 0, "d": 0, "t": 0}
        for turn in self.turns:
            c = code_of(*turn)
            if c == "b":
                count["b"] += 1
            elif turn in seen:
                count["d"] += 1
                c = "d"
            elif c.isupper():
                count["t"] += 1
            seen.add(turn)
            codes.append("d" if c == "b" else c)
        cost, audit = best_audit("".join(codes))
        known = {n for n in self.numbers if n is not None}
        initials = [role[:1] for role, _ in self.turns]
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        return dict(zip(_FACTS, (gaps, count["b"], count["d"], count["t"], illegal, cost), strict=True)), audit


def digest(repaired) -> str:
    """SHA-256 of ``role:text`` of the turns, joined by line feeds."""
    h, first = hashlib.sha256(), True
    for _, role, text in repaired:
        h.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        first = False
    return h.hexdigest()


# -- conversations inside a partition ----------------------------------------------------
def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Turns, bool]]:
    """Each conversation of the sorted rows, and whether it is only named here (first, last, or too long to hold)."""
    now, named, first = None, False, True
    for batch in batches:
        for conv_id, turn, role, text, gone in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone")], strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    yield now, named
                    first = False
                now, named = _Turns(conv_id), first
            if gone or named:
                continue
            now.add(turn, role, text)
            if now.bytes > HELD_BYTES:
                now, named = _Turns(conv_id), True
    if now is not None:
        yield now, True


_WHOLE = "edge boolean, " + _RESULT
_TURN = "conv_id long, position long, edit string, role string, text string"


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["edge", "conv_id", *_FACTS, "audit", "repaired_sha256"]
    types = [pa.bool_(), pa.int64(), *[pa.int64()] * len(_FACTS), pa.string(), pa.string()]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    rows = []
    for conv, edge in _conversations(batches):
        if edge:
            rows.append((True, conv.conv_id, *[None] * (len(_FACTS) + 2)))
        else:
            facts, audit = conv.facts()
            rows.append((False, conv.conv_id, *facts.values(), audit, digest(applied(conv.turns, audit, EMPTY))))
        if len(rows) >= 4096:
            yield out(rows)
            rows = []
    if rows:
        yield out(rows)


def _whole_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for conv, edge in _conversations(batches):
        if edge:
            continue
        done = list(applied(conv.turns, conv.facts()[1], EMPTY))
        if done:
            yield _turn_batch([(conv.conv_id, k, *x) for k, x in enumerate(done)])


def _turn_batch(rows) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["conv_id", "position", "edit", "role", "text"])


# -- conversations in blocks --------------------------------------------------------------
_RUNS = "conv_id long, run long, i long, turn long, role string, text string, code string"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted rows with their partition's number, their place in it, and the code of the turn."""
    run, i = TaskContext.get().partitionId(), 0
    for batch in batches:
        roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array([run] * n, pa.int64()), pa.array(range(i, i + n), pa.int64()), batch.column("turn"), batch.column("role"), batch.column("text"),
             pa.array([code_of(r, t) for r, t in zip(roles, texts, strict=True)], pa.string())],
            names=["conv_id", "run", "i", "turn", "role", "text", "code"])
        i += n


_PATHS = ("conv_id long, run long, block long, initials string, blank long, duplicate long, truncated long, illegal long, "
          "paths array<struct<entry:int,exit:int,cost:long,audit:string>>")  # fmt: skip


def _paths(key: tuple, rows: pa.Table) -> pa.Table:
    """One block: its paths, its counts, and its first and last initial."""
    rows = sorted(zip(*[rows[c].to_pylist() for c in ("i", "code", "dup", "initial")], strict=True))
    codes = ["d" if c == "b" or dup else c for _, c, dup, _ in rows]
    marks = [x[3] for x in rows]
    conv, run, block = (k.as_py() for k in key)
    blank = sum(c == "b" for _, c, _, _ in rows)
    dups = sum(dup and c != "b" for _, c, dup, _ in rows)
    paths = [dict(zip(("entry", "exit", "cost", "audit"), p, strict=True)) for p in block_paths("".join(codes), ALL_STATES)]
    # initials as code points, or a space where there is none; two characters always
    ends = "".join(m or " " for m in (marks[0], marks[-1]))
    one = [conv, run, block, ends, blank, dups, sum(c.isupper() for c in codes), sum(a + b not in LEGAL for a, b in zip(marks, marks[1:], strict=False)), paths]
    kinds = [pa.int64()] * 3 + [pa.string()] + [pa.int64()] * 4 + [pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))]
    names = ["conv_id", "run", "block", "initials", "blank", "duplicate", "truncated", "illegal", "paths"]
    return pa.table([pa.array([v], t) for v, t in zip(one, kinds, strict=True)], names=names)


_JOINED = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, blocks array<struct<run:long,block:long,entry:int,audit:string,position:long>>"


def _joined(key: tuple, blocks: pa.Table) -> pa.Table:
    """A conversation's audit from the paths of its blocks, and each block's part of it."""
    rows = sorted(blocks.to_pylist(), key=lambda r: (r["run"], r["block"]))
    # where a state came from, block by block: costs and ranks are compared, audits are kept once
    states, came = {EMPTY: (0, 0)}, []
    for r in rows:
        offers: dict[int, list] = {}
        for p in r["paths"]:
            if p["entry"] in states:
                cost, rank = states[p["entry"]]
                offers.setdefault(p["exit"], []).append((cost + p["cost"], rank, p["audit"], p["entry"]))
        best = {s: min(found) for s, found in offers.items()}
        # equal ranks are the same audit so far, so (rank, audit) orders the audits with this block's
        order = sorted({(b[1], b[2]) for b in best.values()})
        came.append({s: (b[3], b[2]) for s, b in best.items()})
        states = {s: (b[0], order.index((b[1], b[2]))) for s, b in best.items()}
    cost, _, tail, end = min((c + INSERT * len(TAILS[s]), rank, TAILS[s], s) for s, (c, rank) in states.items())
    parts, state = [], end
    for r, back in zip(reversed(rows), reversed(came), strict=True):
        entry, audit = back[state]
        parts.append({"run": r["run"], "block": r["block"], "entry": entry, "audit": audit})
        state = entry
    parts.reverse()
    parts[-1]["audit"] += tail
    place = 0
    for p in parts:
        p["position"] = place
        place += len(p["audit"]) - p["audit"].count("D")
    across = sum(a["initials"][1].strip() + b["initials"][0].strip() not in LEGAL for a, b in zip(rows, rows[1:], strict=False))
    one = [key[0].as_py(), *[sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated")], sum(r["illegal"] for r in rows) + across, cost, "".join(p["audit"] for p in parts), parts]
    kinds = [pa.int64()] * 6 + [pa.string(), pa.list_(pa.struct([("run", pa.int64()), ("block", pa.int64()), ("entry", pa.int32()), ("audit", pa.string()), ("position", pa.int64())]))]
    names = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "blocks"]
    return pa.table([pa.array([v], t) for v, t in zip(one, kinds, strict=True)], names=names)


def _repaired_block(rows: pa.Table, parts: pa.Table) -> pa.Table:
    """The turns that a block's part of the audit leaves."""
    if not parts.num_rows:
        return pa.table({"conv_id": pa.array([], pa.int64()), "position": pa.array([], pa.int64()), "edit": pa.array([], pa.string()), "role": pa.array([], pa.string()), "text": pa.array([], pa.string())})
    part = parts.to_pylist()[0]
    turns = [(role, text) for _, role, text in sorted(zip(rows["i"].to_pylist(), rows["role"].to_pylist(), rows["text"].to_pylist(), strict=True))]
    done = [(part["conv_id"], part["position"] + k, *x) for k, x in enumerate(applied(turns, part["audit"], part["entry"]))]
    return pa.Table.from_batches([_turn_batch(done)]) if done else _repaired_block(rows, parts.slice(0, 0))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation of the sorted repaired turns, a batch at a time."""
    now, h = (), None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), pa.array([h.hexdigest()], pa.string())], names=["conv_id", "repaired_sha256"])

    for batch in batches:
        for conv_id, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")], strict=True):
            start = now != (conv_id,)
            if start:
                if now:
                    yield out()
                now, h = (conv_id,), hashlib.sha256()
            h.update(f"{'' if start else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
    if now:
        yield out()


def _sorted(turns: DataFrame) -> DataFrame:
    """Ranged and sorted by conversation, turn, role, text; ranges are cut by the beginning of a text."""
    return turns.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions(*_ORDER)


def _crossing(turns: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """For the named conversations: their facts, their blocks' parts of the audit, their rows, their ids."""
    ids = edges.withColumnRenamed("conv_id", "edge_id")
    picked = turns.join(ids, F.col("conv_id").eqNullSafe(F.col("edge_id")), "left_semi")
    rows = written(_sorted(picked.where(~F.col("gone"))).mapInArrow(_runs, _RUNS), "turns-runs")
    at = F.struct("run", "i")
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    slim = rows.select("conv_id", "run", "i", "code", F.substring("role", 1, 1).alias("initial"), same.alias("same"))
    first = slim.groupBy("conv_id", "same").agg(F.min(at).alias("first")).select(F.col("conv_id").alias("c"), F.col("same").alias("s"), "first")
    slim = slim.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")))
    block = F.floor(F.col("i") / BLOCK).alias("block")
    slim = slim.select("conv_id", "run", block, "i", "code", "initial", (at > F.col("first")).alias("dup"))
    paths = slim.groupBy("conv_id", "run", "block").applyInArrow(_paths, _PATHS)
    joined = written(paths.groupBy("conv_id").applyInArrow(_joined, _JOINED), "turns-joined")
    turn = F.col("turn")
    gaps = rows.groupBy("conv_id").agg(F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).cast("long").alias("gaps"))
    gaps = gaps.withColumnRenamed("conv_id", "g")
    facts = joined.join(gaps, F.col("conv_id").eqNullSafe(F.col("g"))).drop("g", "blocks")
    parts = joined.select("conv_id", F.inline("blocks"))
    return facts, parts, rows.withColumn("block", block), ids


def _block_turns(rows: DataFrame, parts: DataFrame) -> DataFrame:
    keys = ["conv_id", "run", "block"]
    return rows.groupBy(*keys).cogroup(parts.groupBy(*keys)).applyInArrow(_repaired_block, _TURN)


# -- the operator ---------------------------------------------------------------------------
def prepared(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copy, gone from any table of turns; nulls in role and text are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), space("role").alias("role"), space("text").alias("text"), F.lit(0).alias("copy"), F.lit(False).alias("gone"))


def audits(turns: DataFrame) -> DataFrame:
    """One row for each conversation: its faults, the cost and the audit of its repair, the repaired text's SHA-256.

    ``turns`` as ``prepared`` gives them; rows that are ``gone`` only say that there is such a conversation.
    """
    seen = written(_sorted(turns).mapInArrow(_whole, _WHOLE), "turns-whole")
    columns = ["conv_id", *_FACTS, "audit", "repaired_sha256"]
    inside = seen.where(~F.col("edge")).select(*columns)
    facts, parts, rows, ids = _crossing(turns, seen.where("edge").select("conv_id").distinct())
    done = _block_turns(rows, parts)
    hashes = done.repartition("conv_id").sortWithinPartitions("conv_id", "position").mapInArrow(_digests, "h long, repaired_sha256 string").select("h", "repaired_sha256")
    found = facts.join(hashes, F.col("conv_id").eqNullSafe(F.col("h")), "left").withColumnRenamed("conv_id", "f").drop("h")
    crossing = ids.join(found, F.col("edge_id").eqNullSafe(F.col("f")), "left").withColumnRenamed("edge_id", "conv_id")
    nothing = hashlib.sha256(b"").hexdigest()
    return inside.unionByName(crossing.select("conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in _FACTS], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")))


def repaired_turns(turns: DataFrame) -> DataFrame:
    """conv_id, position (from 0), edit (K, R or I), role, text: the repaired conversations."""
    ordered = _sorted(turns)
    edges = ordered.mapInArrow(_whole, _WHOLE).where("edge").select("conv_id").distinct()
    _, parts, rows, _ = _crossing(turns, written(edges, "turns-edges"))
    return ordered.mapInArrow(_whole_turns, _TURN).unionByName(_block_turns(rows, parts))


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by the checksum of ``conv_id:turn``; a dropped row stays as one that is gone."""
    d = prepared(conversations)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))), F.lit(20))
    text = F.when(fate <= 1, F.lit("")).when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(fate == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return d.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"), (fate == 0).alias("gone"))


def repaired(conversations: DataFrame) -> DataFrame:
    """op11: damage and repair of every conversation."""
    return audits(damaged(conversations))


#: The grammar's four states as columns; a value is a cost of nine digits followed by an audit, so the
#: least text is the cheapest audit, ties ASCII-least.
REPAIRED_SQL = r"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS name FROM conversations),
f AS (SELECT *, xor(list_reduce(list_transform(range(1, length(name) + 1), lambda i: ascii(name[i])::BIGINT),
    lambda acc, b: list_reduce(range(8), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END, xor(acc, b)),
    4294967295::BIGINT), 4294967295::BIGINT) % 20 AS fate FROM k),
d AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy FROM f WHERE fate <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
e AS (SELECT conv_id, turn, role, text, i, role[1:1] AS ini,
    coalesce(lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] NOT IN ('su', 'ua', 'au'), false) AS bad,
    regexp_matches(text, '[^\x20\x09-\x0D]') AS worded,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS ended FROM o),
g AS (SELECT *, NOT worded OR again AS must, (worded AND NOT again AND NOT ended)::INT AS cut FROM e),
steps AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, '000000000' AS q0, NULL::VARCHAR AS q1, NULL::VARCHAR AS qu, NULL::VARCHAR AS qa FROM conversations
  UNION ALL
  SELECT conv_id, i,
    printf('%09d', q0[1:9]::BIGINT + 3) || q0[10:] || 'D',
    least(printf('%09d', q1[1:9]::BIGINT + 3) || q1[10:] || 'D',
          CASE WHEN NOT must AND ini = 's' THEN printf('%09d', q0[1:9]::BIGINT + cut) || q0[10:] || 'K' END),
    least(printf('%09d', pu[1:9]::BIGINT + 3) || pu[10:] || 'D',
          CASE WHEN NOT must THEN printf('%09d', pa[1:9]::BIGINT + cut + CASE WHEN ini = 'a' THEN 0 ELSE 2 END) || pa[10:] || CASE WHEN ini = 'a' THEN 'K' ELSE 'R' END END),
    least(printf('%09d', pa[1:9]::BIGINT + 3) || pa[10:] || 'D',
          CASE WHEN NOT must THEN printf('%09d', pq[1:9]::BIGINT + cut + CASE WHEN ini = 'u' THEN 0 ELSE 2 END) || pq[10:] || CASE WHEN ini = 'u' THEN 'K' ELSE 'R' END END)
  FROM (SELECT *, least(q0, q1, pu) AS pq FROM
    (SELECT *, least(qu, printf('%09d', pa[1:9]::BIGINT + 2) || pa[10:] || 'I') AS pu FROM
      (SELECT s.conv_id, g.i, q0, q1, qu, ini, must, cut,
         least(qa, printf('%09d', least(q0, q1, qu)[1:9]::BIGINT + 2) || least(q0, q1, qu)[10:] || 'I') AS pa
       FROM steps s JOIN g ON g.conv_id IS NOT DISTINCT FROM s.conv_id AND g.i = s.i + 1)))),
n AS (SELECT c.conv_id, coalesce(max(g.turn) - min(g.turn) + 1 - count(DISTINCT g.turn), 0) AS gaps, count(*) FILTER (NOT worded) AS blank,
    count(*) FILTER (worded AND again) AS duplicate, coalesce(sum(cut), 0)::BIGINT AS truncated, count(*) FILTER (bad) AS illegal, count(g.i) AS n
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id),
z AS (SELECT n.*, least(q0, qu, printf('%09d', q1[1:9]::BIGINT + 4) || q1[10:] || 'II', printf('%09d', qa[1:9]::BIGINT + 2) || qa[10:] || 'I') AS best
  FROM n JOIN steps s ON s.conv_id IS NOT DISTINCT FROM n.conv_id AND s.i = n.n),
a AS (SELECT conv_id, best[10:] AS audit, unnest(range(1, length(best) - 8)) AS p FROM z),
l AS (SELECT *, audit[p:p] AS edit, count(*) FILTER (audit[p:p] <> 'I') OVER w AS i, count(*) FILTER (audit[p:p] <> 'D') OVER w AS out
  FROM a WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
r AS (SELECT l.*, g.role, g.text, max(CASE WHEN l.out = 1 AND edit = 'K' AND g.ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS shift
  FROM l LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM l.conv_id AND g.i = l.i),
t AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (out - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS hash FROM r WHERE edit <> 'D' GROUP BY conv_id)
SELECT z.conv_id, gaps, blank, duplicate, truncated, illegal, best[1:9]::BIGINT AS cost, best[10:] AS audit, coalesce(hash, sha256('')) AS repaired_sha256
FROM z LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM z.conv_id
"""
