import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from epicentre.llm import turn_repair as t

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
GRAMMAR = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit, repaired) over state strings, turn by turn: rows are (role, text, must, cut)."""
    start = {"": (0, "", ())}  # by what was put out last: nothing, s, u, a

    def put(have, key, new):
        if key not in have or new[:2] < have[key][:2]:
            have[key] = new

    def insertions(have):
        out = dict(have)
        for _ in range(2):
            for last, (cost, audit, done) in list(out.items()):
                role = "assistant" if last == "u" else "user"
                put(out, role[0], (cost + 2, audit + "I", (*done, (role, ""))))
        return out

    for role, text, must, cut in rows:
        after = {}
        for last, (cost, audit, done) in insertions(start).items():
            put(after, last, (cost + 3, audit + "D", done))
            if must:
                continue
            due = "assistant" if last == "u" else "user"
            if role[:1] == due[0]:
                put(after, due[0], (cost + cut, audit + "K", (*done, (role, text))))
            else:
                put(after, due[0], (cost + cut + 2, audit + "R", (*done, (due, text))))
            if last == "" and role[:1] == "s":
                put(after, "s", (cost + cut, audit + "K", (*done, (role, text))))
        start = after
    return min(v for k, v in insertions(start).items() if k in ("", "a"))


def brute(rows):
    """The contract, row by row."""
    kept, ids = {}, set()
    for conv, turn, role, text in rows:
        ids.add(conv)
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        kept.setdefault(conv, []).extend([(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1))
    out = []
    for conv in ids:
        turns = sorted(kept.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marked, count = set(), [], [0, 0, 0]
        for _, role, text in turns:
            body = text.strip(" \t\n\v\f\r")
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            if fault is not None:
                count[fault] += 1
            marked.append((role, text, fault in (0, 1), int(fault == 2)))
            seen.add((role, text))
        cost, audit, done = cheapest(marked)
        numbers = [n for n, _, _ in turns if n is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        out.append((conv, gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in done).encode()).hexdigest()))
    return sorted(out, key=str)


def made(rng, conv, n):
    """Mostly alternating turns with faults of every kind."""
    rows = []
    for k in range(n):
        role = rng.choice(["system", "user", "assistant", "tool", "", None, "uploader"]) if rng.random() < 0.3 else ("user", "assistant")[k % 2]
        text = rng.choice(["", " \n", None, "Yes.", "no end", "Ünï?\t", f"Turn {k}.", f"turn {k}"])
        rows.append((conv, rng.choice([k, k, k, k // 2, None]), role, text))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


def got(df):
    return sorted((tuple(r) for r in t.repaired(df).collect()), key=str)


def test_alignment_is_the_cheapest_and_least():
    rng = random.Random(1)
    for _ in range(400):
        codes = "".join(rng.choice("suaxSUAXdd") for _ in range(rng.randrange(0, 12)))
        rows = [({"s": "system", "u": "user", "a": "assistant", "x": "tool", "d": "user"}[c.lower()], "", c == "d", int(c.isupper())) for c in codes]
        want = cheapest(rows)
        assert t.best_audit(codes) == want[:2]
        for block in (1, 2, 3, 5):
            assert t.best_audit(codes, block) == want[:2], (codes, block)
        assert [x[1:] for x in t.applied([r[:2] for r in rows], want[1], t.EMPTY)] == [tuple(x) for x in want[2]]


def test_every_audit_of_short_conversations():
    """All edit scripts of up to three turns, by enumeration."""
    for codes in map("".join, itertools.product("suaxUd", repeat=3)):
        best = None
        for edits in itertools.product("DKR", repeat=3):
            for gaps in itertools.product(range(3), repeat=4):
                audit = "".join("I" * g + e for g, e in zip(gaps, (*edits, ""), strict=True))
                cost, marks, at = 0, "", 0
                for e in audit:
                    c = codes[at] if e != "I" else ""
                    at += e != "I"
                    due = "a" if marks[-1:] == "u" else "u"
                    if e == "K":
                        marks += c.lower()
                    elif e != "D":
                        marks += due
                    cost += {"I": 2, "D": 3, "K": 0, "R": 2}[e] + (e in "KR" and c.isupper()) + (1000 if e in "KR" and c == "d" else 0)
                if GRAMMAR.fullmatch(marks) and (best is None or (cost, audit) < best):
                    best = cost, audit
        assert t.best_audit(codes) == best, codes


def test_long_alignment_in_blocks():
    rng = random.Random(2)
    codes = "".join(rng.choice("uauauauasxUAd") for _ in range(700))
    rows = [({"s": "system", "u": "user", "a": "assistant", "x": "tool", "d": "user"}[c.lower()], "", c == "d", int(c.isupper())) for c in codes]
    assert t.best_audit(codes, 64) == t.best_audit(codes) == cheapest(rows)[:2]


def test_matches_brute_force(spark, sf001):
    df = spark.read.parquet(f"{sf001}/conversations.parquet")
    assert got(df) == brute([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])


def test_odd_conversations_over_many_partitions(table, clash, spark):
    rng = random.Random(3)
    rows = [r for c in range(60) for r in made(rng, c, rng.randrange(0, 9))] + made(rng, None, 7) + made(rng, -5, 1)
    rows += rows[5:15]  # repeated rows
    want = brute(rows)
    assert got(clash(table(rows))) == want
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(table(rows)) == want
        turns = t.repaired_turns(t.damaged(table(rows)))
        texts = {}
        for r in sorted(turns.collect(), key=lambda r: (str(r.conv_id), r.position)):
            texts.setdefault(r.conv_id, []).append((r.position, f"{r.role}:{r.text}"))
        for w in want:
            mine = texts.get(w[0], [])
            assert [p for p, _ in mine] == list(range(len(mine)))
            assert hashlib.sha256("\n".join(x for _, x in mine).encode()).hexdigest() == w[-1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_hot_conversation_and_long_texts(table, monkeypatch):
    """One conversation of very many turns, and one whose text is too long to hold in a task."""
    rng = random.Random(4)
    rows = made(rng, 7, 3000) + [(8, k, ("user", "assistant")[k % 2], "word " * 2_000_000 + "end" + "." * (k % 2)) for k in range(8)] + [(9, 0, "user", "hi.")]
    assert got(table(rows)) == brute(rows)


def test_empty_table(table):
    assert got(table([])) == []
    assert t.repaired_turns(t.damaged(table([]))).count() == 0
