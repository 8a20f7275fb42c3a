"""Repair of conversations: every sequence of edits of small conversations, hot and odd rows."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import conversations
from ledgerline.llm.conversations import REPAIR_SQL, repair

SCHEMA = "conv_id long, turn long, role string, text string"
WORKED = {"s": "system", "u": "user", "a": "assistant"}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def digest(text):
    return hashlib.sha256(text.encode()).digest()[:16]


def plain_repair(rows):
    """All edits of one conversation's damaged rows, by memory over (row, state) with whole strings."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), digest(r[3])))
    seen, faults = set(), []
    for _, _, role, text in rows:
        ends = re.findall("[^\x20\x09-\x0d]", text)
        faults.append("b" if not ends else "d" if (role, text) in seen else "t" if ends[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, roles, free):
        """(cost, audit, pieces) from row i; ``roles`` is the last two initials given so far."""
        last = roles[-1:]
        grown = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        options = []
        if i == len(rows):
            if last in ("", "a"):
                options.append((0, "", ()))
        else:
            _, _, role, text = rows[i]
            rest = best(i + 1, roles, 2)
            options.append((4 + rest[0], "D" + rest[1], rest[2]))
            if faults[i] not in ("b", "d"):
                late = 3 if faults[i] == "t" else 0
                if role[:1] in grown and role[:1]:
                    rest = best(i + 1, role[:1], 2)
                    options.append((late + rest[0], "K" + rest[1], (f"{role}:{text}", *rest[2])))
                for x in grown.replace("s", ""):
                    rest = best(i + 1, x, 2)
                    options.append((3 + late + rest[0], "R" + rest[1], (f"{WORKED[x]}:{text}", *rest[2])))
        if free:
            for x in grown.replace("s", ""):
                rest = best(i, x, free - 1)
                options.append((3 + rest[0], "I" + rest[1], (f"{WORKED[x]}:", *rest[2])))
        return min(options, default=(10**9, "", ()))

    cost, audit, pieces = best(0, "", 2) if rows else (0, "", ())
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": faults.count("b"), "duplicate": faults.count("d"),
        "truncated": faults.count("t"), "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(pieces).encode()).hexdigest(),
    }


def made(n, seed):
    rng = random.Random(seed)
    texts = ["", " \t", "Yes.", "No", "Why? ", "ünd so!", "x.\n", None, "Ok"]
    rows = []
    for conv in range(n):
        for i in range(rng.randrange(0, 10)):
            turn = None if rng.random() < 0.06 else i + rng.choice([0, 0, 0, 0, 1, 2])
            text = rng.choice(texts) if rng.random() < 0.7 else f"t{i}."
            rows.append((None if conv == 3 else conv, turn, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "usher"]), text))
    return rows


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], [])
    for row in plain_damage(rows):
        groups[row[0]].append(row)
    return {conv: plain_repair(group) for conv, group in groups.items()}


def result(df):
    out = {}
    for r in df.collect():
        assert r.conv_id not in out
        out[r.conv_id] = {k: v for k, v in r.asDict().items() if k != "conv_id"}
    return out


def test_against_all_edits(spark):
    rows = made(400, 1)
    assert result(repair(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_segments_of_one_conversation(spark, monkeypatch):
    """A conversation with most rows runs through many segments and partitions."""
    monkeypatch.setattr(conversations, "SEGMENT_ROWS", 7)
    rng = random.Random(5)
    hot = [(1, i, rng.choice(["user", "assistant", "assistant", "system", "tool"]), rng.choice([f"t{i}.", f"t{i}", "", "same."])) for i in range(300)]
    rows = made(30, 2) + [(1, 10_000 + r[1], *r[2:]) for r in hot] + [(900, 1, "user", "again.")] * 50
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert result(repair(df)) == expected(rows)


def test_one_row_for_odd_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair(none).count() == 0
    wide = spark.createDataFrame(made(20, 3), SCHEMA).withColumns({"copies": F.lit("x"), "kind": F.lit(1.5), "digest": F.lit(None), "faults": F.lit(7)})
    assert result(repair(wide)) == expected(made(20, 3))
    long = [(5, 0, "user", "a" * 3_000_000 + "."), (5, 1, "assistant", "b! " * 400_000)]
    assert result(repair(spark.createDataFrame(long, SCHEMA))) == expected(long)
    named = spark.createDataFrame([("k", 0, "user", "x.")], "conv_id string, turn int, role string, text string")
    assert repair(named).first().conv_id == "k"


def test_checkpoints_do_not_change_edits():
    rng = random.Random(8)
    for _ in range(200):
        rows = [(rng.choice(["s", "u", "a", ""]), rng.choice([0, 0, 1, 2, 4]), rng.choice([1, 1, 1, 2])) for _ in range(rng.randrange(1, 40))]
        whole, state = conversations.edits(rows, 0, conversations.AT_END, True)
        assert sum(e[1] for e in whole) == conversations.vectors(rows, 0, len(rows), conversations.AT_END)[0][0]
        cut = rng.randrange(len(rows) + 1)
        table = conversations.cost_table(rows[cut:])
        after = tuple(min(table[4 * p + q] + conversations.AT_END[q] for q in range(4)) for p in range(4))
        head, middle = conversations.edits(rows[:cut], 0, after, False)
        tail, _ = conversations.edits(rows[cut:], middle, conversations.AT_END, True)
        if cut < len(rows):
            assert head + tail == whole


def test_sql_twin(spark):
    rows = [r for r in made(120, 4) if r[0] is not None]
    db = duckdb.connect()
    db.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    db.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    found = db.execute(REPAIR_SQL)
    names = [d[0] for d in found.description]
    got = {}
    for row in found.fetchall():
        row = dict(zip(names, row))
        got[row.pop("conv_id")] = row
    assert got == expected(rows)


@pytest.mark.parametrize("rows", [[(1, None, None, None)], [(1, 2, "user", "a."), (1, 2, "user", "a."), (1, 9, "assistant", "b.")]])
def test_null_and_repeated_rows(spark, rows):
    assert result(repair(spark.createDataFrame(rows, SCHEMA))) == expected(rows)
