"""Repair of damaged conversations by a square-root checkpointed dynamic program.

A conversation is repaired to role initials ``(s?(ua)+)?`` by the cheapest edits of its rows. There
are four states: nothing yet, after s, after u, after a. The vector of a place holds, for each state,
the cost of the cheapest edits of all rows that follow. It is computed backwards; only the vectors at
checkpoints about the square root of the rows apart are kept. The walk forward recomputes one block
of vectors at a time and takes the least letter in ASCII among the edits that keep the cost.

A conversation may hold a third of all rows. Rows are therefore range-partitioned by conversation and
place in it, without their texts: a task holds segments of at most ``SEGMENT_ROWS`` rows. Segments
that may continue in another one are linked by their four-by-four tables of costs (as checkpoints
between segments) and then by the state in which each is entered; both links are streams over one
small row a segment. Texts are shuffled once and meet their edits in order; what a task holds of a
conversation is its running hash and its audit, which is part of the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import prepare, remove, store

SEGMENT_ROWS = 1 << 16
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: Digits of a text's identity among rows: 128 bits of its SHA-256.
DIGEST_BYTES = 16
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: State after the role that an inserted or reroled turn must take.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
#: Cost of what the end of a conversation still needs, by state: an s needs u and a, a u needs a.
AT_END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 60
BLANK, DUPLICATE, CUT = 1, 2, 4
NAME = {AFTER_U: "user", AFTER_A: "assistant"}
KEY = ("conv_id", "turn", "role", "digest")


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) of every row: ``copies`` is 0 for dropped, 2 for repeated rows."""
    part = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(part["conv_id"], F.lit(":"), part["turn"]).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("t", "[.!?]", "")).otherwise(F.col("t"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), part["role"].alias("r"), part["text"].alias("t"), kind.alias("kind")).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("r")).alias("role"), text.alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _digest() -> F.Column:
    return F.substring(F.unhex(F.sha2("text", 256)), 1, DIGEST_BYTES)


# -- the dynamic program on one segment ------------------------------------------------------


def fits(initial: str, state: int) -> int | None:
    """State after a kept row, or None where it may not stand."""
    if initial == "s":
        return AFTER_S if state == START else None
    if initial == "u":
        return AFTER_U if state != AFTER_U else None
    return AFTER_A if initial == "a" and state == AFTER_U else None


STEPS = {initial: tuple(fits(initial, q) for q in range(4)) for initial in ("s", "u", "a", "")}


def vector_before(row: tuple, after: tuple) -> tuple:
    """Costs before a row (initial, faults, copies) from those after it. All copies but the first are duplicates."""
    initial, faults, copies = row
    if faults & (BLANK | DUPLICATE):
        own = [DELETE * copies + after[q] for q in range(4)]
    else:
        late, extra = TRUNCATED if faults & CUT else 0, DELETE * (copies - 1)
        step, own = STEPS[initial], []
        for q in range(4):
            best = min(DELETE + after[q], REROLE + late + after[NEXT[q]])
            if step[q] is not None:
                best = min(best, late + after[step[q]])
            own.append(best + extra)
    once = [min(own[q], INSERT + own[NEXT[q]]) for q in range(4)]
    return tuple(min(once[q], INSERT + once[NEXT[q]]) for q in range(4))


def vectors(rows: list[tuple], first: int, end: int, after: tuple) -> list[tuple]:
    """Vectors before rows ``first`` to ``end - 1`` and the given one after them."""
    out = [after]
    for i in range(end - 1, first - 1, -1):
        out.append(vector_before(rows[i], out[-1]))
    return out[::-1]


def cost_table(rows: list[tuple]) -> list[int]:
    """Cost of a segment by state before and state after (16 numbers)."""
    columns = []
    for state in range(4):
        v = tuple(0 if q == state else FAR for q in range(4))
        for i in range(len(rows) - 1, -1, -1):
            v = vector_before(rows[i], v)
        columns.append(v)
    return [columns[q][p] for p in range(4) for q in range(4)]


def edits(rows: list[tuple], state: int, after: tuple, last: bool) -> tuple[list[tuple], int]:
    """ASCII-least cheapest edits of each row, and the state after them.

    An edit is (audit, cost, roles inserted before, role given or 0 to keep it or None if deleted,
    roles inserted after). Turns are inserted after the last row only where the conversation ends.
    """
    size = isqrt(len(rows)) + 1
    checkpoints, v = {len(rows): after}, after
    for i in range(len(rows) - 1, -1, -1):
        v = vector_before(rows[i], v)
        if i % size == 0:
            checkpoints[i] = v
    out = []
    for first in range(0, len(rows), size):
        end = min(first + size, len(rows))
        block = vectors(rows, first, end, checkpoints[end])
        for i in range(first, end):
            (initial, faults, copies), now, then = rows[i], block[i - first], block[i - first + 1]
            late, extra = TRUNCATED if faults & CUT else 0, DELETE * (copies - 1)
            audit, cost, before = "", 0, []
            while True:
                if now[state] == DELETE * copies + then[state]:
                    audit, cost, given = audit + "D" * copies, cost + DELETE * copies, None
                    break
                if now[state] == INSERT + now[NEXT[state]]:
                    state = NEXT[state]
                    audit, cost = audit + "I", cost + INSERT
                    before.append(NAME[state])
                    continue
                kept = STEPS[initial][state]
                if kept is not None and now[state] == late + extra + then[kept]:
                    state, given, letter, own = kept, 0, "K", late
                else:
                    state, letter, own = NEXT[state], "R", late + REROLE
                    given = NAME[state]
                audit, cost = audit + letter + "D" * (copies - 1), cost + own + extra
                break
            out.append((audit, cost, before, given, []))
    if last and out:
        entered = state
        while AT_END[entered]:
            entered = NEXT[entered]
            audit, cost, before, given, behind = out[-1]
            out[-1] = (audit + "I", cost + INSERT, before, given, [*behind, NAME[entered]])
    return out, state


# -- segments ----------------------------------------------------------------------------------


def _rows(role: list, faults: list, copies: list) -> list[tuple]:
    return [(r[:1] if r[:1] in STEPS else "", f, n) for r, f, n in zip(role, faults, copies)]


SEGMENT_LISTS = ("turn", "role", "digest", "faults", "copies")


def _segments(id_type: pa.DataType):
    """Sorted rows of a partition as segments, one row each. ``open``: may continue in another segment."""
    schema = pa.schema([
        ("conv_id", id_type), ("block", pa.int32()), ("seq", pa.int64()), ("open", pa.bool_()), ("turn", pa.list_(pa.int64())),
        ("role", pa.list_(pa.string())), ("digest", pa.list_(pa.binary())), ("faults", pa.list_(pa.int32())),
        ("copies", pa.list_(pa.int64())), ("costs", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        done: list[dict] = []
        held, seq = 0, 0
        current: dict | None = None

        def close(more: bool) -> None:
            nonlocal current, seq, held
            if current is not None:
                current["open"] = current["open"] or more
                current["costs"] = cost_table(_rows(current["role"], current["faults"], current["copies"])) if current["open"] else None
                done.append(current)
                held += len(current["turn"])
                seq += 1
                current = None

        def flush() -> pa.RecordBatch:
            nonlocal done, held
            out = pa.RecordBatch.from_pylist(done, schema=schema)
            done, held = [], 0
            return out

        ident, started = None, False
        for batch in batches:
            for conv, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", *SEGMENT_LISTS))):
                full = current is not None and len(current["turn"]) >= SEGMENT_ROWS
                if current is None or conv != ident or full:
                    same = current is not None and conv == ident
                    close(same)
                    current = {"conv_id": conv, "block": block, "seq": seq, "open": same or not started, **{c: [] for c in SEGMENT_LISTS}}
                    ident, started = conv, True
                for c, value in zip(SEGMENT_LISTS, row):
                    current[c].append(value)
            if held >= SEGMENT_ROWS:
                yield flush()
        close(True)
        if done:
            yield flush()

    return run


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vector after each open segment. Segments of a conversation come last first."""
    ident, v, begun = None, AT_END, False
    for batch in batches:
        after, last = [], []
        for conv, costs in zip(batch.column("conv_id").to_pylist(), batch.column("costs").to_pylist()):
            fresh = not begun or conv != ident
            if fresh:
                ident, v, begun = conv, AT_END, True
            after.append(list(v))
            last.append(fresh)
            v = tuple(min(costs[4 * p + q] + v[q] for q in range(4)) for p in range(4))
        yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("seq"), pa.array(after, pa.list_(pa.int64())), pa.array(last, pa.bool_())], names=["block", "seq", "after", "last"])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State after each open segment, by the state before it."""
    for batch in batches:
        out = []
        for role, faults, copies, after in zip(*(batch.column(c).to_pylist() for c in ("role", "faults", "copies", "after"))):
            rows = _rows(role, faults, copies)
            out.append([edits(rows, q, tuple(after), False)[1] for q in range(4)])
        names = ["conv_id", "block", "seq"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out, pa.list_(pa.int32()))], names=[*names, "exits"])


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State in which each open segment is entered. Segments of a conversation come in order."""
    ident, state, begun = None, START, False
    for batch in batches:
        entry = []
        for conv, exits in zip(batch.column("conv_id").to_pylist(), batch.column("exits").to_pylist()):
            if not begun or conv != ident:
                ident, state, begun = conv, START, True
            entry.append(state)
            state = exits[state]
        yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("seq"), pa.array(entry, pa.int32())], names=["block", "seq", "entry"])


EDIT_SCHEMA = "turn long, role string, digest binary, kind int, copies long, faults int, audit string, cost long, before array<string>, given string, behind array<string>, text string"


def _solve(id_type: pa.DataType):
    schema = pa.schema([
        ("conv_id", id_type), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary()), ("kind", pa.int32()), ("copies", pa.int64()),
        ("faults", pa.int32()), ("audit", pa.string()), ("cost", pa.int64()), ("before", pa.list_(pa.string())), ("given", pa.string()),
        ("behind", pa.list_(pa.string())), ("text", pa.string()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("conv_id", *SEGMENT_LISTS, "after", "last", "entry")
        for batch in batches:
            for conv, turn, role, digest, faults, copies, after, last, entry in zip(*(batch.column(c).to_pylist() for c in names)):
                found, _ = edits(_rows(role, faults, copies), entry, tuple(after), last)
                n = len(turn)
                audit, cost, before, given, behind = zip(*found)
                given = [r if g == 0 else g for r, g in zip(role, given)]
                columns = [[conv] * n, turn, role, digest, [0] * n, copies, faults, audit, cost, before, given, behind, [None] * n]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


# -- reports -------------------------------------------------------------------------------------


class Report:
    """Running report of one conversation; edits come in order, each before its text."""

    def __init__(self) -> None:
        self.hash, self.empty, self.audit = hashlib.sha256(), True, []
        self.least = self.most = self.turn = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.initial: str | None = None
        self.waiting: str | None = None
        self.behind: list[str] = []

    def _say(self, role: str, text: str) -> None:
        self.hash.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.empty = False

    def edit(self, turn, role, copies, faults, audit, cost, before, given, behind) -> None:
        self.close()
        if turn is not None and turn != self.turn:
            self.least, self.most, self.distinct = turn if self.least is None else self.least, turn, self.distinct + 1
            self.turn = turn
        initial = role[:1]
        self.illegal += (self.initial is not None and self.initial + initial not in ("su", "ua", "au")) + copies - 1
        self.initial = initial
        if faults & BLANK:
            self.blank += copies
        elif faults & DUPLICATE:
            self.duplicate += copies
        else:
            self.duplicate += copies - 1
            self.truncated += bool(faults & CUT)
        self.audit.append(audit)
        self.cost += cost
        for name in before:
            self._say(name, "")
        self.waiting, self.behind = given, behind

    def text(self, text: str) -> None:
        """Text of the row edited last; of repeated rows only the first counts."""
        if self.waiting is not None:
            self._say(self.waiting, text)
            self.waiting = None

    def close(self) -> None:
        for name in self.behind:
            self._say(name, "")
        self.behind = []

    def row(self) -> tuple:
        self.close()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.distinct
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _report(id_type: pa.DataType):
    types = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ident, report = None, None
        names = ("conv_id", "kind", "text", "turn", "role", "copies", "faults", "audit", "cost", "before", "given", "behind")
        for batch in batches:
            out = []
            for conv, kind, text, *edit in zip(*(batch.column(c).to_pylist() for c in names)):
                if report is None or conv != ident:
                    if report is not None:
                        out.append((ident, *report.row()))
                    ident, report = conv, Report()
                if kind == 0:
                    report.edit(*edit)
                elif kind == 1:
                    report.text(text)
            if out:
                yield _batch(out)
        if report is not None:
            yield _batch([(ident, *report.row())])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["conv_id", *REPORT])

    return run


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row for each conv_id.

    Null roles and texts count as one space; a null turn comes first; rows without conv_id are one
    conversation, whose conv_id is null. Rows of the same turn are in order of role, then of the
    SHA-256 of their texts; of equal rows all but the first are duplicates. A conversation whose rows
    are all dropped has zeros, an empty audit and the hash of the empty string; an empty table gives
    an empty table. Other columns are not read.
    """
    spark = conversations.sparkSession
    prepare(spark)
    id_name = conversations.select("conv_id").schema[0].dataType.simpleString()
    id_type = pa.int64() if id_name == "bigint" else pa.string() if id_name == "string" else None
    if id_type is None:
        conversations = conversations.withColumn("conv_id", F.col("conv_id").cast("bigint"))
        id_name, id_type = "bigint", pa.int64()
    rows = damaged(conversations)
    shape = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT).otherwise(0)
    # Equal rows become one with a count before anything is shuffled.
    narrow = rows.where("copies > 0").select("conv_id", "turn", "role", _digest().alias("digest"), shape.alias("shape"), "copies")
    narrow = narrow.groupBy(*KEY).agg(F.max("shape").alias("shape"), F.sum("copies").alias("copies"))
    first = narrow.where(F.col("shape") != BLANK).groupBy("conv_id", "role", "digest").agg(F.max(F.col("turn").isNull()).alias("none"), F.min("turn").alias("least"))
    first = first.select(*[F.col(c).alias(f"f_{c}") for c in ("conv_id", "role", "digest")], F.when(~F.col("none"), F.col("least")).alias("f_turn"))
    # The turn is part of the key, so a text that one conversation repeats all along is no hot key.
    match = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in KEY]
    judged = narrow.join(first, match, "left").withColumn(
        "faults", F.when(F.col("shape") == BLANK, BLANK).when(F.col("f_digest").isNull(), DUPLICATE).otherwise(F.col("shape")).cast("int")
    )
    ordered = judged.select("conv_id", *SEGMENT_LISTS).repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    segments, path = store(
        ordered.mapInArrow(
            _segments(id_type),
            f"conv_id {id_name}, block int, seq long, open boolean, turn array<long>, role array<string>, digest array<binary>, faults array<int>, copies array<long>, costs array<long>",
        ),
        "conversation-segments",
    )
    links = segments.where("open").select("conv_id", "block", "seq", "costs")
    after, after_path = store(
        links.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"), F.desc("seq")).mapInArrow(_backward, "block int, seq long, after array<long>, last boolean"),
        "conversation-after",
    )
    opened = segments.where("open").drop("costs").join(after, ["block", "seq"])
    exits = opened.select("conv_id", "block", "seq", "role", "faults", "copies", "after").mapInArrow(_exits, f"conv_id {id_name}, block int, seq long, exits array<int>")
    entry, entry_path = store(
        exits.repartition("conv_id").sortWithinPartitions("conv_id", "block", "seq").mapInArrow(_forward, "block int, seq long, entry int"), "conversation-entries"
    )
    whole = segments.where("not open").select(
        "conv_id", *SEGMENT_LISTS, F.array(*[F.lit(x).cast("long") for x in AT_END]).alias("after"), F.lit(True).alias("last"), F.lit(START).alias("entry")
    )
    parts = opened.join(entry, ["block", "seq"]).select("conv_id", *SEGMENT_LISTS, "after", "last", "entry")
    found = whole.unionByName(parts).mapInArrow(_solve(id_type), f"conv_id {id_name}, {EDIT_SCHEMA}")
    here = F.col("copies") > 0
    texts = rows.select(
        "conv_id", F.when(here, F.col("turn")).alias("turn"), F.when(here, F.col("role")).alias("role"), F.when(here, _digest()).alias("digest"),
        F.when(here, 1).otherwise(2).alias("kind"), F.when(here, F.col("text")).alias("text"),
    )
    both = found.unionByName(texts, allowMissingColumns=True)
    report = both.repartition("conv_id").sortWithinPartitions(*KEY, "kind").mapInArrow(
        _report(id_type), f"conv_id {id_name}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    )
    report, _ = store(report, "conversation-reports")
    remove(spark, path, after_path, entry_path)
    return report


def _moves_sql() -> str:
    """Edits of one row by state before: letters, initial asked of a kept row, state after, cost, roles inserted and given."""
    rows = []
    for q in range(4):
        n = NEXT[q]
        for inserted, at in (("", q), (NAME[n], n)):
            letter, cost = ("I", INSERT) if inserted else ("", 0)
            rows += [(q, f"{letter}K", i, STEPS[i][at], cost, inserted, "") for i in "sua" if STEPS[i][at] is not None]
            rows.append((q, f"{letter}R", "", NEXT[at], cost + REROLE, inserted, NAME[NEXT[at]]))
    return ", ".join(str(row) for row in rows)


#: The same by a plain forward program that keeps the best edits so far of every state.
REPAIR_SQL = f"""
with recursive crc as materialized (select list(c order by i) as tab from (select i, list_reduce(list_concat([i], range(8)),
  lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as c from range(256) t(i))),
keyed as (select conv_id, turn, coalesce(role, ' ') as r, coalesce(text, ' ') as t, concat(coalesce(conv_id::varchar, ' '), ':', coalesce(turn::varchar, ' ')) as k from conversations),
kinds as (select conv_id, turn, r, t, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(k) + 1), lambda j: ascii(substr(k, j::int, 1))::bigint)),
  lambda a, b: xor(a >> 8, tab[1 + (xor(a, b) & 255)])), 4294967295) % 20 as kind from keyed, crc),
hurt as (select conv_id, turn, kind, case when kind = 4 then 'user' else r end as role,
  case when kind = 1 then '' when kind = 2 then regexp_replace(t, '[.!?]', '', 'g') else t end as text from kinds),
rows_after as (select conv_id, turn, role, text from hurt where kind <> 0 union all select conv_id, turn, role, text from hurt where kind = 3),
placed as materialized (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i from rows_after),
counted as (select *, row_number() over (partition by conv_id, role, text order by i) as seen from placed),
judged as materialized (select *, substr(role, 1, 1) as ini, lag(role) over (partition by conv_id order by i) as prev,
  case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 1 when seen > 1 then 2 when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 4 else 0 end as fault from counted),
moves(st, letters, asked, nst, price, ins, given) as (values {_moves_sql()}),
walk as (select distinct conv_id, 0::bigint as i, 0 as st, {{'c': 0::bigint, 'a': '', 'b': null::varchar}} as s from conversations
 union all select conv_id, i, st, min({{'c': c, 'a': a, 'b': b}}) from (
  select w.conv_id, j.i, w.st, w.s.c + {DELETE} as c, w.s.a || 'D' as a, w.s.b as b from walk w join judged j on j.conv_id is not distinct from w.conv_id and j.i = w.i + 1
  union all select w.conv_id, j.i, m.nst, w.s.c + m.price + case when j.fault = 4 then {TRUNCATED} else 0 end, w.s.a || m.letters,
   concat_ws(chr(10), w.s.b, case when m.ins <> '' then m.ins || ':' end, case when m.given <> '' then m.given else j.role end || ':' || j.text)
  from walk w join judged j on j.conv_id is not distinct from w.conv_id and j.i = w.i + 1 join moves m on m.st = w.st and (m.asked = '' or m.asked = j.ini) where j.fault not in (1, 2)
 ) group by conv_id, i, st),
ends as (select conv_id, i, case st when 1 then {{'c': s.c + {AT_END[1]}, 'a': s.a || 'II', 'b': concat_ws(chr(10), s.b, 'user:', 'assistant:')}}
  when 2 then {{'c': s.c + {AT_END[2]}, 'a': s.a || 'I', 'b': concat_ws(chr(10), s.b, 'assistant:')}} else s end as s from walk),
best as (select e.conv_id, min(s) as s from ends e join (select conv_id, max(i) as n from walk group by 1) x on x.conv_id is not distinct from e.conv_id and x.n = e.i group by 1),
facts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 1) as blank, count(*) filter (where fault = 2) as duplicate,
 count(*) filter (where fault = 4) as truncated, count(*) filter (where prev is not null and substr(prev, 1, 1) || ini not in ('su', 'ua', 'au')) as illegal from judged group by 1)
select b.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
 coalesce(illegal, 0) as illegal, b.s.c as cost, b.s.a as audit, sha256(coalesce(b.s.b, '')) as repaired_sha256
from best b left join facts f on f.conv_id is not distinct from b.conv_id
"""
