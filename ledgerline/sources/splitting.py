"""JSON arrays and logs read by many tasks, with exact record borders and line numbers.

Spark's text reader cuts files into blocks at byte positions and gives every piece between two
separators to the block in which it starts. For an array the separator is the closing brace. Whether
a brace ends a record depends on everything before it, so a first pass sums each block up: for each
state in which it may begin (outside a string, inside, after a backslash), the state in which it ends, how
deep it goes on balance and how far it closes. One small row per block, chained in the order of the
file, tells where every block begins. The second pass then cuts records; those that run over a
block's end are put together from their pieces, whatever their number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OUTSIDE, INSIDE, ESCAPED = range(3)
CLOSE = "}"
#: A whole string, the beginning of one, or a brace or bracket.
TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*(?:(")|(\\)?\Z)|[{}\[\]]', re.S)
#: The rest of a string that began before: up to its quote, or the end of the piece.
REST = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*(?:(")|(\\)?\Z)', re.S)


def _pieces(spark: SparkSession, path: str, separator: str | None, options: dict[str, str]) -> DataFrame:
    reader = spark.read.options(**options)
    if separator:
        reader = reader.option("lineSep", separator)
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def walk(text: str, state: int) -> tuple[int, int]:
    """State after ``text`` and how much deeper it leads, from a state before it."""
    at, depth = 0, 0
    if state == ESCAPED:
        at, state = min(1, len(text)), INSIDE if text else ESCAPED
    if state == INSIDE:
        rest = REST.match(text, at)
        if rest.group(1) is None:
            return (ESCAPED if rest.group(2) else INSIDE), 0
        at = rest.end()
    elif state == ESCAPED:
        return ESCAPED, 0
    for token in TOKEN.finditer(text, at):
        found = token.group()
        if found[0] == '"':
            if token.group(1) is None:
                return (ESCAPED if token.group(2) else INSIDE), depth
        else:
            depth += 1 if found in "{[" else -1
    return OUTSIDE, depth


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and state before it: state after it, depth gained, and the least depth after a closing brace outside strings."""
    blocks: dict[tuple, list] = {}
    for batch in batches:
        for value, file, block in zip(*(batch.column(c).to_pylist() for c in ("value", "file", "block"))):
            paths = blocks.setdefault((file, block), [[s, 0, 1 << 40] for s in range(3)])
            text = value + CLOSE
            known: dict[int, tuple] = {}
            for path in paths:
                if path[0] not in known:
                    known[path[0]] = walk(text, path[0])
                path[0], gained = known[path[0]]
                path[1] += gained
                if path[0] == OUTSIDE:
                    path[2] = min(path[2], path[1])
    rows = [(f, b, s, *p) for (f, b), paths in blocks.items() for s, p in enumerate(paths)]
    if rows:
        names = ["file", "block", "before", "after", "gained", "least"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)


def block_starts(rows: list) -> dict[tuple, tuple]:
    """(state, depth, first block of an open record or None) at the start of every block, from the summaries."""
    per: dict[tuple, dict] = {}
    for r in rows:
        per.setdefault((r["file"], r["block"]), {})[r["before"]] = (r["after"], r["gained"], r["least"])
    out, last = {}, None
    for file, block in sorted(per):
        if last is None or last[0] != file:
            state, depth, owner = OUTSIDE, 0, None
        else:
            state, depth, before_owner = out[last]
            after, gained, least = per[last][state]
            closed = depth + least <= 1
            state, depth = after, depth + gained
            open_now = state != OUTSIDE or depth > 1
            owner = None if not open_now else before_owner if before_owner is not None and not closed else last[1]
        out[file, block] = (state, depth, owner)
        last = (file, block)
    return out


def _records(starts: dict[tuple, tuple]):
    """Whole records, and the pieces of records that cross a block's end under the block where they begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, list] = {}
        names = ["file", "block", "seq", "owner", "text"]

        def rows(out: list) -> pa.RecordBatch:
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        for batch in batches:
            out = []
            for value, file, block in zip(*(batch.column(c).to_pylist() for c in ("value", "file", "block"))):
                if (file, block) not in states:
                    if (file, block) not in starts:
                        raise RuntimeError("file blocks changed between the two passes; read again")
                    state, depth, owner = starts[file, block]
                    states[file, block] = [state, depth, owner, 0, []]
                now = states[file, block]
                text = value + CLOSE
                now[0], gained = walk(text, now[0])
                now[1] += gained
                now[4].append(text)
                if now[0] == OUTSIDE and now[1] == 1:
                    out.append((file, block, now[3], now[2], "".join(now[4])))
                    now[2], now[3], now[4] = None, now[3] + 1, []
            if out:
                yield rows(out)
        left = [(f, b, now[3], now[2] if now[2] is not None else b, "".join(now[4])) for (f, b), now in states.items() if now[4] and now[1] >= 1]
        if left:
            yield rows([(f, b, -1 if o == b else s, o, t) for f, b, s, o, t in left])

    return run


def read_json_array(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """Records of JSON files that each hold one array of objects, in columns of ``schema``.

    Blocks have the size that Spark gives text files. Rows are as ``spark.read.json`` with ``multiLine``
    returns them: fields not in the schema are left out, absent ones are null. White space and
    line ends may stand anywhere; an empty array or file has no rows. Files must be UTF-8.
    """
    pieces = _pieces(spark, path, CLOSE, options)
    summary = pieces.mapInArrow(_summary, "file string, block long, before long, after long, gained long, least long").collect()
    cut = pieces.mapInArrow(_records(block_starts(summary)), "file string, block long, seq long, owner long, text string")
    whole = cut.where("owner is null").select("text")
    # At most two pieces of a block: what ends a record from before, and what begins the next.
    crossing = (
        cut.where("owner is not null")
        .groupBy("file", "owner")
        .agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts"))
        .select(F.array_join("parts.text", "").alias("text"))
    )
    body = F.regexp_replace("text", r"^[\s,\[\x{FEFF}]+", "")
    found = whole.unionByName(crossing).select(body.alias("text")).where(F.col("text").startswith("{") & F.col("text").endswith(CLOSE))
    return found.select(F.from_json("text", schema).alias("r")).select("r.*")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple, int] = {}
    for batch in batches:
        out = []
        for file, block in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()):
            out.append(counts.get((file, block), 0))
            counts[file, block] = out[-1] + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*batch.schema.names, "place"])


def read_numbered_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(file, line_no, line): lines of text files with their exact number in the file, from 1.

    Lines are counted per block; a line's number is its place in the block plus the lines of the
    blocks before, which are one small row each.
    """
    placed = _pieces(spark, path, None, options).mapInArrow(_numbered, "value string, file string, block long, place long")
    sizes = placed.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n")).collect()
    before, rows = {}, []
    for r in sorted(sizes, key=lambda r: (r["file"], r["block"])):
        rows.append((r["file"], r["block"], before.get(r["file"], 0)))
        before[r["file"]] = rows[-1][2] + r["n"]
    starts = spark.createDataFrame(rows, "file string, block long, before long")
    # One row per file block.
    return placed.join(F.broadcast(starts), ["file", "block"]).select("file", (F.col("before") + F.col("place") + 1).alias("line_no"), F.col("value").alias("line"))
