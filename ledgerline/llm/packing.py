"""Best-fit packing of documents into fixed-length sequences by a grouping genetic algorithm.

A chromosome is a set of bins, not a string of items. Crossover injects whole well-filled bins of
one parent into the other, removes the bins that now hold a document twice, and best-fits the
displaced documents. Shards of a few thousand documents each evolve on several islands; between
epochs the best chromosome of an island migrates to the next. Documents of the bins that stay
poorly filled are dealt into fewer shards and packed again until one shard is left.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import chunks, prepare, remove, store

CAPACITY = 2048
SHARD = 4000
ISLANDS = 3
EPOCHS = 2
GENERATIONS = 3
POPULATION = 4
CACHE_WORDS = 600_000
MARK = "~"
#: Letters of the Latin blocks up to U+024F, then marks.
LETTERS_MARKS = re.compile("([A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?*#$%&]*)")
TOKEN_ID = attrgetter("id")
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, item long"


def _byte_letters() -> dict[int, int]:
    """Byte-level tokenizers write a byte as one letter: printable Latin-1 stands for itself, the others follow from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return dict(zip(sorted(set(range(256)) - own), range(256, 512)))


BYTE_LETTERS = _byte_letters()


def word_ids(tokenizer, words: list[str], known: dict[str, bytes]) -> None:
    """Add the ids of ``words`` to ``known``. The vocabulary is of lower case and no token spans letters
    and marks, so a word of letters with marks after it is looked up in its two parts. Letters of the
    Latin blocks need no normalising beyond NFC and lower case and go to the tokenizer's model alone."""
    model, parts, rest = tokenizer.model, [], set()
    for w in words:
        found = LETTERS_MARKS.fullmatch(w)
        if not found:
            rest.add(w)
            continue
        letters, marks = found.groups()
        letters = letters.lower()
        if letters not in known:
            if letters.isalpha():
                text = letters if letters.isascii() else unicodedata.normalize("NFC", letters).encode().decode("latin-1").translate(BYTE_LETTERS)
                known[letters] = array("I", map(TOKEN_ID, model.tokenize(text))).tobytes()
            else:
                rest.add(letters)
        if marks or letters != w:
            parts.append((w, letters, marks))
            if marks not in known:
                rest.add(marks)
    _encode(tokenizer, [w for w in rest if w not in known], known)
    for w, letters, marks in parts:
        known[w] = known[letters] + known[marks]


def _encode(tokenizer, words: list[str], known: dict[str, bytes]) -> None:
    """Words go to the tokenizer many at a time, apart by a mark of one id of its own; words that hold the mark go alone."""
    mark = tokenizer.encode(MARK, add_special_tokens=False).ids
    plain = [w for w in words if MARK not in w and "<|" not in w] if len(mark) == 1 else []
    for i in range(0, len(plain), 256):
        run = plain[i : i + 256]
        ids = np.array(tokenizer.encode(f" {MARK} ".join(run), add_special_tokens=False).ids, "<u4")
        ends = [*(np.flatnonzero(ids == mark[0]) * 4).tolist(), 4 * len(ids)]
        data, first = ids.tobytes(), 0
        for w, end in zip(run, ends):
            known[w] = data[first:end]
            first = end + 4
    for w in words:
        if w not in known:
            known[w] = np.array(tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes()


def _pieces(vocabulary: str, capacity: int):
    """Token ids of every whole text, cut into pieces of ``capacity`` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        # No token spans white space, so a word's ids never depend on its neighbours.
        known: dict[str, bytes] = {"": b""}
        item = TaskContext.get().partitionId() << 33
        for batch in batches:
            out = ([], [], [], [], [], [])
            for first, end, _, _ in chunks(batch.column("text")):
                part = batch.slice(first, end - first)
                words = [(t or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in part.column("text").to_pylist()]
                if len(known) > CACHE_WORDS:
                    known = {"": b""}
                word_ids(tokenizer, list(set(chain.from_iterable(words)).difference(known)), known)
                for doc, text in zip(part.column("doc_id").to_pylist(), words):
                    ids = b"".join(map(known.__getitem__, text)) + b"\0\0\0\0"
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        for column, value in zip(out, (doc, k, at // 4, len(own) // 4, zlib.crc32(own), item)):
                            column.append(value)
                        item += 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["doc_id", "piece", "start", "length", "ids_crc32", "item"])

    return run


def best_fit(items: list[int], sizes: list[int], bins: list[list[int]], room: list[int], capacity: int) -> None:
    """Put each item into the fullest bin that holds it, or a new one; ``bins`` and ``room`` grow."""
    by_room: dict[int, list[int]] = {}
    present = 0  # bit r: some bin has room r
    for b, r in enumerate(room):
        by_room.setdefault(r, []).append(b)
        present |= 1 << r
    for item in items:
        size = sizes[item]
        above = present >> size
        if above:
            r = size + (above & -above).bit_length() - 1
            same = by_room[r]
            b = same.pop()
            if not same:
                present ^= 1 << r
            bins[b].append(item)
        else:
            r, b = capacity, len(bins)
            bins.append([item])
            room.append(capacity)
        left = r - size
        room[b] = left
        by_room.setdefault(left, []).append(b)
        present |= 1 << left


def labels(bins: list[list[int]], n: int) -> np.ndarray:
    out = np.zeros(n, np.int32)
    for b, own in enumerate(bins):
        out[own] = b
    return out


def fitness(chosen: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the fuller ones (mean squared fill)."""
    fill = np.bincount(chosen, weights=sizes)
    return -len(fill), float(np.mean((fill / capacity) ** 2))


def crossover(one: np.ndarray, two: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Well-filled bins of ``one`` go whole into ``two``; what they displace is best-fitted."""
    n = len(sizes)
    fill = np.bincount(one, weights=sizes) / capacity
    injected = rng.random(len(fill)) < np.where(fill >= np.median(fill), 0.6, 0.1) * rng.uniform(0.3, 1)
    taken = injected[one]
    hit = np.zeros(two.max() + 1, bool)
    hit[two[taken]] = True
    displaced = np.flatnonzero(hit[two] & ~taken)
    stays = ~taken & ~hit[two]
    child = np.full(n, -1, np.int64)
    child[taken] = one[taken]
    child[stays] = two[stays] + len(fill)
    used = np.flatnonzero(child >= 0)
    _, place = np.unique(child[used], return_inverse=True)
    order = np.argsort(place, kind="stable")
    cuts = np.flatnonzero(np.diff(place[order])) + 1
    bins = [list(x) for x in np.split(used[order], cuts)] if len(used) else []
    room = [int(x) for x in capacity - np.bincount(place, weights=sizes[used]).astype(np.int64)] if len(used) else []
    jitter = sizes[displaced] * rng.uniform(0.9, 1.1, len(displaced))
    best_fit([int(x) for x in displaced[np.argsort(-jitter)]], sizes.tolist(), bins, room, capacity)
    return labels(bins, n)


def evolve(sizes: np.ndarray, seeds: list[np.ndarray], capacity: int, seed: int) -> np.ndarray:
    """One epoch on one island; ``seeds`` are chromosomes that came with it."""
    rng = np.random.default_rng(seed)
    people = list(seeds)
    while len(people) < POPULATION:
        noise = 0.0 if not people else 0.05 * len(people)
        bins: list[list[int]] = []
        room: list[int] = []
        best_fit([int(x) for x in np.argsort(-sizes * rng.uniform(1 - noise, 1 + noise, len(sizes)))], sizes.tolist(), bins, room, capacity)
        people.append(labels(bins, len(sizes)))
    scores = [fitness(p, sizes, capacity) for p in people]
    least = -(-int(sizes.sum()) // capacity)
    for _ in range(GENERATIONS):
        if -max(scores)[0] <= least:
            break  # no packing has fewer bins
        for _ in range(POPULATION // 2):
            i, j = rng.choice(len(people), 2, replace=False)
            child = crossover(people[i], people[j], sizes, capacity, rng)
            score = fitness(child, sizes, capacity)
            worst = min(range(len(people)), key=scores.__getitem__)
            if score > scores[worst]:
                people[worst], scores[worst] = child, score
    return people[max(range(len(people)), key=scores.__getitem__)]


def _epoch(capacity: int, epoch: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out: list[tuple] = []
            for shard, island, sizes, own, guest in frame[["shard", "island", "sizes", "own", "guest"]].itertuples(index=False):
                sizes = np.asarray(sizes, np.int64)
                seeds = [np.asarray(x, np.int64) for x in (own, guest) if x is not None]
                best = evolve(sizes, seeds, capacity, hash((int(shard), int(island), epoch)) & 0x7FFFFFFF)
                bins, full = fitness(best, sizes, capacity)
                out.append((shard, island, best.astype(np.int32).tolist(), -bins, full))
            yield pd.DataFrame(out, columns=["shard", "island", "own", "bins", "full"])

    return run


def _pack(items: DataFrame, shards: int, capacity: int, level: int) -> tuple[DataFrame, list[str]]:
    """One level: deal the items into shards, evolve the islands, place the items."""
    spark = items.sparkSession
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(shards)).cast("int"))
    grouped = dealt.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("length", "item", "doc_id", "piece", "start", "ids_crc32"))).alias("items"))
    grouped, p0 = store(grouped, "pack-shards")
    islands = grouped.select("shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.col("items.length").alias("sizes"))
    state = islands.withColumn("own", F.lit(None).cast("array<int>")).withColumn("guest", F.lit(None).cast("array<int>"))
    paths = [p0]
    for epoch in range(EPOCHS):
        evolved, path = store(state.repartition("shard", "island").mapInPandas(_epoch(capacity, epoch), "shard int, island int, own array<int>, bins int, full double"), "pack-epoch")
        paths.append(path)
        guests = evolved.select("shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("own").alias("guest"))
        state = islands.join(evolved.select("shard", "island", "own"), ["shard", "island"]).join(guests, ["shard", "island"])
    best = evolved.groupBy("shard").agg(F.max_by("own", F.struct(-F.col("bins"), "full", -F.col("island"))).alias("own"))
    placed = grouped.join(best, "shard").select("shard", F.explode(F.arrays_zip("items", "own")).alias("x")).select("shard", F.col("x.own").alias("bin"), "x.items.*")
    return placed, paths


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of ``docs``.

    A null or empty text is the single id 0. Repeated rows are packed one by one. Only documents of
    more than ``capacity`` ids are cut. Offsets in a sequence start at 0 without gaps.
    Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces, _ = store(docs.mapInArrow(_pieces(vocabulary, capacity), PIECES), "pack-pieces")
    whole = pieces.where(F.col("length") == capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("item") + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    open_items, level, done = pieces.where(F.col("length") < capacity), 0, [whole]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "item"]
    while True:
        count = open_items.count()
        if not count:
            break
        shards = -(-count // shard)
        placed, paths = _pack(open_items, shards, capacity, level)
        placed, placed_path = store(placed, "pack-placed")
        remove(spark, *paths)
        sequence = F.lit(level << 56) + F.col("shard").cast("long") * F.lit(1 << 24) + F.col("bin")
        if shards == 1:
            closed = placed
        else:
            # Every shard leaves about one bin poorly filled; its emptiest bins are packed again with those of other shards.
            fill = placed.groupBy("shard", "bin").agg(F.sum("length").alias("fill"))
            loose = fill.groupBy("shard").agg(F.min_by(F.col("bin"), F.col("fill")).alias("bin"))
            closed = placed.join(loose, ["shard", "bin"], "left_anti")
            open_items, _ = store(placed.join(loose, ["shard", "bin"], "left_semi").select(*names), "pack-open")
        done.append(
            closed.groupBy(sequence.alias("sequence_id"))
            .agg(F.sort_array(F.collect_list(F.struct("doc_id", "piece", "item", "start", "length", "ids_crc32"))).alias("x"))
            .withColumn("ends", F.expr("aggregate(x, array(0L), (a, y) -> concat(a, array(a[size(a) - 1] + y.length)))"))
            .select("sequence_id", F.posexplode("x").alias("k", "y"), "ends")
            .select("y.doc_id", "y.piece", "y.start", "y.length", "y.ids_crc32", "sequence_id", F.expr("ends[k]").alias("offset"))
        )
        level += 1
        if shards == 1:
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.withColumn("length", F.col("length").cast("long"))
