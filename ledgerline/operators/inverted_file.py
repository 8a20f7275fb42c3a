"""Approximate nearest vectors: inverted lists over trained centroids, product-quantised residuals.

Training sees a sample of bounded size; every item is indexed. An item goes to the list of its nearest
centroid, and what is left of it is stored as one byte per group of dimensions. A query visits its
nearest lists only. Within a list the cosine is estimated by table look-ups: the query's product with
the centroid plus, per group, its product with the byte's code word. The best estimates of each
query are then scored exactly on the vectors themselves, where the list lies: only the k best of a
block go on to the ranking over all lists.

Lists are cut into blocks of bounded size, so a list full of copies is more blocks, and blocks are put
on shelves. A query is sent once to every shelf that holds one of its lists, so what is moved depends on
the number of shelves, not of lists. Packs of queries meet a shelf in an equi-join; its blocks are
decoded once for the whole pack.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import materialise

TRAIN_ROWS = 20_000
LIST_ROWS = 256
MAX_LISTS = 1024
WORDS = 256
GROUP = 4
BLOCK_ROWS = 4096
PACK_ROWS = 2048
#: Items of a shelf, and the shelves there are for each task that can run, if there are enough blocks.
SHELF_ROWS = 32_768
SHELVES_A_TASK = 2
ROUNDS = 12
CHECKED = 400
DIGITS = 9


def unit(matrix: np.ndarray) -> np.ndarray:
    sizes = np.sqrt((matrix * matrix).sum(1))
    return matrix / np.where(sizes > 0, sizes, 1.0)[:, None]


def lloyd(rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centroids of ``rows`` after some rounds of k-means; empty ones are put on random rows."""
    draw = np.random.default_rng(seed)
    centres = rows[draw.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(ROUNDS):
        home = closest(rows, centres)
        count = np.bincount(home, minlength=len(centres))
        for d in range(rows.shape[1]):
            centres[:, d] = np.bincount(home, rows[:, d], len(centres)) / np.maximum(count, 1)
        lost = np.flatnonzero(count == 0)
        centres[lost] = rows[draw.integers(0, len(rows), len(lost))]
    return centres


def closest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    sizes = (centres * centres).sum(1)
    out = [np.argmin(sizes - 2 * rows[i : i + 4096] @ centres.T, 1) for i in range(0, len(rows), 4096)]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


@dataclass
class Codebook:
    centroids: np.ndarray
    words: list[np.ndarray]
    probes: int

    @property
    def groups(self) -> list[slice]:
        width = self.centroids.shape[1]
        return [slice(i, min(i + GROUP, width)) for i in range(0, width, GROUP)]

    def encode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        home = closest(rows, self.centroids)
        rest = rows - self.centroids[home]
        codes = [closest(rest[:, g], w) for g, w in zip(self.groups, self.words)]
        return home, np.column_stack(codes).astype(np.uint8)

    def lists(self, rows: np.ndarray) -> np.ndarray:
        """Nearest lists of each query, nearest first."""
        sizes = (self.centroids * self.centroids).sum(1)
        return np.argsort(sizes - 2 * rows @ self.centroids.T, axis=1, kind="stable")[:, : self.probes]

    def estimates(self, queries: np.ndarray, home: int, codes: np.ndarray) -> np.ndarray:
        """Estimated products of every query with every item of a list, by look-ups."""
        out = np.repeat((queries @ self.centroids[home])[None, :], len(codes), axis=0)
        for i, (g, w) in enumerate(zip(self.groups, self.words)):
            out += (w @ queries[:, g].T)[codes[:, i]]  # whole rows are looked up, one number per query
        out = out.T
        return out


def train(sample: np.ndarray, n_lists: int, k: int, recall: float, seed: int = 3) -> Codebook:
    """Centroids, code words and the number of lists a query visits.

    That is the smallest number for which lists hold ``recall`` of the true ``k`` nearest rows of the
    sample, for some of its rows taken as queries.
    """
    rows = unit(sample)
    book = Codebook(lloyd(rows, n_lists, seed), [], n_lists)
    home = closest(rows, book.centroids)
    rest = rows - book.centroids[home]
    book.words = [lloyd(rest[:, g], WORDS, seed + i) for i, g in enumerate(book.groups)]
    asked = np.random.default_rng(seed).choice(len(rows), min(CHECKED, len(rows)), replace=False)
    near = rows[asked] @ rows.T
    near[np.arange(len(asked)), asked] = -np.inf
    top = np.argsort(-near, axis=1)[:, : min(k, len(rows) - 1)]
    if top.shape[1]:
        book.probes = len(book.centroids)
        place = np.argsort(book.lists(rows[asked]), axis=1)  # list -> its turn
        turn = np.take_along_axis(place, home[top], 1)
        book.probes = int(np.quantile(turn, recall, method="higher")) + 1
    return book


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return unit(flat.reshape(len(column), -1)) if len(column) else np.zeros((0, 1))


def _index(book: Codebook):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                home, codes = book.encode(_vectors(batch.column("vec")))
                packed = pa.array([c.tobytes() for c in codes], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("vec"), pa.array(home.astype(np.int32)), packed], names=["item_id", "vec", "list", "code"])

    return run


def _probe(book: Codebook, held: dict[int, set[int]]):
    """A row per query and shelf, with the lists of the query that the shelf holds."""
    shelf_of = np.zeros((len(book.centroids), 1 + max((max(s) for s in held.values()), default=0)), bool)
    for one, shelves in held.items():
        shelf_of[one, list(shelves)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            lists = book.lists(_vectors(batch.column("vec"))).astype(np.int32)
            row, place, shelf = np.nonzero(shelf_of[lists])
            order = np.lexsort((place, shelf, row))
            row, place, shelf = row[order], place[order], shelf[order]
            starts = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (shelf[1:] != shelf[:-1])]) if len(row) else np.zeros(0, np.int64)
            nested = pa.ListArray.from_arrays(pa.array(np.append(starts, len(row)), pa.int32()), pa.array(lists[row, place]))
            at = pa.array(row[starts])
            yield pa.RecordBatch.from_arrays([batch.column("query_id").take(at), batch.column("vec").take(at), pa.array(shelf[starts].astype(np.int32)), nested], names=["query_id", "vec", "shelf", "lists"])

    return run


def _look_up(book: Codebook, most: int, k: int, exclude_same: bool):
    """The k items of largest cosine among the best estimates of a shelf, for each query of a pack."""

    def best(asked: np.ndarray, queries: np.ndarray, wanted: np.ndarray, home: np.ndarray, ids: np.ndarray, codes: np.ndarray, vectors: np.ndarray):
        near = np.full((len(queries), len(ids)), -np.inf)
        for one in np.unique(home):
            rows, own = np.flatnonzero(wanted[:, one]), np.flatnonzero(home == one)
            if len(rows):
                near[rows, own[0] : own[-1] + 1] = book.estimates(queries[rows], one, codes[own])
        if exclude_same:
            near[asked[:, None] == ids[None, :]] = -np.inf
        keep = min(most, len(ids))
        top = np.argpartition(-near, keep - 1, axis=1)[:, :keep] if keep < len(ids) else np.broadcast_to(np.arange(keep), near.shape)
        value = np.einsum("qd,qcd->qc", queries, vectors[top])
        value[~(np.take_along_axis(near, top, 1) > -np.inf)] = -np.inf
        first = np.lexsort((ids[top], -np.round(value, DIGITS)), axis=1)[:, :k]
        top, value = np.take_along_axis(top, first, 1), np.take_along_axis(value, first, 1)
        good = value.ravel() > -np.inf
        return np.repeat(asked, top.shape[1])[good], ids[top.ravel()][good], value.ravel()[good]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                home = batch.column("homes")[i].values.to_numpy()
                order = np.argsort(home, kind="stable")
                home, ids = home[order], batch.column("ids")[i].values.to_numpy()[order]
                codes = np.frombuffer(b"".join(batch.column("codes")[i].as_py()), np.uint8).reshape(len(ids), -1)[order]
                vectors = _vectors(batch.column("items")[i].values)[order]
                asked, queries = batch.column("asked")[i].values.to_numpy(), _vectors(batch.column("vecs")[i].values)
                lists = batch.column("lists")[i].values
                wanted = np.zeros((len(asked), len(book.centroids)), bool)
                wanted[np.repeat(np.arange(len(asked)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()] = True
                # Bounds the estimates and the numbers of the candidates' vectors held at a time.
                step = max(16, min(256, 4_000_000 // max(len(ids), most * vectors.shape[1])))
                found = [best(asked[j : j + step], queries[j : j + step], wanted[j : j + step], home, ids, codes, vectors) for j in range(0, len(asked), step)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["query_id", "item_id", "value"])

    return run


def approximate_nearest(
    queries: DataFrame, items: DataFrame, k: int, exclude_same: bool = False, recall: float = 0.97, rescored: int = 10, list_rows: int = LIST_ROWS
) -> DataFrame:
    """``query_id, item_id, value, rank``: about the k items of largest cosine of every query.

    ``recall`` is the share of true neighbours that the visited lists should hold; in every block of
    them ``rescored`` times k candidates of each query are scored exactly. Values equal in 9 digits go to the smaller item id.
    Rows without a vector are left out; a zero vector has cosine 0 with all.
    """
    spark = items.sparkSession
    schema = "query_id bigint, item_id bigint, value double, rank int"
    # Vectors travel as they are given; tasks and the final scores work in doubles.
    kind = "float" if all(dict(t.dtypes)["vec"] == "array<float>" for t in (items, queries)) else "double"
    vector = F.col("vec").cast(f"array<{kind}>")
    items = materialise(items.where("vec is not null").select(F.col("item_id").cast("bigint").alias("item_id"), vector.alias("vec")), "items")
    queries = materialise(queries.where("vec is not null").select(F.col("query_id").cast("bigint").alias("query_id"), vector.alias("vec")), "asked")
    n = items.count()
    if not n:
        return spark.createDataFrame([], schema)
    share = min(1.0, TRAIN_ROWS / n)
    drawn = items.where(F.pmod(F.xxhash64("item_id"), F.lit(1 << 30)) <= int(share * (1 << 30))).limit(2 * TRAIN_ROWS).select("vec").toArrow()
    sample = drawn.column("vec").combine_chunks()
    sample = sample.flatten().to_numpy().astype(np.float64).reshape(len(sample), -1)
    book = train(sample, max(1, min(MAX_LISTS, math.ceil(n / list_rows))), k, recall)
    most = rescored * k
    coded = materialise(items.mapInArrow(_index(book), f"item_id bigint, vec array<{kind}>, list int, code binary"), "coded")
    # One row per list, MAX_LISTS at most.
    blocks = {r["list"]: max(1, math.ceil(r["n"] / BLOCK_ROWS)) for r in coded.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = F.broadcast(spark.createDataFrame(list(blocks.items()), "list int, n_blocks int"))
    n_shelves = max(math.ceil(n / SHELF_ROWS), min(sum(blocks.values()), SHELVES_A_TASK * spark.sparkContext.defaultParallelism))
    shelves = (
        coded.join(sizes, "list")
        .withColumn("shelf", F.pmod(F.col("list") + F.pmod(F.xxhash64("item_id"), F.col("n_blocks")), F.lit(n_shelves)).cast("int"))
        .groupBy("shelf")
        .agg(F.collect_list(F.struct("list", "item_id", "code", "vec")).alias("b"))
        .select("shelf", F.col("b.list").alias("homes"), F.col("b.item_id").alias("ids"), F.col("b.code").alias("codes"), F.col("b.vec").alias("items"))
    )
    # The shelves of a list are as many as its blocks; a query goes once to each shelf it needs.
    held = {one: {(one + block) % n_shelves for block in range(count)} for one, count in blocks.items()}
    sent = queries.mapInArrow(_probe(book, held), f"query_id bigint, vec array<{kind}>, shelf int, lists array<int>")
    packs = math.ceil(queries.count() / PACK_ROWS)
    packed = (
        sent.withColumn("pack", F.pmod(F.xxhash64("query_id"), F.lit(max(packs, 1))).cast("int"))
        .repartition("shelf")
        .groupBy("shelf", "pack")
        .agg(F.collect_list(F.struct("query_id", "vec", "lists")).alias("p"))
        .select("shelf", F.col("p.query_id").alias("asked"), F.col("p.vec").alias("vecs"), F.col("p.lists").alias("lists"))
    )
    met = packed.join(shelves, "shelf").select("asked", "vecs", "lists", "homes", "ids", "codes", "items")
    found = met.mapInArrow(_look_up(book, most, k, exclude_same), "query_id bigint, item_id bigint, value double")
    best = Window.partitionBy("query_id").orderBy(F.round("value", DIGITS).desc(), "item_id")
    chosen = found.withColumn("_k", F.row_number().over(best)).where(F.col("_k") <= k).select("query_id", "item_id")

    def size(c: str) -> F.Column:
        return F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))

    asked, given = queries.select("query_id", F.col("vec").cast("array<double>").alias("q")), items.select("item_id", F.col("vec").cast("array<double>").alias("vec"))
    both = chosen.join(asked, "query_id").join(given, "item_id")
    product = F.aggregate(F.zip_with("q", "vec", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    scale = size("q") * size("vec")
    exact = both.select("query_id", "item_id", F.when(scale > 0, product / scale).otherwise(0.0).alias("value"))
    order = Window.partitionBy("query_id").orderBy(F.round("value", DIGITS).desc(), "item_id")
    return exact.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
