"""Ranked lexical search: exact inner products by best-first search of sparse ball trees.

A document is a sparse vector over the terms of the queries, with the whole number
``(10**9 tf) div (1000 tf + 20 m)`` at each of its terms; a query has the terms' weights. Every task
builds ball trees over blocks of its documents: a node splits its documents between two far
pivots and keeps their centroid c and the largest distance r from it. No document below a node can
score more than ``<q, c> + |q| r``, and none of a leaf more than ``<q, c>`` and the reach of its ball
along each term of the query; a node's bound is at most the largest of its children's. Bounds are taken
in doubles and raised by more than their rounding errors. Nodes are taken best first, and a query
leaves a tree when the best bound left is below the score of its last kept document. Leaves are scored
in 64-bit integers, so ranks are exact. (The plain ball bound alone prunes nothing on prose: documents
share their common words and little else, so all balls are about as wide as the table.)

Documents come in one pass that writes their counts of query terms; lengths and document
frequencies are sums over that table. Queries go in blocks of ``QUERY_BLOCK``; a block's terms,
weights and each task's best rows are all that is held besides one tree.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import LOWER, Roller, chunks, prepare, remove, store

TOP = 50
QUERY_BLOCK = 512
LEAF_ROWS = 32
TREE_ROWS = 1 << 13
TREE_CELLS = 1 << 21
CENTROID_CELLS = 1 << 21
#: Most cells (queries x their terms) of a block of queries, but for a single longer one.
QUERY_CELLS = 1 << 22
#: Stands for a null doc_id inside the search; it comes first among equal scores.
NO_ID = -(1 << 63)
#: Parts in which the best rows of one query are cut down before a single task ranks what is left.
PARTS = 64

TERM = np.zeros(256, bool)
TERM[ord("0") : ord("9") + 1] = TERM[ord("A") : ord("Z") + 1] = TERM[ord("a") : ord("z") + 1] = TERM[0x80:] = True


# -- terms ---------------------------------------------------------------------------------


def term_places(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every term; terms end with their row."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[places] = True
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(places, start, side="right") - 1


class Vocabulary:
    """Numbers of known terms. A hash proposes the term of a place; its bytes decide."""

    def __init__(self, terms: list[bytes]):
        self.terms = terms
        self.roller = Roller()
        data = np.frombuffer(b"".join(terms), np.uint8)
        self.ends = np.cumsum([len(t) for t in terms], dtype=np.int64)
        self.starts = self.ends - np.array([len(t) for t in terms], np.int64)
        self.data = data
        hashes = self.roller.ranges(self.roller.sums(data), self.starts, self.ends)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of each place's term, -1 if unknown. ``data`` is in lower case."""
        out = np.full(len(start), -1, np.int64)
        if len(self.hashes) == 0 or len(start) == 0:
            return out
        hashes = self.roller.ranges(self.roller.sums(data), start, end)
        at = np.searchsorted(self.hashes, hashes, side="left")
        size = end - start
        todo = np.arange(len(start))
        while len(todo):  # more than one step only where two known terms share a hash
            todo = todo[at[todo] < len(self.hashes)]
            todo = todo[self.hashes[at[todo]] == hashes[todo]]
            term = self.order[at[todo]]
            same = self.ends[term] - self.starts[term] == size[todo]
            own, place = term[same], todo[same]
            total = int(size[place].sum())
            if total:
                first = np.cumsum(size[place]) - size[place]
                step = np.arange(total) - np.repeat(first, size[place])
                equal = data[np.repeat(start[place], size[place]) + step] == self.data[np.repeat(self.starts[own], size[place]) + step]
                good = np.logical_and.reduceat(equal, first)
                out[place[good]] = own[good]
            todo = todo[out[todo] < 0]
            at[todo] += 1
        return out


def lowered_terms(text: str | None) -> list[bytes]:
    """Distinct terms of one query, in byte order."""
    data = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    start, end, _ = term_places(data, np.array([0, len(data)]))
    raw = data.tobytes()
    return sorted({raw[a:b] for a, b in zip(start, end)})


def _counts(vocabulary):
    """Length of every document in terms, and its counts of known terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(vocabulary.value)
        for batch in batches:
            for first, end, data, places in chunks(batch.column("text")):
                data = LOWER[data]
                start, stop, row = term_places(data, places)
                n = end - first
                length = np.bincount(row, minlength=n)
                term = known.find(data, start, stop)
                found = term >= 0
                key, tf = np.unique(row[found] * len(known.terms) + term[found], return_counts=True)
                rows, term = np.divmod(key, max(len(known.terms), 1))
                cuts = pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, n), pa.array(length), pa.ListArray.from_arrays(cuts, pa.array(term, pa.int32())), pa.ListArray.from_arrays(cuts, pa.array(tf, pa.int64()))],
                    names=["doc_id", "n", "term", "tf"],
                )

    return run


# -- the tree --------------------------------------------------------------------------------


class BallTree:
    """Ball tree over sparse rows given as (cuts, columns, whole values), with its bounds for ``queries``.

    Distances are taken after each term is scaled by its weight, so that rare terms part documents.
    """

    def __init__(self, cuts: np.ndarray, columns: np.ndarray, values: np.ndarray, queries: np.ndarray):
        self.width = queries.shape[1]
        weight = queries.max(0, initial=0).astype(np.float64)
        self.asked = (queries / np.maximum(weight, 1)).T
        self.length = np.sqrt((self.asked * self.asked).sum(0))
        self.order = np.arange(len(cuts) - 1)
        self.cuts, self.columns, self.values = cuts, columns, values
        self.scaled = values * weight[columns]
        self.squares = self._sums(self.scaled * self.scaled, cuts)
        # A node is (first, end, left, right) over ``order``; leaves have no children.
        self.nodes: list[list[int]] = []
        self._build()
        self._arrange()

    @staticmethod
    def _sums(cells: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Sum of each row, every row by itself, so its rounding is that of its own cells. No row is empty."""
        return np.add.reduceat(cells, cuts[:-1]) if len(cells) else np.zeros(len(cuts) - 1, cells.dtype)

    def _take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = self.cuts[rows + 1] - self.cuts[rows]
        cuts = np.concatenate([[0], np.cumsum(size)])
        cells = np.repeat(self.cuts[rows], size) + np.arange(cuts[-1]) - np.repeat(cuts[:-1], size)
        return cuts, self.columns[cells], self.scaled[cells]

    def _build(self) -> None:
        todo = [(0, len(self.order), -1, 0)]
        centroids, radii, reaches, bounds = [], [], [], []

        def flush() -> None:
            nonlocal centroids, radii, reaches
            if centroids:
                bounds.append(self._bounds(np.array(centroids), np.array(radii), reaches))
                centroids, radii, reaches = [], [], []

        while todo:
            first, end, parent, side = todo.pop()
            rows = self.order[first:end]
            cuts, columns, values = self._take(rows)
            centroid = np.bincount(columns, values, self.width) / max(len(rows), 1)
            product = self._sums(values * centroid[columns], cuts)
            size = float(centroid @ centroid)
            away = self.squares[rows] - 2 * product + size
            # Cancellation leaves an error of a few roundings of the squares; the radius takes it in.
            slack = 1e-9 * (self.squares[rows].max(initial=0.0) + size)
            leaf = end - first <= LEAF_ROWS
            reach = np.zeros(self.width) if leaf else None
            if leaf:
                np.maximum.at(reach, columns, values - centroid[columns])
            centroids.append(centroid)
            reaches.append(reach)
            radii.append(float(np.sqrt(max(away.max(initial=0.0), 0.0) + slack)) * (1 + 1e-12))
            node = len(self.nodes)
            self.nodes.append([first, end, -1, -1])
            if parent >= 0:
                self.nodes[parent][2 + side] = node
            if 2 * len(centroids) * self.width >= CENTROID_CELLS:
                flush()
            if leaf:
                continue
            a = int(np.argmax(away))
            pivot = np.bincount(columns[cuts[a] : cuts[a + 1]], values[cuts[a] : cuts[a + 1]], self.width)
            b = int(np.argmax(self.squares[rows] - 2 * self._sums(values * pivot[columns], cuts)))
            other = np.bincount(columns[cuts[b] : cuts[b + 1]], values[cuts[b] : cuts[b + 1]], self.width)
            along = self._sums(values * (pivot - other)[columns], cuts)
            self.order[first:end] = rows[np.argsort(along, kind="stable")]
            middle = (first + end) // 2
            todo += [(first, middle, node, 0), (middle, end, node, 1)]
        flush()
        #: No row below a node scores more than this (nodes x queries).
        self.bounds = np.concatenate(bounds)
        for node in range(len(self.nodes) - 1, -1, -1):  # children come after their parent
            _, _, left, right = self.nodes[node]
            if left >= 0:
                self.bounds[node] = np.minimum(self.bounds[node], np.maximum(self.bounds[left], self.bounds[right]))

    def _bounds(self, centroids: np.ndarray, radii: np.ndarray, reaches: list) -> np.ndarray:
        middle = centroids @ self.asked
        out = middle + radii[:, None] * self.length[None, :]
        norms = np.sqrt((centroids * centroids).sum(1))
        leaf = [i for i, reach in enumerate(reaches) if reach is not None]
        if leaf:
            along = np.array([reaches[i] for i in leaf])
            out[leaf] = np.minimum(out[leaf], middle[leaf] + along @ self.asked)
            norms[leaf] += np.sqrt((along * along).sum(1))
        # A sum of k products is off by at most k roundings of the lengths' product; this is far more.
        slack = 1e-15 * (16 + 4 * self.width) * norms[:, None] * self.length[None, :]
        return np.floor((out + slack) * (1 + 1e-12)) + 1

    def _arrange(self) -> None:
        """Rows in the order of the leaves."""
        size = (self.cuts[1:] - self.cuts[:-1])[self.order]
        cuts = np.concatenate([[0], np.cumsum(size)])
        cells = np.repeat(self.cuts[self.order], size) + np.arange(cuts[-1]) - np.repeat(cuts[:-1], size)
        self.cuts, self.columns, self.values = cuts, self.columns[cells], self.values[cells]

    def scores(self, first: int, end: int, query: np.ndarray) -> np.ndarray:
        """Exact scores of the rows at places ``first`` to ``end - 1``."""
        a, b = self.cuts[first], self.cuts[end]
        total = np.concatenate([[0], np.cumsum(query[self.columns[a:b]] * self.values[a:b])])
        return total[self.cuts[first + 1 : end + 1] - a] - total[self.cuts[first:end] - a]

    def search(self, query: np.ndarray, bounds: np.ndarray, best: "Best", ids: np.ndarray) -> int:
        """Offer ``best`` every row that can enter it; returns the number of leaves scored."""
        todo, seen = [(-bounds[0], 0)], 0
        while todo:
            bound, node = heapq.heappop(todo)
            if -bound < best.least():
                break
            first, end, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    if bounds[child] >= best.least():
                        heapq.heappush(todo, (-bounds[child], child))
                continue
            seen += 1
            best.offer(self.scores(first, end, query), ids[self.order[first:end]])
        return seen


class Best:
    """The best (score, id) rows of one query so far: higher scores, then smaller ids."""

    def __init__(self, most: int):
        self.most, self.score, self.ids = most, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> int:
        """Rows with a smaller score cannot enter; scores are above 0."""
        return int(self.score[-1]) if len(self.score) == self.most else 1

    def offer(self, score: np.ndarray, ids: np.ndarray) -> None:
        keep = score >= self.least()
        if not keep.any():
            return
        score, ids = np.concatenate([self.score, score[keep]]), np.concatenate([self.ids, ids[keep]])
        order = np.lexsort((ids, -score))[: self.most]
        self.score, self.ids = score[order], ids[order]


def _search(model):
    """Best rows of every query among the documents of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, n_docs, n_terms, most = model.value
        best = [Best(most) for _ in range(len(queries))]
        held: list[tuple] = []
        rows = cells = 0

        def flush() -> None:
            nonlocal held, rows, cells
            if rows:
                ids, n, sizes, term, tf = (np.concatenate(x) for x in zip(*held))
                m = 50 + (50 * n * n_docs) // n_terms
                value = (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, sizes))
                tree = BallTree(np.concatenate([[0], np.cumsum(sizes)]), term, value, queries)
                for q in range(len(queries)):
                    tree.search(queries[q], tree.bounds[:, q], best[q], ids)
            held, rows, cells = [], 0, 0

        for batch in batches:
            terms = batch.column("term")
            sizes = terms.value_lengths().to_numpy().astype(np.int64)
            held.append((batch.column("doc_id").to_numpy(), batch.column("n").to_numpy(), sizes, terms.flatten().to_numpy(), batch.column("tf").flatten().to_numpy()))
            rows, cells = rows + len(sizes), cells + int(sizes.sum())
            if rows >= TREE_ROWS or cells >= TREE_CELLS:
                flush()
        flush()
        for first in range(0, len(best), 64):
            part = best[first : first + 64]
            query = np.repeat(np.arange(first, first + len(part)), [len(b.ids) for b in part])
            if len(query):
                yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(np.concatenate([b.ids for b in part])), pa.array(np.concatenate([b.score for b in part]))], names=["query", "doc_id", "score"])

    return run


def _ranked(spark, docs: DataFrame, items: list, most: int) -> DataFrame:
    """Best documents for one block of (item_id, text) rows."""
    terms = [lowered_terms(text) for _, text in items]
    vocabulary = sorted({t for own in terms for t in own})
    number = {t: i for i, t in enumerate(vocabulary)}
    known = spark.sparkContext.broadcast(vocabulary)
    counts, path = store(docs.mapInArrow(_counts(known), "doc_id long, n long, term array<int>, tf array<long>"), "search-counts")
    n_docs, n_terms = counts.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # At most one row for each term of the block.
    df = np.zeros(len(vocabulary), np.int64)
    for term, n in counts.select(F.explode("term").alias("t")).groupBy("t").count().collect():
        df[term] = n
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    queries = np.zeros((len(items), max(len(vocabulary), 1)), np.int64)
    for q, own in enumerate(terms):
        at = [number[t] for t in own]
        queries[q, at] = weight[at]
    model = spark.sparkContext.broadcast((queries, n_docs, max(n_terms, 1), most))
    found = counts.where(F.size("term") > 0).mapInArrow(_search(model), "query int, doc_id long, score long")
    by = [F.desc("score"), "doc_id"]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
    first = found.withColumn("part", part).withColumn("k", F.row_number().over(Window.partitionBy("query", "part").orderBy(*by))).where(F.col("k") <= most)
    # At most PARTS * most rows for each query.
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*by))).where(F.col("rank") <= most)
    ids = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(items)], "query int, item_id long")
    out, _ = store(last.join(F.broadcast(ids), "query").select("item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score"), "search-ranked")
    remove(spark, path)
    return out


def search(docs: DataFrame, queries: DataFrame, most: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``most`` best documents of every row of ``queries``.

    Only scores above 0 are returned; equal scores are in order of doc_id. Null and empty texts have
    no terms: such documents do not count, such queries return nothing. Repeated documents are each
    ranked; rows of ``queries`` that are wholly equal are one query, others that share an item_id are
    ranked apart under it. A null doc_id comes first among equal scores. Empty tables give an empty
    table. Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = queries.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct().orderBy("item_id", "text")
    out, block, terms = None, [], set()

    def add() -> None:
        nonlocal out, block, terms
        part = _ranked(spark, rows, block, most)
        out, block, terms = part if out is None else out.unionByName(part), [], set()

    for row in asked.toLocalIterator():
        own = terms | set(lowered_terms(row["text"]))
        if block and (len(block) == QUERY_BLOCK or (len(block) + 1) * len(own) > QUERY_CELLS):
            add()
            own = set(lowered_terms(row["text"]))
        block.append((row["item_id"], row["text"]))
        terms = own
    if block or out is None:
        add()
    return out


SEARCH_SQL = rf"""
with d as materialized (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t from documents),
q as materialized (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
total as materialized (select count(*) filter (where len(t) > 0) as n_docs, sum(len(t))::bigint as n_terms from d),
tf as materialized (select doc_id, n, term, count(*) as tf from (select doc_id, len(t)::bigint as n, unnest(t) as term from d) where term in (select term from q) group by 1, 2, 3),
w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as weight from tf, total group by term, n_docs),
scored as (select item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::bigint as score
 from q join tf using (term) join w using (term), total group by 1, 2)
select item_id, rank::int as rank, doc_id, score from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0) where rank <= {TOP}
"""
