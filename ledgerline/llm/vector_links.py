"""Embedding near-duplicates by randomised-rotation binary codes with correction factors.

A unit vector o is rotated at random and reduced to the signs of its components: the code x, a
vertex of the cube. With the stored factor f = <x, o>, the product <x, q> / f is an unbiased
estimate of <o, q> for any unit q, and for <o, q> >= t it stays above
t - c * sqrt(1 - t^2) * sqrt(1 - f^2) / (f * sqrt(d - 1)) but for a share of cases that falls as
exp(-c^2 / 2). Pairs below that bound are dropped; all others are computed anew in double precision.

Candidates come from cross-polytope hashing: of each of ``HASHES`` rotations, the axis nearest to
the vector, in ``TABLES`` tables. A bucket is cut into blocks of bounded size and every two blocks
of a bucket meet in one task, so a bucket of any size is spread. A pair counts in the first table
it shares. Equal vectors are one class and take part once. Tasks send no pairs but link counts and,
for each block pair, one edge per linked row to the smallest row it reaches there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import prepare, store
from ledgerline.llm.links import components

THRESHOLD = 0.95
TABLES = 10
HASHES = 2
CONFIDENCE = 4.0
BLOCK = 1024
BATCH_ROWS = 10_000
SEED = 5


def rotation(size: int, seed: int) -> np.ndarray:
    """Random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (packed signs) and correction factors of unit vectors."""
    turned = vectors @ rotation(vectors.shape[1], SEED)
    signs = turned >= 0
    return np.packbits(signs, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])


def buckets(vectors: np.ndarray) -> np.ndarray:
    """Bucket of each vector in each table."""
    out = np.zeros((len(vectors), TABLES), np.int64)
    size = vectors.shape[1]
    for t in range(TABLES):
        for h in range(HASHES):
            turned = vectors @ rotation(size, 1000 + t * HASHES + h)
            axis = np.abs(turned).argmax(axis=1)
            sign = turned[np.arange(len(vectors)), axis] < 0
            out[:, t] = out[:, t] * (2 * size) + 2 * axis + sign
    return out


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("vec").to_pylist()
        by_size: dict[int, list[int]] = {}
        for i, v in enumerate(lists):
            by_size.setdefault(len(v), []).append(i)
        for size, rows in by_size.items():
            v = np.array([lists[i] for i in rows], np.float64)
            unit = v / np.linalg.norm(v, axis=1, keepdims=True)
            codes, factors = encode(unit)
            places = buckets(unit) + np.int64(size << 40)
            pick = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rep").take(pick), batch.column("copies").take(pick), batch.column("vec").take(pick),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(factors), pa.array(list(places), pa.list_(pa.int64())),
                ],
                names=["rep", "copies", "vec", "code", "factor", "places"],
            )


def near_pairs(one: dict, two: dict, table: int, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the linked pairs between two blocks."""
    size = one["unit"].shape[1]
    signs = (np.unpackbits(one["code"], axis=1)[:, :size].astype(np.float32) * 2 - 1) / np.float32(np.sqrt(size))
    estimate = signs @ two["turned"].T / one["factor"][:, None].astype(np.float32)
    f = one["factor"]
    slack = CONFIDENCE * np.sqrt(1 - threshold**2) * np.sqrt(np.maximum(0, 1 - f**2)) / (f * np.sqrt(max(1, size - 1)))
    i, j = np.nonzero(estimate >= (threshold - slack)[:, None].astype(np.float32))
    if same:
        i, j = i[i < j], j[i < j]
    keep = np.ones(len(i), bool)
    for t in range(table):  # an earlier table has had this pair
        keep &= one["places"][i, t] != two["places"][j, t]
    i, j = i[keep], j[keep]
    exact = np.concatenate([np.einsum("ij,ij->i", one["unit"][i[s : s + 65536]], two["unit"][j[s : s + 65536]]) for s in range(0, len(i), 65536)] or [np.zeros(0)])
    hit = exact >= threshold
    return i[hit], j[hit]


def least_reached(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row number each of ``n`` rows reaches over the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _meet(threshold: float):
    """Compare the blocks of all meetings of a batch; links and roots of the rows that have any."""

    def run(table: pa.Table) -> pa.Table:
        place = table.select(["size", "t", "place", "lo", "hi"]).to_pandas().to_numpy(np.int64)
        order = np.lexsort(place.T[::-1])
        place = place[order]
        table = table.take(pa.array(order))
        starts = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]).any(axis=1)])
        rep, copies, block = (table.column(c).to_numpy() for c in ("rep", "copies", "block"))
        factor, places = table.column("factor").to_numpy(), np.array(table.column("places").to_pylist(), np.int64)
        codes, vectors = table.column("code").to_pylist(), table.column("vec").combine_chunks()
        turn: dict[int, np.ndarray] = {}
        out: list[list[np.ndarray]] = [[], [], []]
        for lo, hi in zip(starts, np.r_[starts[1:], len(order)]):
            size, table_no, _, low, high = place[lo]
            unit = vectors[lo:hi].flatten().to_numpy().reshape(hi - lo, size)
            unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
            if size not in turn:
                turn[size] = rotation(size, SEED)
            own = {
                "unit": unit, "turned": (unit @ turn[size]).astype(np.float32), "factor": factor[lo:hi], "places": places[lo:hi],
                "code": np.frombuffer(b"".join(codes[lo:hi]), np.uint8).reshape(hi - lo, -1),
            }
            a, b = np.flatnonzero(block[lo:hi] == low), np.flatnonzero(block[lo:hi] == high)
            i, j = near_pairs({k: v[a] for k, v in own.items()}, {k: v[b] for k, v in own.items()}, table_no, low == high, threshold)
            if not len(i):
                continue
            i, j, ids, n = a[i], b[j], rep[lo:hi], copies[lo:hi]
            by_id = np.argsort(ids, kind="stable")
            rank = np.empty_like(by_id)
            rank[by_id] = np.arange(len(by_id))
            root = ids[by_id[least_reached(len(ids), rank[i], rank[j])[rank]]]
            links = np.bincount(i, weights=n[j], minlength=len(ids)) + np.bincount(j, weights=n[i], minlength=len(ids))
            for column, value in zip(out, (ids, links.astype(np.int64), root)):
                column.append(value[links > 0])
        flat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        return pa.table(dict(zip(("rep", "links", "root"), flat)))

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors
    of different length. Rows that repeat a vec_id count as vectors of their own. Other columns are not read.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = F.coalesce(~F.exists("vec", bad) & F.exists("vec", lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    rows = rows.withColumn("vec", F.when(good, F.transform("vec", lambda x: x + F.lit(0.0))))
    classes, _ = store(rows.where("vec is not null").groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vector-classes")
    index, _ = store(classes.mapInArrow(_index, "rep long, copies long, vec array<double>, code binary, factor double, places array<long>"), "vector-codes")
    long = index.select("rep", F.posexplode("places").alias("t", "place"))
    # Blocks of a bucket: as many as its rows need; a row's block comes from its id.
    sizes = long.groupBy("t", "place").agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    dealt = long.join(sizes, ["t", "place"]).withColumn("block", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("blocks")).cast("int"))
    meetings = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meetings = meetings.select("rep", "t", "place", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    # Small meetings share a batch; batches hold about BATCH_ROWS rows at any size of the input.
    rows_met = sizes.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0
    batch = F.pmod(F.xxhash64("t", "place", "lo", "hi"), F.lit(rows_met // BATCH_ROWS + 1))
    found, _ = store(
        meetings.join(index, "rep").select("rep", "copies", "vec", F.size("vec").alias("size"), "code", "factor", "places", "t", "place", "block", "lo", "hi", batch.alias("batch"))
        .groupBy("batch").applyInArrow(_meet(threshold), "rep long, links long, root long"),
        "vector-links",
    )
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    whole = classes.join(counts, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    whole = whole.select("vec", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    return rows.join(whole, "vec", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("root", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
