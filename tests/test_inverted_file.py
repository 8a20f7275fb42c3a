"""Approximate search against exact cosine, on given and made-up vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import inverted_file as iv
from ledgerline.operators.neighbours import nearest


def exact(queries, items, k, same=False):
    q, x = iv.unit(queries), iv.unit(items)
    near = np.round(q @ x.T, 9)
    if same:
        np.fill_diagonal(near, -np.inf)
    return [sorted(range(len(x)), key=lambda j: (-near[i, j], j))[:k] for i in range(len(q))]


def frames(spark, queries, items):
    a = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(queries)], "query_id long, vec array<double>")
    b = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(items)], "item_id long, vec array<double>")
    return a, b


def recall(found, wanted):
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, {})[r.rank] = r.item_id
    assert all(sorted(ranks) == list(range(1, len(ranks) + 1)) for ranks in got.values())
    return np.mean([len(set(got.get(i, {}).values()) & set(w)) / len(w) for i, w in enumerate(wanted)])


def test_recall_on_the_given_vectors(spark):
    """At 15 against the exact search that w3_topk_cosine runs."""
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    queries = rows.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vec"))
    items = rows.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vec"))
    found = iv.approximate_nearest(queries, items, 15, exclude_same=True, list_rows=32)
    true = nearest(queries, items, 15, "cosine", exclude_same=True)
    shared = found.select("query_id", "item_id").intersect(true.select("query_id", "item_id")).count()
    share = shared / true.count()
    print("recall", share)
    assert share >= 0.9
    both = found.alias("f").join(true.alias("t"), ["query_id", "item_id"])
    assert both.agg(F.max(F.abs(F.col("f.value") - F.col("t.value")))).first()[0] < 1e-9


@pytest.mark.parametrize("shape", ["even", "clusters", "copies"])
def test_recall_whatever_the_structure(spark, monkeypatch, shape):
    monkeypatch.setattr(iv, "BLOCK_ROWS", 300)
    monkeypatch.setattr(iv, "PACK_ROWS", 16)
    rng = np.random.default_rng(6)
    items = rng.normal(size=(3000, 24))
    if shape == "clusters":
        items = rng.normal(size=(20, 24))[rng.integers(0, 20, 3000)] + 0.3 * rng.normal(size=(3000, 24))
    if shape == "copies":
        items[:1000] = items[0]
    queries = items[rng.choice(3000, 60)] + 0.2 * rng.normal(size=(60, 24))
    found = iv.approximate_nearest(*frames(spark, queries, items), 10, list_rows=100)
    true = exact(queries, items, 10)
    if shape == "copies":  # copies are equal, any ten of them will do
        got = {}
        for r in found.collect():
            got.setdefault(r.query_id, []).append(r.value)
        near = iv.unit(queries) @ iv.unit(items).T
        assert np.mean([np.isclose(sorted(got[i]), np.sort(near[i])[-10:]).mean() for i in range(60)]) >= 0.9
    else:
        assert recall(found, true) >= 0.9


def test_lists_skip_most_items():
    rng = np.random.default_rng(2)
    items = rng.normal(size=(40, 16))[rng.integers(0, 40, 4000)] + 0.2 * rng.normal(size=(4000, 16))
    book = iv.train(items, 40, 10, 0.97)
    assert book.probes <= 12


def test_estimates_are_products_with_the_coded_rows():
    rng = np.random.default_rng(4)
    rows = iv.unit(rng.normal(size=(500, 10)))
    book = iv.train(rows, 5, 5, 0.95)
    home, codes = book.encode(rows)
    coded = np.column_stack([w[codes[:, i]] for i, w in enumerate(book.words)]) + book.centroids[home]
    for h in range(5):
        own = home == h
        assert book.estimates(rows[:7], h, codes[own]) == pytest.approx(rows[:7] @ coded[own].T)
    assert ((rows - coded) ** 2).sum(1).mean() < 0.1


def test_odd_tables(spark):
    empty_q = spark.createDataFrame([], "query_id long, vec array<double>")
    empty_i = spark.createDataFrame([], "item_id long, vec array<double>")
    q, i = frames(spark, [[1, 0], [0, 0]], [[1, 0], [0, 2], [0, 0]])
    assert iv.approximate_nearest(empty_q, i, 3).count() == 0 and iv.approximate_nearest(q, empty_i, 3).count() == 0
    more = i.union(spark.createDataFrame([(9, None)], "item_id long, vec array<double>"))
    got = {(r.query_id, r.rank): (r.item_id, r.value) for r in iv.approximate_nearest(q, more, 5).collect()}
    assert got[0, 1] == (0, 1.0) and [got[1, r] for r in (1, 2, 3)] == [(0, 0.0), (1, 0.0), (2, 0.0)] and len(got) == 6


def test_a_query_goes_once_to_a_shelf():
    """What is sent grows with the shelves, not with the lists a query visits."""
    import pyarrow as pa

    rng = np.random.default_rng(8)
    rows = iv.unit(rng.normal(size=(600, 8)))
    book = iv.train(rows, 30, 10, 0.97)
    held = {one: {(one + block) % 4 for block in range(1 + (one == 3))} for one in range(30)}
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(rows[:20].tolist())], names=["query_id", "vec"])
    sent = [r for b in iv._probe(book, held)(iter([batch])) for r in b.to_pylist()]
    assert len(sent) == len({(r["query_id"], r["shelf"]) for r in sent}) <= 20 * 4
    for i, wanted in enumerate(book.lists(rows[:20])):
        got = sorted((r["shelf"], one) for r in sent if r["query_id"] == i for one in r["lists"])
        assert got == sorted((shelf, one) for one in wanted for shelf in held[one])


@pytest.mark.parametrize("shelf_rows", [50, 32_768])
def test_all_lists_and_candidates_give_the_exact_search(spark, monkeypatch, shelf_rows):
    monkeypatch.setattr(iv, "SHELF_ROWS", shelf_rows)
    monkeypatch.setattr(iv, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(9)
    items = rng.normal(size=(400, 6))
    items[100:200] = items[0]
    found = iv.approximate_nearest(*frames(spark, items[:50], items), 7, exclude_same=True, recall=1.0, rescored=400, list_rows=20).collect()
    got = {(r.query_id, r["rank"]): r.item_id for r in found}
    near = exact(items[:50], items, 8)
    wanted = {i: [j for j in row if j != i][:7] for i, row in enumerate(near)}
    assert np.mean([got[i, n + 1] == j for i, row in wanted.items() for n, j in enumerate(row)]) >= 0.97
