"""Ranked lexical search against plain scoring of every document, and the bounds of the tree."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import ball_tree
from ledgerline.llm.ball_tree import SEARCH_SQL, BallTree, Best, search
from tests.conftest import SMALL

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def plain_search(docs, items, most=50):
    own = [(doc, terms(text)) for doc, text in docs]
    own = [(doc, t) for doc, t in own if t]
    n_docs, n_terms = len(own), sum(len(t) for _, t in own)
    df = Counter(x for _, t in own for x in set(t))
    out = set()
    for item, text in items:
        asked = {x: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) for x in terms(text)}
        found = []
        for doc, t in own:
            m, tf = 50 + (50 * len(t) * n_docs) // n_terms, Counter(t)
            score = sum(w * (10**9 * tf[x] // (1000 * tf[x] + 20 * m)) for x, w in asked.items() if tf[x])
            if score > 0:
                found.append((-score, doc is not None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(found)[:most], 1):
            out.add((item, rank, doc, -score))
    return out


def got(df):
    rows = df.select("item_id", "rank", "doc_id", "score").collect()
    out = {tuple(r) for r in rows}
    assert len(out) == len(rows)
    return out


def made(n, seed):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(30)] + ["Ünï", "ünï", "中文", "A1", "a1"]
    return [(i, " ".join(rng.choice(common) if rng.random() < 0.6 else f"r{rng.randrange(400)}" for _ in range(rng.choice([0, 3, 20, 60])))) for i in range(n)]


def test_against_plain_scoring(spark, monkeypatch):
    monkeypatch.setattr(ball_tree, "TREE_ROWS", 100)
    monkeypatch.setattr(ball_tree, "LEAF_ROWS", 4)
    monkeypatch.setattr(ball_tree, "QUERY_BLOCK", 7)
    docs = made(600, 1)
    items = [(i, text) for i, (_, text) in enumerate(made(20, 2))]
    found = search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert got(found) == plain_search(docs, items)


def test_odd_rows(spark):
    docs = made(60, 3) + [(1000, None), (1001, ""), (1002, " .,;"), (None, "w1 w2 w3"), (5, "w1 w1 w2"), (5, "w1 w1 w2"), (7, "w1 " * 200_000), (8, "x" * 300_000 + " w2")]
    items = [(1, "w1 w2 W3"), (2, None), (3, ""), (4, "nowhere"), (5, "x" * 300_000), (6, "w1"), (6, "w1"), (9, "w1 w1, w2!")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"n": F.lit("a"), "term": F.lit(1), "score": F.lit(2), "rank": F.lit(3)})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({"query": F.lit("z"), "doc_id": F.lit(1)})
    rows = search(df, asked).collect()
    assert Counter(tuple(r) for r in rows) == Counter(
        (item, rank, doc, score) for item, rank, doc, score in plain_search(docs, list(dict.fromkeys(items)))
    )
    none_docs, none_items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert search(none_docs, asked).count() == 0
    assert search(df, none_items).count() == 0


def test_sql_twin(spark):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    names = ["item_id", "rank", "doc_id", "score"]
    twin = {tuple(r) for r in db.execute(f"select {', '.join(names)} from ({SEARCH_SQL})").fetchall()}
    assert twin == got(search(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet")))


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    width, n = 60, 2000
    topic = rng.integers(0, 10, n)
    rows = [np.unique(np.concatenate([topic[i] * 6 + rng.integers(0, 6, 4), rng.integers(0, width, 1)])) for i in range(n)]
    cuts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    columns = np.concatenate(rows).astype(np.int32)
    values = rng.integers(1, 1_000_000, len(columns))
    queries = np.zeros((12, width), np.int64)
    for q in range(12):
        queries[q, (q % 10) * 6 + rng.integers(0, 6, 3)] = rng.integers(1, 20_000, 3)
    tree = BallTree(cuts, columns, values, queries)
    dense = np.zeros((n, width), np.int64)
    dense[np.repeat(np.arange(n), np.diff(cuts)), columns] = values
    exact = dense @ queries.T
    for node, (first, end, _, _) in enumerate(tree.nodes):
        assert (tree.bounds[node] >= exact[tree.order[first:end]].max(0)).all()
        assert (tree.scores(first, end, queries[0]) == exact[tree.order[first:end], 0]).all()
    leaves = sum(left < 0 for _, _, left, _ in tree.nodes)
    seen = []
    for q in range(12):
        best = Best(10)
        seen.append(tree.search(queries[q], tree.bounds[:, q], best, np.arange(n)))
        order = np.lexsort((np.arange(n), -exact[:, q]))[:10]
        assert list(best.ids) == list(order[exact[order, q] > 0]) and list(best.score) == [s for s in exact[order, q] if s > 0]
    assert np.mean(seen) < 0.6 * leaves


def test_hash_collisions_are_decided_by_bytes(monkeypatch):
    known = ball_tree.Vocabulary([b"alpha", b"beta", b"betas", b"gamma"])
    monkeypatch.setattr(known.roller, "ranges", lambda sums, a, b: np.zeros(len(a), np.uint64))
    known.hashes, known.order = np.zeros(4, np.uint64), np.arange(4)
    data = np.frombuffer(b"beta gamma delta betas", np.uint8)
    start, end, _ = ball_tree.term_places(data, np.array([0, len(data)]))
    assert list(known.find(data, start, end)) == [1, 3, -1, 2]
