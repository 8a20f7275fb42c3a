"""Quality classifier: features and counts by hand, the dual solution, held-out documents, odd tables."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import quality_model as qm

SF = "/root/testdata/sf0.1"


def buffer(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


def plain_grams(text):
    raw = text.encode()
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    words = re.findall(rb"[^\x20\x09-\x0D]+", low)
    grams = {(0, w) for w in words} | {(1, *p) for p in zip(words, words[1:])}
    return grams | {(k, raw[i : i + k]) for k in qm.BYTE_ORDERS for i in range(len(raw) - k + 1)}


def cells_of(texts):
    return [sorted(c.tolist()) for c in qm.Features()(*buffer(texts))]


def test_features_are_the_distinct_ngrams(monkeypatch):
    texts = ["Ab ab  AB", "", "a", "xy zw\nxy zw", "ünï ÜNÏ!", " \t"]
    found = cells_of(texts)
    assert [len(c) for c in found] == [len(plain_grams(t)) for t in texts]  # no two share a cell here
    assert all(len(set(c)) == len(c) for c in found)
    for text, cells in zip(texts, found):
        assert cells_of([text]) == [cells]
    assert set(found[0]) & set(cells_of(["ab"])[0])
    long = "word " * 40 + "a" * 90 + " tail end"
    whole = cells_of([long])
    monkeypatch.setattr(qm, "CHUNK_BYTES", 7)
    assert cells_of([long]) == whole


def test_ratios():
    good, bad = np.array([3.0, 0, 1, 0]), np.array([0.0, 2, 1, 0])
    assert qm.log_ratios(good, bad) == pytest.approx([np.log(4 / 7 / (1 / 6)), np.log(1 / 7 / (3 / 6)), np.log(2 / 7 / (2 / 6)), 0])


def test_dual_descent_reaches_the_optimum(monkeypatch):
    """Primal and dual objectives meet, and the weights are those of the dual variables."""
    rng = np.random.default_rng(3)
    monkeypatch.setattr(qm, "EPOCHS", 2000)
    monkeypatch.setattr(qm, "TOLERANCE", 1e-9)
    values = rng.normal(size=30)
    rows = [np.unique(rng.integers(0, 30, 8)) for _ in range(60)]
    sign = np.where(rng.random(60) < 0.4, -1.0, 1.0)
    z, bias, alpha = qm.dual_descent(rows, sign, values**2)
    x = np.zeros((60, 31))
    for i, r in enumerate(rows):
        x[i, r] = values[r] / np.sqrt((values[r] ** 2).sum())
        x[i, 30] = 1
    w = x.T @ (alpha * sign)
    assert np.allclose(z, w[:30] * values) and bias == pytest.approx(w[30])
    assert ((alpha >= 0) & (alpha <= qm.COST)).all()
    primal = w @ w / 2 + qm.COST * np.maximum(1 - sign * (x @ w), 0).sum()
    assert primal == pytest.approx(alpha.sum() - w @ w / 2, rel=1e-5)


def test_counts_cover_all_rows(spark):
    texts = [("one two", 1, 0), ("two three", 1, 1), ("bad!! two", 0, 0), (None, 0, 1), ("two", 0, 1)]
    df = spark.createDataFrame([(t, g, l, False) for t, g, l in texts], "text string, good long, late long, sampled boolean").repartition(2)
    parts = df.mapInArrow(qm._count, "slice int, packed binary, text string, good long, late long")
    table = {}
    for r in parts.where("slice is not null").select("slice", "packed").repartition("slice").mapInArrow(qm._add, "slice int, packed binary").collect():
        counts = np.frombuffer(r.packed, np.int64).reshape(len(qm.KINDS), -1)
        table |= {r.slice * qm.SLICE_CELLS + int(c): counts[:, c].tolist() for c in np.flatnonzero(counts.any(0))}
    expected = {}
    for text, good, late in texts:
        for cell in cells_of([text or ""])[0]:
            expected.setdefault(cell, [0] * 4)[good + 2 * late] += 1
    assert table == expected


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    values, where = np.unique(score, return_inverse=True)
    rank = (np.cumsum(np.bincount(where)) - (np.bincount(where) - 1) / 2)[where]
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum()) if order.size else 0.5


def test_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = qm.score_quality(docs, labels)
    rows = out.join(labels.select("doc_id", "quality"), "doc_id").where("held_out").toPandas()
    assert all(zlib.crc32(str(d).encode()) % 4 == 2 for d in rows["doc_id"])
    good = rows["quality"].to_numpy() == 1
    print("auc", auc(rows["score"].to_numpy(), good.astype(int)), "kept good", rows["predicted"][good].mean(), "kept bad", rows["predicted"][~good].mean())
    assert auc(rows["score"].to_numpy(), good.astype(int)) > 0.97
    assert rows["predicted"][good].mean() > 0.97 and rows["predicted"][~good].mean() < 0.2
    assert ((rows["score"] >= 0.7) == (rows["predicted"] == 1)).all()


def test_odd_tables(spark):
    schema = "doc_id long, text string"
    texts = [(i, f"plain words here number {i % 7}. And more of them") for i in range(160)] + [(1000 + i, f"JUNK!! *** {i} ### !!") for i in range(60)]
    odd = [(None, "plain words"), (2000, None), (2001, ""), (2002, "plain " * 300_000), (3, "plain words here"), (3, "plain words here")]
    docs = spark.createDataFrame(texts + odd, schema).withColumns({"good": F.lit("x"), "late": F.lit(1), "fold": F.lit(0), "score": F.lit(2), "text2": F.lit("")})
    marks = [(d, int(d < 1000)) for d, _ in texts] + [(2000, 1), (2001, 0), (5, None), (None, 1), (7, 1), (7, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int").withColumn("text", F.lit("t"))
    rows = qm.score_quality(docs, labels).collect()
    assert len(rows) == len(texts) + len(odd)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert min(by[d] for d, _ in texts if d < 1000) > max(by[d] for d, _ in texts if d >= 1000)
    assert by[2000] == by[2001]
    empty = spark.createDataFrame([], schema)
    assert qm.score_quality(empty, labels).count() == 0
    alone = qm.score_quality(docs, labels.where("quality = 1")).collect()
    assert {r.score for r in alone} == {1.0} and {r.predicted for r in alone} == {1}
    assert {r.score for r in qm.score_quality(docs, labels.limit(0)).collect()} == {0.0}
    assert len({r.score for r in qm.score_quality(docs, labels.withColumn("doc_id", F.col("doc_id") + 100_000)).collect()}) == 1
