import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import labels as lb
from ledgerline.params import LabelParams


@pytest.fixture(scope="module")
def records(spark):
    rows = [
        (1, "p1.jpg", ["a", "b"]), (2, "p2.jpg", ["a"]), (3, None, ["a"]), (4, "p4.jpg", None), (5, "p5.jpg", ["c", "zz"]),
        (6, "p6.jpg", ["b"]), (7, "p7.jpg", ["yy"]),
    ]
    return spark.createDataFrame(rows, "id bigint, img_local_path string, themes array<string>")


def test_prune_count_and_tie_at_the_border(records):
    kept = lb.usable(records)
    assert [r.id for r in kept.orderBy("id").collect()] == [1, 2, 5, 6, 7]
    assert [tuple(r) for r in lb.label_counts(kept).collect()] == [("a", 2), ("b", 2), ("c", 1), ("yy", 1), ("zz", 1)]
    assert lb.class_list(kept, 3) == ["a", "b", "c"]


def test_encoding_and_weights(records):
    rows = lb.encode(lb.usable(records), ["a", "b", "c"], "data")
    got = {r.id: r for r in rows.collect()}
    assert got[1].label == [1, 1, 0] and got[7].label == [0, 0, 0] and got[1].full_path == "data/p1.jpg"
    weights = {r.label: r.pos_weight for r in lb.class_weights(rows, ["a", "b", "c"], 1e-5).collect()}
    assert weights["a"] == pytest.approx(3 / (2 + 1e-5)) and weights["c"] == pytest.approx(4 / (1 + 1e-5))
    each = {r.id: r.sample_weight for r in lb.row_weights(rows, 3, 1e-5).collect()}
    assert each[7] == 0.0 and each[5] == pytest.approx(1 / (1 + 1e-5)) and each[1] == pytest.approx(1 / (2 + 1e-5))


def test_resample_draws_in_proportion_and_never_weight_zero(spark, monkeypatch):
    monkeypatch.setattr(lb, "COPY_CHUNK", 50)  # a third of all draws cross many chunks
    rows = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 0.0), (4, 3.0)], "id bigint, w double")
    drawn = lb.weighted_resample(rows, "id", "w", 3000, 1).collect()
    counts = Counter(r.id for r in drawn)
    assert len(drawn) == 3000 and len({r.draw for r in drawn}) == 3000 and 3 not in counts
    assert counts[1] == pytest.approx(500, abs=90) and counts[4] == pytest.approx(1500, abs=120)


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(1, [1, 0], [2.0, -1.0]), (2, [1, 1], [0.0, 3.0]), (3, [0, 0], [5.0, -5.0])]
    df = spark.createDataFrame(rows, "id bigint, label array<int>, scores array<double>")
    return lb.predicted(df, 0.5)


def test_decisions_and_accuracy(scored):
    assert [r.predicted for r in scored.orderBy("id").collect()] == [[1, 0], [0, 1], [1, 0]]
    row = lb.cell_accuracy(scored).first()
    assert row.n_cells == 6 and row.accuracy == pytest.approx(4 / 6)


def test_label_report(scored):
    got = {r.label: r for r in lb.label_report(scored, ["p", "q"]).collect()}
    assert (got["p"].precision, got["p"].recall, got["p"].support) == (0.5, 0.5, 2)
    assert (got["q"].precision, got["q"].recall, got["q"].f1_score) == (1.0, 1.0, 1.0)
    assert got["micro avg"].precision == pytest.approx(2 / 3) and got["macro avg"].f1_score == 0.75
    assert got["weighted avg"].recall == pytest.approx(2 / 3)
    # Records: all right, half right, nothing true.
    assert got["samples avg"].precision == pytest.approx((1 + 1 + 0) / 3)
    assert got["samples avg"].recall == pytest.approx((1 + 0.5 + 0) / 3)


def test_weighted_log_loss(spark, scored):
    weights = spark.createDataFrame([(0, 2.0), (1, 1.0)], "pos int, pos_weight double")
    cells = [(1, 2.0, 2.0), (0, -1.0, 1.0), (1, 0.0, 2.0), (1, 3.0, 1.0), (0, 5.0, 2.0), (0, -5.0, 1.0)]
    want = 0.0
    for truth, score, w in cells:
        p = 1 / (1 + math.exp(-score))
        want -= w * math.log(p) if truth else math.log(1 - p)
    assert lb.weighted_log_loss(scored, weights).first().loss == pytest.approx(want / 6)


def test_argmax_examples(scored):
    got = {r.id: (r.top_label, r.correct, r.true_labels) for r in lb.argmax_examples(scored, ["p", "q"], 1).collect()}
    assert got == {1: ("p", True, "p"), 3: ("p", False, "None (Filtered)")}


def log_of(*epochs):
    """Lines as the training job writes them: two of losses an epoch, with other lines between."""
    lines = ["2031-01-02 03:00:00,000 [INFO] Starting training loop..."]
    for k, (train, val) in enumerate(epochs):
        stamp = f"2031-01-02 {4 + k:02d}:00:00,000 [INFO]"
        lines.append(f"{stamp} Train Loss: {train:.4f} | Train Acc: 0.{10 + k}00")
        lines.append(f"{stamp} Val Loss:   {val:.4f} | Val Acc:   0.{20 + k}00")
        lines.append(f"{stamp} another line")
    return "\n".join(lines) + "\n"


def test_epochs_from_a_log_file(spark, tmp_path):
    from ledgerline.sources.files import read_text_logs

    (tmp_path / "run_a.txt").write_text(log_of((0.9, 0.8), (0.7, 0.3), (0.2, 0.5)))
    (tmp_path / "run_b.txt").write_text(log_of((0.9, 0.8), (0.7, 0.3), (0.2, 0.3)))
    epochs = lb.epoch_metrics(read_text_logs(spark, str(tmp_path)))
    runs = {}
    for r in epochs.orderBy("run_id", "epoch").collect():
        runs.setdefault(r.run_id[-9:], []).append((r.epoch, r.train_loss, r.val_loss, r.best_before, r.improved))
    assert runs["run_a.txt"] == [
        (1, 0.9, 0.8, None, True), (2, 0.7, 0.3, 0.8, True), (3, 0.2, 0.5, 0.3, False)
    ]
    best = {r.run_id[-9:]: (r.best_epoch, r.best_val_loss, r.n_epochs) for r in lb.best_epochs(epochs).collect()}
    assert best == {"run_a.txt": (2, 0.3, 3), "run_b.txt": (2, 0.3, 3)}


def test_split_uses_all_rows(records):
    params = LabelParams(top_labels=2)
    rows, classes = lb.prepare(records, params)
    assert classes == ["a", "b"] and rows.count() == 5
    assert {r.split for r in rows.select(F.col("split")).distinct().collect()} <= {"train", "val", "test"}
