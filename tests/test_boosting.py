"""Boosted trees against a plain loop over every split, derivatives against differences, patience."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.plans import boosting
from ledgerline.plans.boosting import Booster, Loss, Logistic, PseudoHuber, Squared, Tweedie, UnknownLoss, loss_named


def made(n=160, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, n), rng.integers(0, 5, n), rng.integers(0, 2, n)]).astype(float)
    x[rng.random(n) < 0.2, 1] = np.nan
    y = 3.0 * (x[:, 0] > 6) + np.where(np.isnan(x[:, 1]), 2.0, 0.3 * np.nan_to_num(x[:, 1])) * (x[:, 2] + 1) + rng.normal(size=n) * 0.1
    return x, y


def frame(spark, x, y, val=None):
    val = np.zeros(len(y), bool) if val is None else val
    rows = [(i, float(y[i]), bool(val[i]), [None if np.isnan(v) else float(v) for v in x[i]]) for i in range(len(y))]
    return spark.createDataFrame(rows, "id long, y double, val boolean, features array<double>").repartition(3)


def plain_tree(x, g, h, depth, l2, least):
    """Recursion over every cut of every feature, missing values on either side."""
    if depth:
        best = None
        for f in range(x.shape[1]):
            cuts = np.unique(x[~np.isnan(x[:, f]), f])
            for missing_left in (True, False):
                for cut in cuts:
                    left = np.where(np.isnan(x[:, f]), missing_left, x[:, f] <= cut)
                    if h[left].sum() < least or h[~left].sum() < least:
                        continue
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + l2) for s in (left, ~left)) - g.sum() ** 2 / (h.sum() + l2)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, f, cut, missing_left, left)
        if best:
            _, f, cut, missing_left, left = best
            return f, cut, missing_left, plain_tree(x[left], g[left], h[left], depth - 1, l2, least), plain_tree(x[~left], g[~left], h[~left], depth - 1, l2, least)
    return -g.sum() / (h.sum() + l2)


def plain_scores(tree, x):
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, cut, missing_left, left, right = tree
    goes = np.where(np.isnan(x[:, f]), missing_left, x[:, f] <= cut)
    return np.where(goes, plain_scores(left, x), plain_scores(right, x))


@pytest.mark.parametrize("loss", [Squared(), Tweedie(1.5), PseudoHuber()])
def test_same_as_a_plain_booster(spark, monkeypatch, loss):
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 2)
    x, y = made()
    y = np.abs(y) + 0.1
    model = Booster(loss, rounds=5, rate=0.3, depth=3, least_weight=4.0 if isinstance(loss, Squared) else 0.5).fit(frame(spark, x, y))
    assert len(model.trees) == 5
    s = np.full(len(y), model.start)
    for _ in range(5):
        g, h = loss.derivatives(s, y)
        s = s + 0.3 * plain_scores(plain_tree(x, g, h, 3, 1.0, 4.0 if isinstance(loss, Squared) else 0.5), x)
    got = {r.id: r.y_pred for r in model.predict(frame(spark, x, y), ["id"]).collect()}
    assert [got[i] for i in range(len(y))] == pytest.approx(loss.value(s).tolist(), rel=1e-6)
    assert model.start == pytest.approx({Squared: y.mean(), Tweedie: np.log(y.mean())}.get(type(loss), model.start))


@pytest.mark.parametrize("loss", [Squared(), Tweedie(1.3), Tweedie(1.8), PseudoHuber(), Logistic()])
def test_derivatives(loss):
    s, y, e = np.linspace(-2, 2, 9), np.array([0, 1, 0, 1, 1, 0, 1, 0, 1.0]), 1e-5

    def value(t):
        if isinstance(loss, Tweedie):
            return -y * np.exp((1 - loss.power) * t) / (1 - loss.power) + np.exp((2 - loss.power) * t) / (2 - loss.power)
        return (t - y) ** 2 / 2 if isinstance(loss, Squared) else loss.judge(t, y)

    g, h = loss.derivatives(s, y)
    assert g == pytest.approx((value(s + e) - value(s - e)) / (2 * e), abs=1e-5)
    assert h == pytest.approx((loss.derivatives(s + e, y)[0] - loss.derivatives(s - e, y)[0]) / (2 * e), abs=1e-5)


def test_absolute_leaves_are_medians(spark):
    x = np.repeat([[0.0], [1.0]], 51, axis=0)
    y = np.concatenate([np.arange(51.0), 100 + np.arange(51.0) ** 2])
    model = Booster(loss_named("absolute"), rounds=1, rate=1.0, depth=1).fit(frame(spark, x, y))
    got = {r.id: r.y_pred for r in model.predict(frame(spark, x, y), ["id"]).collect()}
    assert got[0] == 25 and got[60] == 100 + 25**2


def test_patience_outlives_a_bad_round(spark, monkeypatch):
    """One worse round does not end the fit; ``patience`` of them do, and the best prefix is kept."""
    x, y = made(200, 3)
    val = np.arange(200) % 4 == 0
    grow, judged = Booster._grow, iter([9.0, 5.0, 6.0, 4.0, 3.0, 3.5, 3.4, 3.3, 3.2, 3.1])
    monkeypatch.setattr(Booster, "_grow", lambda self, *a, **k: (grow(self, *a, **k)[0], next(judged)))
    model = Booster(Squared(), rounds=50, rate=0.3, depth=2, patience=3).fit(frame(spark, x, y, val))
    assert len(model.trees) == 4 and model.history == [9.0, 5.0, 6.0, 4.0, 3.0, 3.5, 3.4, 3.3]
    assert not any(later < 5.0 for later in model.history[1:3])  # stopping at the first worse round would have kept one tree


def test_validation_rows_do_not_grow_trees(spark):
    x, y = made(200, 4)
    val = np.arange(200) % 5 == 0
    wrong = np.where(val, 1e6, y)
    clean = Booster(Squared(), rounds=4, rate=0.3, depth=2).fit(frame(spark, x[~val], y[~val]))
    mixed = Booster(Squared(), rounds=4, rate=0.3, depth=2).fit(frame(spark, x, wrong, val))
    assert [t.value for t in mixed.trees] == [pytest.approx(t.value) for t in clean.trees]
    s = np.full(val.sum(), mixed.start)
    assert mixed.history[0] == pytest.approx(((s - 1e6) ** 2).mean())


def test_samples_repeat_and_cover(spark):
    x, y = made(400, 5)
    one, two = (Booster(Squared(), rounds=3, rate=0.3, depth=2, subsample=0.7, columns=0.67, seed=s).fit(frame(spark, x, y)) for s in (5, 5))
    assert [t.value for t in one.trees] == [pytest.approx(t.value) for t in two.trees]
    used = boosting._mixed(np.random.default_rng(0).integers(-(2**62), 2**62, 20_000), 3)
    assert used.mean() == pytest.approx(0.5, abs=0.02) and (used < 0.7).mean() == pytest.approx(0.7, abs=0.02)


def test_edge_rows(spark):
    schema = "id long, y double, val boolean, features array<double>"
    empty = spark.createDataFrame([], schema)
    model = Booster(Squared(), rounds=2, rate=0.3, depth=2).fit(empty)
    assert model.predict(empty, ["id"]).count() == 0
    alike = spark.createDataFrame([(i, 4.0, False, [None, 1.0]) for i in range(20)], schema)
    model = Booster(Squared(), rounds=2, rate=0.3, depth=2).fit(alike)
    assert {r.y_pred for r in model.predict(alike, ["id"]).collect()} == {4.0}
    with pytest.raises(UnknownLoss):
        loss_named("hinge")
    assert isinstance(loss_named("tweedie", 1.7), Loss)
    new = spark.createDataFrame([(1, 0.0, False, [float("nan"), -5.0])], schema)
    assert model.predict(new.withColumn("more", F.lit(1)), ["id"]).first().y_pred == 4.0


@pytest.mark.parametrize("loss", [Squared(), Tweedie(1.5), Logistic(), loss_named("absolute")])
def test_rounds_of_one_task_are_those_of_many(spark, monkeypatch, loss):
    """Up to TASK_ROWS rows a job grows the trees of a checkpoint; the trees are those of a job per level."""
    x, y = made(300, 6)
    y = (y > 2).astype(float) if isinstance(loss, Logistic) else np.abs(y) + 0.1
    val = np.arange(300) % 4 == 0
    rows = frame(spark, x, y, val)
    booster = Booster(loss, rounds=4, rate=0.3, depth=3, least_weight=0.5, subsample=0.8, columns=0.67, patience=50, seed=3)
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 2)
    jobs, ahead = [], boosting._ahead
    monkeypatch.setattr(boosting, "_ahead", lambda *a: jobs.append(a[-2:]) or ahead(*a))
    here = booster.fit(rows)
    assert jobs == [(0, 2), (2, 4), (4, 5)]  # four rounds and the judgement of the last
    monkeypatch.setattr(boosting, "TASK_ROWS", 100)
    monkeypatch.setattr(boosting, "LEAST_TASK_ROWS", 60)
    spread = booster.fit(rows)
    assert len(jobs) == 3 and len(here.trees) == len(spread.trees) > 0
    assert here.history == pytest.approx(spread.history)
    for a, b in zip(here.trees, spread.trees):
        # Splits that part the rows alike gain the same but for rounding, so the cut may be another.
        assert sorted(a.value) == pytest.approx(sorted(b.value))
