"""Models on a made-up problem with a known answer."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import diagnostics as dx
from ledgerline.params import ModelParams
from ledgerline.plans import models as md
from ledgerline.plans.boosting import Squared

P = replace(
    ModelParams(), boost_rounds=12, boost_depth=3, boost_rate=0.3, boost_leaf=2, boost_patience=5, deep_rounds=12, deep_depth=3, deep_rate=0.3,
    deep_leaf=2, deep_patience=5, fold_rounds=6, final_rounds=6, forest_trees=8, forest_leaf=5, tree_leaf=10, min_positives=10, folds=2, high_threshold=60.0,
    high_value_thresholds=(0, 60, 500),
)
COLUMNS = ["a", "b", "gap"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(8)
    a, b = draw.normal(size=400), draw.normal(size=400)
    y = np.where(a + 0.3 * draw.normal(size=400) > 0.3, np.round(40 + 30 * a + 10 * b + draw.normal(size=400), 2), 0)
    y = np.maximum(y, 0)
    data = [(i, float(a[i]), float(b[i]), None if i < 50 else 1.0, float(y[i])) for i in range(400)]
    return spark.createDataFrame(data, "cust_id bigint, a double, b double, gap double, y double")


@pytest.fixture(scope="module")
def data(rows):
    return md.ModelData(rows, COLUMNS, "y", params=P)


@pytest.fixture(scope="module")
def mean_mae(data):
    table = md.baseline_results(data.imputed, "y_true")
    return {r.model: r.MAE for r in table.collect()}["A2. Predict mean"]


def mae(scored):
    return dx.evaluate(scored.select("cust_id", "y_true", "y_pred").withColumn("model", F.lit("m"))).first().MAE


def test_model_rows_are_dealt_evenly(rows, monkeypatch):
    monkeypatch.setattr(md, "FILE_ROWS", 40)
    stored = md.ModelData(rows.coalesce(1), COLUMNS, "y", params=P).raw
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name().alias("f")).count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 100 and sum(sizes) == 400


def test_tasks_of_a_level_use_the_cores():
    from ledgerline.plans.boosting import tasks_for

    assert tasks_for(10_000, 12) == 1 and tasks_for(145_000, 12) == 7 and tasks_for(720_000, 12) == 12 and tasks_for(4_300_000, 12) == 24


def test_ridge_equals_closed_form(data):
    train = md.part(data.scaled(), "train").collect()
    x, y = np.array([r.vec for r in train]), np.array([r.y_true for r in train])
    centre = x.mean(0)
    w = np.linalg.solve((x - centre).T @ (x - centre) + P.ridge_alpha * np.eye(x.shape[1]), (x - centre).T @ (y - y.mean()))
    val = {r.cust_id: y.mean() + (np.array(r.vec) - centre) @ w for r in md.part(data.scaled(), "val").collect()}
    got = {r.cust_id: r.y_pred for r in md.ridge(data).collect()}
    assert got.keys() == val.keys()
    assert all(got[k] == pytest.approx(val[k], abs=1e-3) for k in val)


@pytest.mark.parametrize(
    "fit",
    [md.ridge, md.ridge_log, md.decision_tree, md.random_forest, md.knn, md.boosted_absolute, md.boosted_squared, md.boosted_log,
     md.huber, md.hurdle, lambda d: md.tweedie(d, 1.5)],
)
def test_models_beat_the_mean(data, mean_mae, fit):
    scored = fit(data)
    assert scored.count() == md.part(data.imputed, "val").count()
    assert mae(scored) < mean_mae


def test_mae_hurdle_sweep(data):
    table = md.mae_hurdle_table(md.mae_hurdle_parts(data), (0.2, 0.5, 0.99)).collect()
    assert [r.MAE for r in table] == sorted(r.MAE for r in table)
    by = {r.threshold: r for r in table}
    assert by[0.2].pct_zero <= by[0.5].pct_zero <= by[0.99].pct_zero


def test_multi_tier_formula_and_ranges(data, mean_mae):
    scored = md.multi_tier_combine(md.multi_tier_parts(data, P.high_threshold), P.high_threshold)
    for r in scored.collect():
        assert 0 <= r.pred_low <= 90.0 and r.pred_high >= 60.0
        want = r.prob_returner * ((1 - r.prob_high) * r.pred_low + r.prob_high * r.pred_high)
        assert r.y_pred == pytest.approx(want)
    assert mae(scored) < mean_mae


def test_high_value_auc_skips_sparse_thresholds(data):
    got = {r.threshold: r for r in md.high_value_auc(data).collect()}
    assert 500.0 not in got and got[0.0].auc > 0.8 and got[0.0].n_positive_val >= 10


def test_cross_validation_covers_all_rows(rows):
    table = md.cross_validate(rows, COLUMNS, "y", P).collect()
    assert [r.fold for r in table] == [1, 2] and sum(r.n_val for r in table) == 400
    assert all(r.n_train + r.n_val == 400 and r.mae_raw > 0 for r in table)


def test_final_predictions_are_zeroed(rows):
    test = rows.limit(20).select((F.col("cust_id") + 1000).alias("cust_id"), *COLUMNS)
    got = [r.prediction for r in md.final_predictions(rows, test, COLUMNS, "y", P).collect()]
    assert len(got) == 20 and all(p == 0 or p >= P.champion_zero_below for p in got)


def test_importances_name_the_signal(spark, data):
    top = md.importance_table(md.fit_forest(data), data.columns, spark, 2).collect()
    assert top[0].feature == "a" and len(top) == 2


def test_unfit_loss_falls_back(data, caplog):
    """A loss that does not exist is fitted as squared error, and the log says so."""
    with caplog.at_level("WARNING"):
        model = md.fit_boosted(data, data.raw, F.col("y_true"), "quantile")
    assert isinstance(model.loss, Squared) and "quantile" in caplog.text
    known = md.fit_boosted(data, data.raw, F.col("y_true"), "squared")
    assert [t.value for t in model.trees] == [pytest.approx(t.value) for t in known.trees]


def test_boosted_losses_beat_linear_models(data):
    """The boosted Tweedie and pseudo-Huber fits against a Tweedie regression and a robust linear model."""
    from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression

    train, val = md.part(data.imputed, "train"), md.part(data.imputed, "val")
    glm = GeneralizedLinearRegression(labelCol="y_true", family="tweedie", variancePower=1.5, linkPower=0.0, regParam=0.1, maxIter=25).fit(train)
    robust = LinearRegression(labelCol="y_true", loss="huber", epsilon=1.35, regParam=0.01, maxIter=100).fit(train)
    assert mae(md.tweedie(data, 1.5)) < mae(md.predictions(glm, val))
    assert mae(md.huber(data)) < mae(md.predictions(robust, val))


def test_comparison_is_sorted(data):
    table = md.compare({"r": ("B", md.ridge(data)), "t": ("B", md.decision_tree(data))}).collect()
    assert [r.MAE for r in table] == sorted(r.MAE for r in table) and {r.group for r in table} == {"B"}


@pytest.fixture
def sizes_asked(monkeypatch):
    """Sizes that the named queries ask their fits for."""
    from ledgerline.catalog import revenue_models as named

    asked = {}

    def ask(name):
        return lambda *a, **k: asked.setdefault(name, next(x for x in (*a, *k.values()) if isinstance(x, ModelParams)))

    for name in ("ModelData", "cross_validate", "final_predictions"):
        monkeypatch.setattr(md, name, ask(name))
    for name in ("train_rows", "matrix"):
        monkeypatch.setattr(named, name, lambda spark, sf_dir: spark.createDataFrame([(1, 0.0)], "cust_id long, revenue_2018_2019 double"))
    monkeypatch.setattr(named.roles, "test", lambda spark, sf_dir: spark.createDataFrame([(1,)], "cust_id long"))
    monkeypatch.setattr(named.files, "submission", lambda rows: rows)
    return asked


def test_named_fits_have_all_their_rounds(spark, sizes_asked):
    from ledgerline.catalog import revenue_models as named

    named.data(spark, "")
    named.cv(spark, "")
    named.final_submission(spark, "")
    assert sizes_asked == {name: ModelParams() for name in ("ModelData", "cross_validate", "final_predictions")}
