import random

import numpy as np
import pandas as pd
import pytest

from ledgerline.operators import diagnostics as dx
from ledgerline.operators import profile
from ledgerline.params import ProfileParams


def scored(spark, y, p, model="m"):
    rows = [(i, float(a), float(b), model) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "cust_id bigint, y_true double, y_pred double, model string")


def test_mae_clips_predictions(spark):
    row = dx.evaluate(scored(spark, [3, 0, 7, 30], [-2, -1, 8.5, 24])).first()
    assert row.MAE == pytest.approx((3 + 0 + 1.5 + 6) / 4)


def test_spearman_equals_pandas_and_is_null_for_constants(spark):
    draw = random.Random(1)
    y = [draw.choice([0, 0, 0, 5, 9, 20]) for _ in range(80)]
    p = [draw.choice([0, 1, 1, 7, 30]) for _ in range(80)]
    rows = scored(spark, y, p).union(scored(spark, y, [3] * 80, "flat"))
    got = {r.model: r for r in dx.evaluate(rows).collect()}
    assert got["m"].Spearman == pytest.approx(pd.Series(y).rank().corr(pd.Series(p).rank()))
    assert got["flat"].Spearman is None


def test_prediction_distribution(spark):
    row = dx.prediction_distribution(scored(spark, [0] * 5, [-7, 2.5, 3, 11, 60]), [3, 40]).first()
    assert (row["min"], row.pct_zero, row.pct_lt_3, row.pct_lt_40) == (0.0, 20.0, 40.0, 80.0)


def test_error_tail(spark):
    row = dx.error_tail(scored(spark, [12, 0, 61, 90, 75], [10, 4, 60, 50, 100]), [60]).first()
    assert (row.n_above, row.pct_above, row.error_sum) == (3, 60.0, 66.0)
    assert row.mae_if_excluded == 3.0


def test_error_split(spark):
    row = dx.error_split(scored(spark, [0, 0, 10], [1, 3, 4])).first()
    assert row.mae_true_zero == 2.0 and row.mae_true_positive == 6.0
    assert row.error_contribution_zero + row.error_contribution_positive == pytest.approx(10 / 3)


def test_zero_sweep_marks_one_best_row(spark):
    rows = scored(spark, [0, 9, 0, 0, 14], [2, 9, 3, 0, 13])
    table = {r.threshold: r for r in dx.zero_sweep(rows, [0, 4, 10]).collect()}
    assert [t for t, r in table.items() if r.is_best] == [4.0]
    assert table[4.0].extra_zeros == 2
    best = dx.best_zero(rows, [0, 4, 10]).first()
    assert best.best_threshold == 4.0 and best.mae == pytest.approx(0.2)


def test_zero_sweep_ranks_equal_a_new_ranking(spark):
    draw = random.Random(2)
    y = [draw.choice([0, 0, 4, 9]) for _ in range(60)]
    p = [draw.choice([0, 1, 2, 6, 8, 30]) for _ in range(60)]
    for row in dx.zero_sweep(scored(spark, y, p), [0, 2, 7, 50]).collect():
        z = np.where(np.array(p) < row.threshold, 0, p)
        assert row.mae == pytest.approx(np.abs(np.array(y) - z).mean())
        if z.std() == 0:
            assert row.spearman is None
        else:
            assert row.spearman == pytest.approx(pd.Series(y).rank().corr(pd.Series(z).rank()))


def test_no_threshold_is_better(spark):
    assert dx.best_zero(scored(spark, [5, 5], [5, 5]), [0, 1, 9]).first().best_threshold == 0.0


def test_calibration_columns_and_empty_bins(spark):
    table = dx.calibration(scored(spark, [0, 8, 10, 33], [1, 6, 12, 30]), [-5, 0, 9, 10, 40, 90])
    assert [c for c in table.columns if c not in ("bin_no", "lower", "upper")] == ["n", "actual_mean", "pred_mean", "pred_max"]
    assert [r.n for r in table.orderBy("bin_no").collect()] == [1, 1, 1, 1, 0]


def test_auc_counts_ties_half(spark):
    row = dx.auc_table(scored(spark, [1, 1, 0, 0], [0.9, 0.5, 0.5, 0.1]), "y_pred", [0]).first()
    assert row.auc == pytest.approx(3.5 / 4) and row.positive_rate == 0.5
    assert dx.auc_table(scored(spark, [0, 0], [0.9, 0.5]), "y_pred", [0]).first().auc is None


def test_submission_summary(spark):
    rows = spark.createDataFrame([(1, 0.0, "v"), (2, 10.0, "v")], "cust_id bigint, y_pred double, submission string")
    row = dx.submission_summary(rows).first()
    assert row.n_rows == 2 and row.mean == 5.0 and row.median == 5.0 and row.pct_zero == 50.0


def test_ensemble_is_the_mean(spark):
    a, b = scored(spark, [0, 0], [1, 2]), scored(spark, [0, 0], [3, 6])
    assert sorted(r.y_pred for r in dx.ensemble([a, b]).collect()) == [2.0, 4.0]


def test_missing_report_order_and_rounding(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, "x")], "a int, b string")
    assert [tuple(r) for r in profile.missing_report(df).collect()] == [("b", 2, 66.67), ("a", 1, 33.33)]


def test_value_counts_with_and_without_null(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), (None,)], "v string")
    assert [tuple(r) for r in profile.value_counts(df, "v").collect()] == [("a", 1), ("b", 1)]
    assert [tuple(r) for r in profile.value_counts(df, "v", 1, True).collect()] == [(None, 3)]


def test_target_summary_of_one_row(spark):
    df = spark.createDataFrame([(4.0,)], "y double")
    got = {r.statistic: r.value for r in profile.target_summary(df, "y", ProfileParams()).collect()}
    assert got["n_customers"] == 1 and got["std"] is None and got["positive_p50"] == 4.0 and got["pct_zero"] == 0.0


def test_ratio_to_a_zero_baseline_is_null(spark):
    df = spark.createDataFrame([("cpu", 0.0), ("gpu", 3.0)], "k string, v double")
    assert all(r["v_vs_cpu"] is None for r in profile.ratio_to_baseline(df, "k", "cpu", ["v"]).collect())
