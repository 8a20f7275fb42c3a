"""Splits, metrics and error tables, checked on a deterministic prediction.

The prediction is half of a customer's history revenue, so SQL can recompute every table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog.common import Catalogue, r, rounded
from ledgerline.catalog.revenue_features import MATRIX_NAMES, MATRIX_SQL, customer_features
from ledgerline.catalog.revenue_profile import TARGET
from ledgerline.operators import diagnostics as dx
from ledgerline.operators import prep
from ledgerline.params import DiagnosticParams, ModelParams
from ledgerline.session import materialise
from ledgerline.sources import files, roles

catalogue = Catalogue()
MP, DP = ModelParams(), DiagnosticParams()
BOTH = f"{roles.TRANSACTION_ORACLE}, {roles.CUSTOMER_ORACLE}"

SCORED_SQL = f"""with {BOTH}, h as (select cust_id, round(sum(sale_revenue), 2) as rev from tx group by 1),
 sc as (select cust_id, {TARGET} as y_true, round(0.5 * coalesce(rev, 0), 3) as raw_pred,
 greatest(round(0.5 * coalesce(rev, 0), 3), 0) as p from train left join h using (cust_id)),
 er as (select *, abs(y_true - p) as e from sc)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training customers with target and deterministic prediction."""
    history = roles.transactions(spark, sf_dir).groupBy("cust_id").agg(F.round(F.sum("sale_revenue"), 2).alias("rev"))
    rows = roles.train(spark, sf_dir).join(history, "cust_id", "left")
    value = F.round(F.lit(0.5) * F.coalesce("rev", F.lit(0.0)), 3)
    return materialise(
        rows.select("cust_id", F.col(TARGET).alias("y_true"), value.alias("y_pred")), "scored"
    )


# Three models over the same rows: the prediction, a zero and a doubled one.
MODELS_SQL = """, md as (select 'half' as model, y_true, p from sc union all select 'zero', y_true, 0 from sc
 union all select 'double', y_true, p * 2 from sc)"""


def three_models(rows: DataFrame) -> DataFrame:
    cells = F.array(
        F.struct(F.lit("half").alias("model"), F.col("y_pred").alias("y_pred")),
        F.struct(F.lit("zero").alias("model"), F.lit(0.0).alias("y_pred")),
        F.struct(F.lit("double").alias("model"), (F.col("y_pred") * 2).alias("y_pred")),
    )
    return rows.select("cust_id", "y_true", F.inline(cells))


def avg_rank(value: str, over: str) -> str:
    return (
        f"rank() over (partition by {over} order by {value})"
        f" + (count(*) over (partition by {over}, {value}) - 1) / 2.0"
    )


@catalogue.add(
    "w1_eval_mae_spearman",
    SCORED_SQL
    + MODELS_SQL
    + f""", rk as (select *, {avg_rank('y_true', 'model')} as ry, {avg_rank('p', 'model')} as rp from md)
 select model, {r('avg(abs(y_true - p))')} as "MAE",
 {r('case when stddev_pop(rp) > 0 and stddev_pop(ry) > 0 then corr(ry, rp) end')} as "Spearman" from rk group by 1""",
)
def eval_mae_spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAE and Spearman per model."""
    return dx.evaluate(three_models(scored(spark, sf_dir)))


@catalogue.add(
    "w1_pred_distribution",
    SCORED_SQL
    + MODELS_SQL
    + f""" select model, {r('min(p)')} as min, {r('avg(p)')} as mean, {r('max(p)')} as max, {r('quantile_cont(p, 0.5)')} as median,
 {r('avg((p = 0)::int) * 100')} as pct_zero, {r('avg((p < 5)::int) * 100')} as pct_lt_5, {r('avg((p < 20)::int) * 100')} as pct_lt_20
 from md group by 1""",
)
def pred_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distribution of the predictions per model."""
    return dx.prediction_distribution(three_models(scored(spark, sf_dir)), DP.cutoffs)


@catalogue.add(
    "w1_submission_summary",
    SCORED_SQL
    + MODELS_SQL
    + f""" select model as submission, {r('avg(p)')} as mean, {r('max(p)')} as max, {r('quantile_cont(p, 0.5)')} as median,
 {r('avg((p = 0)::int) * 100')} as pct_zero, count(*) as n_rows from md group by 1""",
)
def submission_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distribution of the predictions per submission."""
    return dx.submission_summary(three_models(scored(spark, sf_dir)).withColumnRenamed("model", "submission"))


@catalogue.add(
    "w1_error_split",
    SCORED_SQL
    + f""" select {r('avg(e) filter (where y_true <= 0)')} as mae_true_zero, {r('avg(e) filter (where y_true > 0)')} as mae_true_positive,
 {r('sum(e) filter (where y_true <= 0) / count(*)')} as error_contribution_zero,
 {r('sum(e) filter (where y_true > 0) / count(*)')} as error_contribution_positive from er""",
)
def error_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error of true-zero and positive customers."""
    return dx.error_split(scored(spark, sf_dir))


def _values(numbers) -> str:
    return ", ".join(f"({float(n)})" for n in numbers)


@catalogue.add(
    "w1_error_tail",
    SCORED_SQL
    + f""", t(threshold) as (values {_values(DP.actual_thresholds)})
 select threshold::double as threshold, count(*) filter (where y_true > threshold) as n_above,
 {r('avg((y_true > threshold)::int) * 100')} as pct_above, {r('coalesce(sum(e) filter (where y_true > threshold), 0)')} as error_sum,
 {r('coalesce(sum(e) filter (where y_true > threshold), 0) / sum(e) * 100')} as pct_total_error,
 {r('avg(e) filter (where not y_true > threshold)')} as mae_if_excluded from er, t group by 1""",
)
def error_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error held by customers above each actual threshold."""
    return dx.error_tail(scored(spark, sf_dir), DP.actual_thresholds)


_ACTUAL = ", ".join(
    f"({i}, {float(lo)}, {float(hi)})" for i, (lo, hi) in enumerate(zip(DP.actual_edges, DP.actual_edges[1:]))
)


@catalogue.add(
    "w1_calibration",
    SCORED_SQL
    + f""", b(bin_no, lower, upper) as (values {_ACTUAL})
 select bin_no, {r('lower')} as lower, {r('upper')} as upper, count(y_true) as n, {r('avg(y_true)')} as actual_mean,
 {r('avg(p)')} as pred_mean, {r('max(p)')} as pred_max from b
 left join sc on (y_true > lower or (bin_no = 0 and y_true = lower)) and y_true <= upper group by 1, lower, upper""",
)
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted against actual per actual bin."""
    return dx.calibration(scored(spark, sf_dir), DP.actual_edges)


_EDGES = ", ".join(f"quantile_cont(p, {i / DP.prediction_bins!r})" for i in range(DP.prediction_bins + 1))


@catalogue.add(
    "w1_var_by_predbin",
    SCORED_SQL
    + f""", src as (select * from sc where y_true > 0), el as (select distinct unnest([{_EDGES}]) as edge from src),
 bins as (select row_number() over (order by edge) - 1 as bin_no, edge as lower, lead(edge) over (order by edge) as upper from el),
 b as (select * from bins where upper is not null)
 select b.bin_no::int as bin_no, {r('b.lower')} as lower, {r('b.upper')} as upper, {r('avg(y_true)')} as mean,
 {r('stddev_samp(y_true)')} as std, count(y_true) as count from b
 left join src on (p > b.lower or (b.bin_no = 0 and p = b.lower)) and p <= b.upper group by b.bin_no, b.lower, b.upper""",
)
def var_by_predbin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spread of the actual value per prediction bin."""
    return dx.variance_by_prediction_bin(scored(spark, sf_dir), DP.prediction_bins)


def _high_compare(c: str) -> str:
    return (
        f"select '{c}' as feature, {r(f'avg({c}) filter (where not hi)')} as rest_mean, {r(f'avg({c}) filter (where hi)')} as top_mean,"
        f" {r(f'case when avg({c}) filter (where not hi) <> 0 then avg({c}) filter (where hi) / avg({c}) filter (where not hi) end')} as ratio,"
        f" {r('any_value(thr)')} as threshold from z"
    )


_TRAIN_MATRIX = f"""with m as materialized ({MATRIX_SQL}), {roles.CUSTOMER_ORACLE},
 tm as (select m.*, train.{TARGET} from m join train using (cust_id))"""


def train_matrix(spark: SparkSession, sf_dir: str, tiers=tuple(range(1, 12))) -> DataFrame:
    """Cleaned feature rows of the training customers with their target, stored with six digits."""
    features = customer_features(spark, sf_dir, store=True)
    raw = features.reindexed(features.raw(tiers))
    return materialise(rounded(features.clean(raw)).join(features.train, "cust_id"), "train_matrix")


@catalogue.add(
    "w1_highvalue_compare",
    _TRAIN_MATRIX
    + f""", q as (select quantile_cont({TARGET}, {DP.top_quantile}) as thr from tm),
 z as (select tm.*, thr, {TARGET} > thr as hi from tm, q) """
    + " union all ".join(_high_compare(c) for c in DP.compared_features),
)
def highvalue_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the top one percent against the rest."""
    rows = train_matrix(spark, sf_dir, (1, 5, 6))
    return dx.high_value_comparison(rows, TARGET, DP.compared_features, DP.top_quantile)


@catalogue.add(
    "w1_highvalue_counts",
    SCORED_SQL
    + f""", t(threshold) as (values {_values(DP.actual_thresholds)})
 select threshold::double as threshold, count(*) filter (where y_true > threshold) as n_returners_above,
 {r('avg((y_true > threshold)::int) * 100')} as pct_of_all from sc, t group by 1""",
)
def highvalue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers above each actual threshold."""
    return dx.high_value_counts(scored(spark, sf_dir), DP.actual_thresholds)


@catalogue.add(
    "w1_highvalue_sample",
    SCORED_SQL
    + f""" select cust_id, y_true, {r('raw_pred')} as y_pred from sc where y_true > {DP.sample_threshold}
 order by cust_id limit {DP.sample_rows}""",
)
def highvalue_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First customers by id above the sample threshold."""
    return dx.high_value_sample(scored(spark, sf_dir), "y_true", DP.sample_threshold, DP.sample_rows, ["y_pred"])


@catalogue.add(
    "w1_auc_exact",
    SCORED_SQL
    + f""", t(threshold) as (values {_values(MP.high_value_thresholds)}),
 rk as (select *, {avg_rank('p', '1')} as rp from sc)
 select threshold::double as threshold, {r('avg((y_true > threshold)::int)')} as positive_rate,
 {r('''case when count(*) filter (where y_true > threshold) between 1 and count(*) - 1 then
 (sum(rp) filter (where y_true > threshold) - count(*) filter (where y_true > threshold) * (count(*) filter (where y_true > threshold) + 1) / 2.0)
 / (count(*) filter (where y_true > threshold) * count(*) filter (where not y_true > threshold)) end''')} as auc from rk, t group by 1""",
)
def auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact AUC of the prediction for each high-value definition."""
    rows = dx.clipped(scored(spark, sf_dir))
    return dx.auc_table(rows, "y_pred", MP.high_value_thresholds)


_SWEEP = (
    SCORED_SQL
    + f""", t(threshold) as (values {_values(MP.zero_grid)}),
 zs as (select threshold::double as threshold, y_true, p, case when p < threshold then 0 else p end as z from sc, t),
 rk as (select *, {avg_rank('y_true', 'threshold')} as ry, {avg_rank('z', 'threshold')} as rz from zs),
 sw as (select threshold, avg(abs(y_true - z)) as mae, case when stddev_pop(rz) > 0 then corr(ry, rz) end as spearman,
 count(*) filter (where p > 0 and z = 0) as extra_zeros from rk group by 1)"""
)


@catalogue.add(
    "w1_zero_sweep",
    _SWEEP
    + f""" select threshold, {r('mae')} as mae, {r('spearman')} as spearman, extra_zeros,
 round(mae, 9) = (select min(round(mae, 9)) from sw) as is_best from sw""",
)
def zero_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effect of zeroing small predictions."""
    return dx.zero_sweep(scored(spark, sf_dir), MP.zero_grid)


@catalogue.add(
    "w1_best_zero",
    _SWEEP
    + f""", al as (select 0.0e0 as threshold, avg(abs(y_true - p)) as mae, -1 as pos from sc union all select threshold, mae, threshold from sw)
 select threshold as best_threshold, {r('mae')} as mae from al order by round(mae, 9), pos limit 1""",
)
def best_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best threshold for zeroing, 0 when none helps."""
    return dx.best_zero(scored(spark, sf_dir), MP.zero_grid)


@catalogue.add(
    "w1_ensemble",
    SCORED_SQL + MODELS_SQL.replace("as model, y_true", "as model, cust_id, y_true").replace("'zero', y_true", "'zero', cust_id, y_true").replace("'double', y_true", "'double', cust_id, y_true")
    + f" select cust_id, {r('avg(p)')} as y_pred from md group by 1",
)
def ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal-weight mean of three prediction tables."""
    rows = three_models(dx.clipped(scored(spark, sf_dir)))
    return dx.ensemble([rows.filter(F.col("model") == m) for m in ("half", "zero", "double")])


@catalogue.add(
    "w1_submission",
    SCORED_SQL + f" select cust_id, {r('p')} as prediction from sc",
)
def submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submission table: id and clipped prediction."""
    return files.submission(scored(spark, sf_dir), "y_pred")


# -- splits and preparation --------------------------------------------------------------


def split_sql(source: str, name: str, ratio: float = MP.validation_share, seed: int = MP.seed) -> str:
    return f"""{name} as (select *, case when row_number() over (partition by y > 0 order by md5(concat('{seed}-', cust_id)), cust_id)
 <= ceil(count(*) over (partition by y > 0) * {ratio}) then 'val' else 'train' end as split from {source})"""


TRAIN_Y = f"with {roles.CUSTOMER_ORACLE}, ty as (select cust_id, {TARGET} as y from train), "


@catalogue.add("w1_split_80_20", TRAIN_Y + split_sql("ty", "sp") + " select cust_id, split from sp")
def split_80_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stratified train/validation split."""
    train = roles.train(spark, sf_dir)
    return prep.stratified_split(train, "cust_id", TARGET, MP.validation_share, MP.seed).select("cust_id", "split")


@catalogue.add(
    "w1_folds",
    TRAIN_Y
    + f"""f as (select cust_id, (row_number() over (partition by y > 0 order by md5(concat('{MP.seed}-', cust_id)), cust_id) - 1) % {MP.folds} as fold from ty)
 select cust_id, fold::int as fold from f""",
)
def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stratified folds."""
    train = roles.train(spark, sf_dir)
    return prep.stratified_folds(train, "cust_id", TARGET, MP.folds, MP.seed).select("cust_id", "fold")


@catalogue.add(
    "w1_split_summary",
    TRAIN_Y
    + split_sql("ty", "sp")
    + f""" select split, count(*) as n_customers, printf('%.2f%%', round(avg((y > 0)::int) * 100 + 1e-9, 2)) as pct_returners, {r('avg(y)', 2)} as mean,
 {r('stddev_samp(y)', 2)} as std, {r('max(y)', 2)} as max, {r('quantile_cont(y, 0.5)', 2)} as median, {r('quantile_cont(y, 0.9)', 2)} as p90,
 {r('quantile_cont(y, 0.95)', 2)} as p95, {r('quantile_cont(y, 0.99)', 2)} as p99 from sp group by 1""",
    digits=2,
)
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target description per split."""
    train = roles.train(spark, sf_dir)
    rows = prep.stratified_split(train, "cust_id", TARGET, MP.validation_share, MP.seed)
    return dx.describe_target(materialise(rows, "split"), "split", TARGET)


#: All columns of the cleaned matrix, imputed with medians and scaled; both fits use the training split only.
COLUMNS = tuple(MATRIX_NAMES)
IMPUTED_SQL = f"""with recursive m as materialized ({MATRIX_SQL}), {roles.CUSTOMER_ORACLE}, ty as (select cust_id, {TARGET} as y from train), {split_sql('ty', 'sp')},
 fit as (select {', '.join(f'coalesce(quantile_cont({c}, 0.5), 0) as med_{c}' for c in COLUMNS)} from m join sp using (cust_id) where split = 'train'),
 im as materialized (select cust_id, split, y, {', '.join(f'coalesce({c}, med_{c})::double as {c}' for c in COLUMNS)} from m join sp using (cust_id), fit),
 sc as (select {', '.join(f'avg({c}) as a_{c}, stddev_pop({c}) as s_{c}' for c in COLUMNS)} from im where split = 'train')"""


def scaled_sql(column: str) -> str:
    return f"({column} - a_{column}) / case when s_{column} = 0 then 1 else s_{column} end"


@catalogue.add("w1_impute_scale", IMPUTED_SQL + " select cust_id, split, " + ", ".join(f"{r(scaled_sql(c))} as {c}" for c in COLUMNS) + " from im, sc")
def impute_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median-imputed, standardised features; both fits use the training split only."""
    rows = train_matrix(spark, sf_dir)
    rows = materialise(prep.stratified_split(rows, "cust_id", TARGET, MP.validation_share, MP.seed), "split")
    fit_on = rows.filter(F.col("split") == "train")
    medians = prep.fit_medians(fit_on, COLUMNS)
    filled = materialise(prep.impute(rows, medians), "filled")
    scaling = prep.fit_scaling(filled.filter(F.col("split") == "train"), COLUMNS)
    return prep.scale(filled, scaling).select("cust_id", "split", *COLUMNS)


@catalogue.add(
    "w1_baselines",
    TRAIN_Y
    + split_sql("ty", "sp")
    + f""", c as (select avg(y) as m, quantile_cont(y, 0.5) as d from sp where split = 'train'),
 v as (select 'A1. Predict 0 for everyone' as model, y, 0 as p from sp where split = 'val'
 union all select 'A2. Predict mean', y, m from sp, c where split = 'val'
 union all select 'A3. Predict median', y, d from sp, c where split = 'val')
 select 'A. Sanity' as "group", model, {r('avg(abs(y - greatest(p, 0)))')} as "MAE", cast(null as double) as "Spearman" from v group by 2""",
)
def baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict zero, mean or median."""
    from ledgerline.plans.models import baseline_results

    rows = prep.stratified_split(roles.train(spark, sf_dir), "cust_id", TARGET, MP.validation_share, MP.seed)
    return baseline_results(materialise(rows, "split"), TARGET)
