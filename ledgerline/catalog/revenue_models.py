"""Model comparison. Fits use the whole cleaned matrix of all customers, at the sizes of ``ModelParams``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog.common import Catalogue, r, rounded
from ledgerline.catalog.revenue_diagnostics import COLUMNS, IMPUTED_SQL, MP, TRAIN_Y, scaled_sql
from ledgerline.catalog.revenue_features import ID_COLUMNS, customer_features
from ledgerline.catalog.revenue_profile import TARGET
from ledgerline.operators import diagnostics as dx
from ledgerline.operators import prep
from ledgerline.plans import models as md
from ledgerline.session import derived, materialise
from ledgerline.sources import files, roles

catalogue = Catalogue()


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrix of all customers, with the target for training customers; kept as a file, as the original workload keeps it."""

    def build() -> DataFrame:
        features = customer_features(spark, sf_dir, store=True)
        return rounded(features.matrix()).join(features.train, "cust_id", "left")

    return derived(spark, "feature-matrix", [f"{sf_dir}/{t}.parquet" for t in ("customer", "lineitem", "orders", "part")], build)


def feature_columns(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in ID_COLUMNS and c != TARGET]


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.align(
        matrix(spark, sf_dir).drop(TARGET), roles.train(spark, sf_dir).select("cust_id", TARGET), "cust_id"
    )


def data(spark: SparkSession, sf_dir: str) -> md.ModelData:
    rows = train_rows(spark, sf_dir)
    return md.ModelData(rows, feature_columns(rows), TARGET, params=MP)


def _simple(name: str, fit, doc: str, oracle: str | None = None) -> None:
    @catalogue.add(name, oracle)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fit(data(spark, sf_dir)).select("cust_id", "y_true", "y_pred")

    query.__doc__ = doc


_WIDTH = len(COLUMNS)
SCALED_SQL = IMPUTED_SQL + f", z as materialized (select cust_id, split, y, [{', '.join(scaled_sql(c) for c in COLUMNS)}] as x from im, sc)"


def _ridge_sql(target: str, back: str) -> str:
    """Normal equations: sums of products over the training rows, then one elimination step per column."""
    return (
        SCALED_SQL
        + f""", long as materialized (select cust_id, unnest(range({_WIDTH + 2})) as i, unnest(list_concat([1.0e0], x, [{target}])) as v from z where split = 'train'),
 g as materialized (select a.i, b.i as j, sum(a.v * b.v) as s from long a join long b using (cust_id) group by 1, 2),
 mean as materialized (select i, s / (select s from g where i = 0 and j = 0) as m from g where j = 0),
 centred as (select g.i, g.j, g.s - p.s * mean.m + case when g.i = g.j then {MP.ridge_alpha} else 0 end as s
  from g join g p on p.i = g.i and p.j = 0 join mean on mean.i = g.j where g.i between 1 and {_WIDTH} and g.j >= 1),
 sys as (select list(line order by i) as a from (select i, list(s order by j) as line from centred group by i)),
 steps as (select 1::bigint as k, a from sys union all select k + 1, list_transform(a, lambda line, i: case when i = k
  then list_transform(line, lambda v: v / line[k]) else list_transform(line, lambda v, j: v - line[k] / a[k][k] * a[k][j]) end) from steps where k <= {_WIDTH}),
 w as (select list_transform(a, lambda line: line[{_WIDTH + 1}]) as w from steps where k = {_WIDTH + 1}),
 shift as (select (select m from mean where i = {_WIDTH + 1}) - list_dot_product((select list(m order by i) from mean where i between 1 and {_WIDTH}), w) as b, w from w)
 select cust_id, {r('y')} as y_true, {r(back.format('(list_dot_product(x, w) + b)'))} as y_pred from z, shift where split = 'val'"""
    )


_simple("w1_ridge", md.ridge, "Ridge predictions.", _ridge_sql("y", "{}"))
_simple("w1_ridge_log", md.ridge_log, "Ridge on log1p of the target.", _ridge_sql("ln(1 + y)", "(exp({}) - 1)"))
_simple("w1_tree", md.decision_tree, "Decision tree predictions.")
_simple("w1_forest", md.random_forest, "Random forest predictions.")
_simple("w1_gbt_abs", md.boosted_absolute, "Boosted trees on absolute error.")
_simple("w1_gbt_abs_deep", lambda d: md.boosted_absolute(d, True), "Deeper boosted trees on absolute error.")
_simple("w1_hurdle", md.hurdle, "Two-stage hurdle.")


@catalogue.add(
    "w1_knn",
    SCALED_SQL
    + f""", nn as (select q.cust_id, q.y, i.y as iy, i.cust_id as item, list_distance(q.x, i.x) as d from z q join z i on q.split = 'val' and i.split = 'train'),
 best as (select * from (select *, row_number() over (partition by cust_id order by round(d, 9), item) as k from nn) where k <= {MP.neighbours})
 select cust_id, {r('any_value(y)')} as y_true, {r('case when count(*) filter (where d = 0) > 0 then avg(iy) filter (where d = 0) else sum(iy / nullif(d, 0)) / sum(1 / nullif(d, 0)) end')} as y_pred
 from best group by 1""",
)
def knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest-neighbour regression on all scaled features."""
    return md.knn(data(spark, sf_dir)).select("cust_id", "y_true", "y_pred")


def _compared(fits: dict[str, tuple[str, Callable[[], DataFrame]]]) -> DataFrame:
    """Scores of several fits, made side by side. The names are fixed output values."""
    done = md.together(*[fit for _, fit in fits.values()])
    return md.compare({name: (group, scored) for (name, (group, _)), scored in zip(fits.items(), done)})


@catalogue.add("w1_main_models")
def main_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three main models, scored and sorted."""
    d, group = data(spark, sf_dir), "C. Main"
    return _compared(
        {
            "C1. Boosted single regression": (group, lambda: md.boosted_absolute(d)),
            "C2. Boosted Tweedie": (group, lambda: md.tweedie(d, MP.tweedie_powers[0])),
            "C3. Two-stage hurdle": (group, lambda: md.hurdle(d)),
        }
    )


@catalogue.add("w1_tweedie")
def tweedie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tweedie models of three powers, scored."""
    d = data(spark, sf_dir)
    return _compared({f"C2.v Tweedie (power={p})": ("C. Main v2", lambda p=p: md.tweedie(d, p, True)) for p in MP.tweedie_powers})


@catalogue.add("w1_longtail")
def longtail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squared, log and pseudo-Huber losses, scored."""
    d, group = data(spark, sf_dir), "D. Long-tail"
    return _compared(
        {
            "D1. Boosted MSE": (group, lambda: md.boosted_squared(d)),
            "D2. Boosted log1p MSE": (group, lambda: md.boosted_log(d)),
            "D3. Boosted pseudo-Huber": (group, lambda: md.huber(d)),
        }
    )


@catalogue.add("w1_basic_models")
def basic_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basic methods, scored and sorted."""
    d, group = data(spark, sf_dir), "B. Basic methods"
    return md.compare(
        {
            "B1. Ridge Regression": (group, md.ridge(d)),
            "B1b. Ridge on log1p(y)": (group, md.ridge_log(d)),
            "B2. Decision Tree": (group, md.decision_tree(d)),
            "B3. KNN": (group, md.knn(d)),
            "B4. Random Forest": (group, md.random_forest(d)),
        }
    )


@catalogue.add("w1_hurdle_mae")
def hurdle_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability threshold sweep of the hurdle."""
    parts = materialise(md.mae_hurdle_parts(data(spark, sf_dir)), "hurdle")
    return md.mae_hurdle_table(parts, MP.hurdle_thresholds)


@catalogue.add("w1_multitier")
def multitier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-tier hurdle with its parts."""
    parts = md.multi_tier_parts(data(spark, sf_dir), MP.high_threshold)
    return md.multi_tier_combine(parts, MP.high_threshold)


@catalogue.add("w1_highvalue_auc")
def highvalue_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Separability of high-value customers per threshold."""
    return md.high_value_auc(data(spark, sf_dir))


@catalogue.add("w1_cv")
def cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Champion by cross-validation."""
    rows = train_rows(spark, sf_dir)
    return md.cross_validate(rows, feature_columns(rows), TARGET, MP)


@catalogue.add(
    "w1_cv_summary",
    TRAIN_Y
    + f"""fd as (select y, (row_number() over (partition by y > 0 order by md5(concat('{MP.seed}-', cust_id)), cust_id) - 1) % {MP.folds} as fold from ty),
 ag as (select fold, avg(y) as mean_y, avg(abs(y)) as mae_zero from fd group by 1)
 select 'mae_zero' as metric, {r('avg(mae_zero)')} as mean, {r('stddev_samp(mae_zero)')} as std from ag
 union all select 'mean_y', {r('avg(mean_y)')}, {r('stddev_samp(mean_y)')} from ag""",
)
def cv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation of fold metrics, for the zero prediction."""
    rows = prep.stratified_folds(roles.train(spark, sf_dir), "cust_id", TARGET, MP.folds, MP.seed)
    per_fold = rows.groupBy("fold").agg(F.avg(TARGET).alias("mean_y"), F.avg(F.abs(TARGET)).alias("mae_zero"))
    return dx.fold_summary(per_fold, ["mae_zero", "mean_y"])


@catalogue.add("w1_final_submission")
def final_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Champion fitted on all training rows, applied to the test customers."""
    everyone = matrix(spark, sf_dir)
    test = roles.test(spark, sf_dir).join(everyone.drop(TARGET), "cust_id")
    train = train_rows(spark, sf_dir)
    scored = md.final_predictions(train, test, feature_columns(everyone), TARGET, MP)
    return files.submission(scored)


@catalogue.add("w1_importance")
def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most important features of the forest."""
    d = data(spark, sf_dir)
    return md.importance_table(md.fit_forest(d), d.columns, spark, 20)
