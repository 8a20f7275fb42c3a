"""Model comparison of the customer workload as Spark jobs.

Linear models, trees and forests see imputed columns; boosted trees (``plans/boosting.py``) see missing
values as such. Boosted fits judge the validation rows after every round and keep the best prefix
once their patience is over.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.expr import as_flag, at_least, zero_below
from ledgerline.operators import diagnostics as dx
from ledgerline.operators import prep
from ledgerline.operators.neighbours import inverse_distance_mean, nearest
from ledgerline.params import ModelParams
from ledgerline.plans.boosting import Booster, BoostedTrees, UnknownLoss, loss_named
from ledgerline.session import materialise, together

log = logging.getLogger(__name__)
ID, Y = "cust_id", "y_true"
#: Rows that one stored file of the model rows holds, about.
FILE_ROWS = 20_000


class ModelData:
    """Imputed (and, for linear models and neighbours, scaled) rows with ``split``.

    Both fits use the training split only. The rows are stored once and read by all fits.
    """

    def __init__(self, rows: DataFrame, columns: Sequence[str], target: str, split: bool = True, params: ModelParams | None = None):
        self.p = params or ModelParams()
        self.columns = list(columns)
        rows = rows.withColumnRenamed(target, Y)
        if "split" not in rows.columns:
            rows = (
                prep.stratified_split(rows, ID, Y, self.p.validation_share, self.p.seed)
                if split
                else rows.withColumn("split", F.lit("train"))
            )
        rows = materialise(dealt_evenly(rows.select(ID, Y, "split", *self.columns), ID), "model_rows")
        #: Rows as they are, nulls included, for boosted trees.
        self.raw = rows.select(ID, Y, "split", F.array(*[F.col(f"`{c}`").cast("double") for c in self.columns]).alias("features"))
        self.medians = prep.fit_medians(rows.filter(F.col("split") == "train"), self.columns)
        filled = prep.impute(rows, self.medians)
        self.scaling = prep.fit_scaling(filled.filter(F.col("split") == "train"), self.columns)
        assembler = VectorAssembler(inputCols=self.columns, outputCol="features")
        self.imputed = materialise(
            assembler.transform(filled).select(ID, Y, "split", "features"), "imputed"
        )

    def scaled(self) -> DataFrame:
        """Standardised feature vectors, computed from the stored imputed ones."""
        means = F.array(*[F.lit(float(self.scaling[c][0])) for c in self.columns])
        sizes = F.array(*[F.lit(float(self.scaling[c][1])) for c in self.columns])
        raw = vector_to_array("features")
        shifted = F.zip_with(raw, means, lambda x, m: x - m)
        return self.imputed.withColumn("vec", F.zip_with(shifted, sizes, lambda x, s: x / s))


def dealt_evenly(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` in parts of about ``FILE_ROWS``, by key and in its order, however they came: every fit reads them many times."""
    return rows.repartition(rows.count() // FILE_ROWS + 1, key).sortWithinPartitions(key)


def part(rows: DataFrame, split: str) -> DataFrame:
    return rows.filter(F.col("split") == split)


def predictions(model, rows: DataFrame, back: Callable[[Column], Column] | None = None) -> DataFrame:
    """Id, truth and prediction, taken back to revenue where the fit used another scale."""
    value = F.col("prediction")
    scored = model.predict(rows, [ID, Y], "prediction") if isinstance(model, BoostedTrees) else model.transform(rows)
    return scored.select(ID, Y, (back(value) if back else value).alias("y_pred"))


def probabilities(model: BoostedTrees, rows: DataFrame, name: str) -> DataFrame:
    return model.predict(rows, [ID], name)


# -- A: no features --------------------------------------------------------------------


def baseline_results(rows: DataFrame, target: str) -> DataFrame:
    """Zero, training mean and training median, scored on the validation rows.

    A constant has no rank correlation, so Spearman is NULL by definition.
    """
    from ledgerline.operators.quantiles import grouped_quantiles

    train, val = part(rows, "train"), part(rows, "val")
    mean = train.agg(F.avg(target).alias("m")).scalar()
    median = grouped_quantiles(train, [], target, {"m": 0.5}).scalar()
    cells = F.array(
        F.struct(F.lit("A1. Predict 0 for everyone").alias("model"), F.lit(0.0).alias("p")),
        F.struct(F.lit("A2. Predict mean").alias("model"), mean.alias("p")),
        F.struct(F.lit("A3. Predict median").alias("model"), median.alias("p")),
    )
    scored = val.select(F.col(target).alias("y"), F.inline(cells))
    return (
        scored.groupBy(F.lit("A. Sanity").alias("group"), "model")
        .agg(F.avg(F.abs(F.col("y") - at_least(F.col("p"), 0.0))).alias("MAE"))
        .withColumn("Spearman", F.lit(None).cast("double"))
        .orderBy("MAE", "model")
    )


# -- B: basic methods -------------------------------------------------------------------


def products(rows: DataFrame, width: int) -> DataFrame:
    """(i, j, value), i <= j: sums of products of (1, vec, target) over ``rows`` (vec, t).

    A task multiplies whole blocks of rows and passes on one number per pair of columns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 2, width + 2))
        for batch in batches:
            n = batch.num_rows
            x = batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(n, width)
            block = np.column_stack([np.ones(n), x, batch.column("t").to_numpy()])
            total += block.T @ block
        i, j = np.triu_indices(width + 2)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "value"])

    parts = rows.select("vec", F.col("t").cast("double").alias("t")).mapInArrow(run, "i int, j int, value double")
    return parts.groupBy("i", "j").agg(F.sum("value").alias("value"))


def fit_ridge(rows: DataFrame, target: Column, alpha: float) -> tuple[np.ndarray, float]:
    """Weights and intercept with penalty ``alpha`` on the sum of squares, by the normal equations.

    One pass over ``rows`` (vec), then a system as wide as the features, solved on the driver.
    """
    width = rows.select(F.max(F.size("vec"))).first()[0] or 0
    g = np.zeros((width + 2, width + 2))
    for r in products(rows.withColumn("t", target), width).collect():
        g[r["i"], r["j"]] = g[r["j"], r["i"]] = r["value"]
    n = max(g[0, 0], 1.0)
    mean = g[0] / n
    x = slice(1, width + 1)
    centred = g - np.outer(g[0], mean)
    weights = np.linalg.solve(centred[x, x] + alpha * np.eye(width), centred[x, -1])
    return weights, float(mean[-1] - mean[x] @ weights)


def linear(rows: DataFrame, model: tuple[np.ndarray, float], back: Callable[[Column], Column] | None = None) -> DataFrame:
    weights, shift = model
    terms = F.zip_with("vec", F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x * w)
    value = F.aggregate(terms, F.lit(shift), lambda a, b: a + b)
    return rows.select(ID, Y, (back(value) if back else value).alias("y_pred"))


def ridge(data: ModelData) -> DataFrame:
    rows = materialise(data.scaled(), "scaled")
    return linear(part(rows, "val"), fit_ridge(part(rows, "train"), F.col(Y), data.p.ridge_alpha))


def ridge_log(data: ModelData) -> DataFrame:
    rows = materialise(data.scaled(), "scaled")
    return linear(part(rows, "val"), fit_ridge(part(rows, "train"), F.log1p(Y), data.p.ridge_alpha), F.expm1)


def decision_tree(data: ModelData) -> DataFrame:
    model = DecisionTreeRegressor(
        labelCol=Y, maxDepth=data.p.tree_depth, minInstancesPerNode=data.p.tree_leaf, seed=data.p.seed
    ).fit(part(data.imputed, "train"))
    return predictions(model, part(data.imputed, "val"))


def fit_forest(data: ModelData):
    return RandomForestRegressor(
        labelCol=Y,
        numTrees=data.p.forest_trees,
        minInstancesPerNode=data.p.forest_leaf,
        maxDepth=data.p.forest_depth,
        featureSubsetStrategy="sqrt",
        seed=data.p.seed,
    ).fit(part(data.imputed, "train"))


def random_forest(data: ModelData) -> DataFrame:
    return predictions(fit_forest(data), part(data.imputed, "val"))


def knn(data: ModelData) -> DataFrame:
    rows = materialise(data.scaled().select(ID, Y, "split", "vec"), "scaled")
    items = part(rows, "train").select(F.col(ID).alias("item_id"), "vec")
    queries = part(rows, "val").select(F.col(ID).alias("query_id"), "vec")
    found = nearest(queries, items, data.p.neighbours, "euclidean")
    targets = part(rows, "train").select(F.col(ID).alias("item_id"), F.col(Y).alias("y"))
    predicted = inverse_distance_mean(found, targets)
    return part(rows, "val").select(ID, Y).join(predicted.withColumnRenamed("query_id", ID), ID)


# -- C, D: boosted trees and long-tail variants -------------------------------------------


def _booster(p: ModelParams, loss, deep: bool = False, rounds: int | None = None, stop_early: bool = True) -> Booster:
    size = (p.deep_rounds, p.deep_rate, p.deep_depth, p.deep_leaf, p.deep_patience) if deep else (p.boost_rounds, p.boost_rate, p.boost_depth, p.boost_leaf, p.boost_patience)
    return Booster(
        loss,
        rounds=rounds or size[0],
        rate=size[1],
        depth=size[2],
        least_weight=size[3],
        subsample=p.boost_subsample,
        columns=p.boost_columns,
        patience=size[4] if stop_early else None,
        seed=p.seed,
    )


def fit_boosted(data: ModelData, rows: DataFrame, target: Column, loss: str, deep: bool = False, stop_early: bool = True, rounds: int | None = None, power: float = 1.5) -> BoostedTrees:
    """Boosted trees; the validation rows choose the number of rounds. An unknown loss falls back to squared error."""
    try:
        wanted = loss_named(loss, power)
    except UnknownLoss as error:
        log.warning("%s; fitting squared error", error)
        wanted = loss_named("squared")
    source = (rows if stop_early else part(rows, "train")).select(F.col(ID).alias("id"), target.alias("y"), (F.col("split") == "val").alias("val"), "features")
    return _booster(data.p, wanted, deep, rounds, stop_early).fit(source)


def fit_classifier(data: ModelData, rows: DataFrame, label: Column) -> BoostedTrees:
    return fit_boosted(data, rows, as_flag(label), "logistic")


def boosted_absolute(data: ModelData, deep: bool = False, rounds: int | None = None) -> DataFrame:
    return predictions(fit_boosted(data, data.raw, F.col(Y), "absolute", deep, rounds=rounds), part(data.raw, "val"))


def boosted_squared(data: ModelData) -> DataFrame:
    return predictions(fit_boosted(data, data.raw, F.col(Y), "squared", True), part(data.raw, "val"))


def boosted_log(data: ModelData) -> DataFrame:
    model = fit_boosted(data, data.raw, F.log1p(Y), "squared", True)
    return predictions(model, part(data.raw, "val"), F.expm1)


def huber(data: ModelData) -> DataFrame:
    """Pseudo-Huber loss, robust against few large targets."""
    return predictions(fit_boosted(data, data.raw, F.col(Y), "pseudo_huber", True), part(data.raw, "val"))


def tweedie(data: ModelData, power: float, deep: bool = False) -> DataFrame:
    """Tweedie deviance with a log link."""
    return predictions(fit_boosted(data, data.raw, F.col(Y), "tweedie", deep, power=power), part(data.raw, "val"))


# -- hurdles -------------------------------------------------------------------------------


def _joined(val: DataFrame, *tables: DataFrame) -> DataFrame:
    rows = val.select(ID, Y)
    for t in tables:
        rows = rows.join(t, ID)
    return rows


def hurdle(data: ModelData, deep: bool = False) -> DataFrame:
    """P(return) times the revenue expected from those who return."""
    rows, val = data.raw, part(data.raw, "val")
    classifier, regressor = together(
        lambda: fit_classifier(data, rows, F.col(Y) > 0), lambda: fit_boosted(data, rows.filter(F.col(Y) > 0), F.log1p(Y), "absolute", deep)
    )
    given = predictions(regressor, val, F.expm1).select(ID, at_least(F.col("y_pred"), 0.0).alias("if_returner"))
    both = _joined(val, probabilities(classifier, val, "prob_returner"), given)
    return both.withColumn("y_pred", F.col("prob_returner") * F.col("if_returner"))


def mae_hurdle_parts(data: ModelData) -> DataFrame:
    """Return probability and revenue if returning, per validation customer."""
    rows, val = data.raw, part(data.raw, "val")
    classifier, regressor = together(
        lambda: fit_classifier(data, rows, F.col(Y) > 0), lambda: fit_boosted(data, rows.filter(F.col(Y) > 0), F.col(Y), "absolute", True)
    )
    given = predictions(regressor, val).select(ID, at_least(F.col("y_pred"), 0.0).alias("if_returner"))
    return _joined(val, probabilities(classifier, val, "prob_returner"), given)


def mae_hurdle_table(parts: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Zero below each probability threshold, all thresholds in one pass, best MAE first."""
    grid = F.array(*[F.lit(float(t)) for t in thresholds])
    value = F.when(F.col("prob_returner") < F.col("threshold"), F.lit(0.0)).otherwise(F.col("if_returner"))
    rows = materialise(
        parts.withColumn("threshold", F.explode(grid)).select(ID, Y, "threshold", value.alias("y_pred")), "sweep"
    )
    zeros = rows.groupBy("threshold").agg((F.avg(as_flag(F.col("y_pred") == 0)) * 100).alias("pct_zero"))
    return dx.evaluate(rows, ["threshold"]).join(zeros, "threshold").orderBy("MAE", "threshold")


def multi_tier_parts(data: ModelData, high: float) -> DataFrame:
    rows, val, y = data.raw, part(data.raw, "val"), F.col(Y)
    returns, is_high, low_model, high_model = together(
        lambda: fit_classifier(data, rows, y > 0),
        lambda: fit_classifier(data, rows.filter(y > 0), y > high),
        lambda: fit_boosted(data, rows.filter((y > 0) & (y <= high)), y, "absolute"),
        lambda: fit_boosted(data, rows.filter(y > high), F.log1p(Y), "absolute"),
    )
    low = predictions(low_model, val).select(ID, F.col("y_pred").alias("raw_low"))
    above = predictions(high_model, val, F.expm1).select(ID, F.col("y_pred").alias("raw_high"))
    return _joined(
        val, probabilities(returns, val, "prob_returner"), probabilities(is_high, val, "prob_high"), low, above
    )


def multi_tier_combine(parts: DataFrame, high: float) -> DataFrame:
    """P(return) · ((1 − P(high)) · low + P(high) · high), each part kept in its range."""
    low = F.least(F.greatest(F.col("raw_low"), F.lit(0.0)), F.lit(high * 1.5))
    above = F.greatest(F.col("raw_high"), F.lit(float(high)))
    ph = F.col("prob_high")
    expected = (1 - ph) * low + ph * above
    return parts.withColumns({"pred_low": low, "pred_high": above, "y_pred": F.col("prob_returner") * expected})


def high_value_auc(data: ModelData) -> DataFrame:
    """How well each high-value definition can be told apart; sparse ones are skipped."""
    p, val = data.p, part(data.raw, "val")
    counts = data.imputed.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(as_flag(F.col(Y) > t)).alias(f"p{i}") for i, t in enumerate(p.high_value_thresholds)],
    )
    sizes = {row["split"]: row for row in counts.collect()}
    tables = []
    kept = [(i, t) for i, t in enumerate(p.high_value_thresholds) if min(sizes["train"][f"p{i}"], sizes["val"][f"p{i}"]) >= p.min_positives]
    models = together(*[lambda t=t: fit_classifier(data, data.raw, F.col(Y) > t) for _, t in kept])
    for (i, t), model in zip(kept, models):
        n_train, n_val = sizes["train"][f"p{i}"], sizes["val"][f"p{i}"]
        scored = val.select(ID, Y).join(probabilities(model, val, "prob"), ID)
        table = dx.auc_table(scored, "prob", [t]).select("threshold", "auc")
        tables.append(
            table.withColumns(
                {
                    "positive_rate_train": F.lit(n_train / sizes["train"]["n"] * 100),
                    "positive_rate_val": F.lit(n_val / sizes["val"]["n"] * 100),
                    "n_positive_train": F.lit(n_train),
                    "n_positive_val": F.lit(n_val),
                    "rounds": F.lit(len(model.trees)),
                }
            )
        )
    schema = (
        "threshold double, auc double, positive_rate_train double, positive_rate_val double,"
        " n_positive_train bigint, n_positive_val bigint, rounds int"
    )
    table = data.imputed.sparkSession.createDataFrame([], schema)
    for t in tables:
        table = table.unionByName(t)
    return table


# -- champion ------------------------------------------------------------------------------


def cross_validate(rows: DataFrame, columns: Sequence[str], target: str, params: ModelParams) -> DataFrame:
    """Champion per fold: MAE raw and zeroed, Spearman zeroed."""
    dealt = materialise(prep.stratified_folds(rows, ID, target, params.folds, params.seed), "folds")

    def one(fold: int) -> DataFrame:
        split = F.when(F.col("fold") == fold, "val").otherwise("train")
        data = ModelData(dealt.withColumn("split", split), columns, target, params=params)
        return materialise(boosted_absolute(data, rounds=params.fold_rounds).withColumn("fold", F.lit(fold + 1)), "fold")

    stacked = None
    for scored in together(*[lambda fold=fold: one(fold) for fold in range(params.folds)]):
        stacked = scored if stacked is None else stacked.unionByName(scored)
    raw = dx.clipped(materialise(stacked, "fold_scores"))
    zeroed = raw.withColumn("y_pred", zero_below(F.col("y_pred"), params.champion_zero_below))
    sizes = dealt.groupBy((F.col("fold") + 1).alias("fold")).agg(F.count(F.lit(1)).alias("n_val"))
    total = dealt.agg(F.count(F.lit(1)).alias("n")).scalar()
    plain = raw.groupBy("fold").agg(F.avg("abs_err").alias("mae_raw"))
    after = dx.evaluate(zeroed, ["fold"]).withColumnsRenamed(
        {"MAE": "mae_post_processed", "Spearman": "spearman_post_processed"}
    )
    return (
        plain.join(after, "fold")
        .join(sizes, "fold")
        .withColumn("n_train", total - F.col("n_val"))
        .orderBy("fold")
    )


def final_predictions(train: DataFrame, test: DataFrame, columns: Sequence[str], target: str, params: ModelParams) -> DataFrame:
    """Champion fitted on all training rows, applied to the test customers."""
    both = train.withColumn("split", F.lit("train")).unionByName(
        test.withColumns({"split": F.lit("test"), target: F.lit(None).cast("double")})
    )
    data = ModelData(both, columns, target, params=params)
    model = fit_boosted(data, data.raw, F.col(Y), "absolute", stop_early=False, rounds=params.final_rounds)
    scored = predictions(model, part(data.raw, "test"))
    value = zero_below(at_least(F.col("y_pred"), 0.0), params.champion_zero_below)
    return scored.select(ID, value.alias("prediction"))


def importance_table(model, columns: Sequence[str], spark, top: int | None = None) -> DataFrame:
    """Feature importances, largest first."""
    weights = model.featureImportances.toArray()
    rows = [(c, float(w)) for c, w in zip(columns, weights)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    ordered = table.orderBy(F.desc("importance"), "feature")
    return ordered.limit(top) if top else ordered


def compare(tables: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """Results of several models in one table, best MAE first.

    ``tables`` maps a model name to its group and predictions.
    """
    stacked = None
    for name, (group, scored) in tables.items():
        rows = scored.select(ID, Y, "y_pred").withColumns({"group": F.lit(group), "model": F.lit(name)})
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return dx.evaluate(materialise(stacked, "compare"), ["group", "model"])
