import math

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import prep
from ledgerline.plans.features import CustomerFeatures, prepare_transactions, quality_report
from ledgerline.sources.files import with_transaction_contract


@pytest.fixture(scope="module")
def matrix(shop):
    train, test, tx = shop
    return CustomerFeatures(tx, train, test, store=True).matrix().cache()


def test_contract_of_the_matrix(matrix, shop):
    train, test, _ = shop
    rows = {r.cust_id: r for r in matrix.collect()}
    assert set(rows) == {21, 22, 23, 24, 25, 31, 32}
    assert "dominant_type_1_women" in matrix.columns
    assert "dominant_type_1_unknown" not in matrix.columns
    assert not [f for f in matrix.schema.fields if f.dataType.simpleString() == "string"]
    # 11 tiers with four types and two years, dates dropped and the type one-hot, plus the id.
    assert len(matrix.columns) == 106


def test_values_of_one_customer(matrix):
    row = matrix.filter("cust_id = 22").first()
    assert row.n_items == 2 and row.n_orders == 2
    assert row.total_revenue == pytest.approx(100.0)
    assert row.median_item_revenue == pytest.approx(50.0)
    assert row.total_discount_amt == 4.0 and row.n_discounted_items == 1
    assert row.gross_revenue == pytest.approx(104.0)
    assert row.mean_inter_purchase_days == 40.0 and row.std_inter_purchase_days is None
    assert row.revenue_2016 == 0.0 and row.revenue_growth_ratio == 20.0
    assert row.buys_gabor == 0 and row.is_repeat_buyer == 1
    assert row.log_n_orders == pytest.approx(math.log(3))
    assert row.dominant_type_1_boys == 1 and row.buys_kids == 1


def test_two_items_of_one_order(matrix):
    row = matrix.filter("cust_id = 21").first()
    assert (row.n_items, row.n_orders, row.n_items_per_order) == (3, 2, 1.5)
    assert row.mean_order_revenue == pytest.approx((100.0 + 30.0) / 2)
    assert row.revenue_2016 == 100.0 and row.revenue_growth_ratio == pytest.approx(0.3)
    assert row.n_orders_in_holiday == 1 and row.n_unique_top_brands == row.buys_gabor + row.buys_nike


def test_customers_without_history_stay(shop, spark):
    train, test, tx = shop
    features = CustomerFeatures(tx.filter("cust_id <> 32"), train, test)
    row = features.matrix().filter("cust_id = 32").first()
    assert row.n_items is None and row.buys_nike == 0 and row.n_unique_top_brands == 0


def test_popularity_uses_training_customers_only(shop):
    train, test, tx = shop
    counts = {r.prod_brand: r.popularity for r in CustomerFeatures(tx, train, test).popularity_counts("prod_brand").collect()}
    assert counts == {"Gabor": 2, "Nike": 3, "Other": 4}


def test_missing_required_columns_are_named(shop):
    with pytest.raises(ValueError, match="prod_id"):
        with_transaction_contract(shop[2].drop("prod_id"))


def test_optional_columns_get_defaults(shop):
    full = with_transaction_contract(shop[2].drop("prod_color", "prod_season", "prod_outlet"))
    row = full.first()
    assert row.prod_color == "unknown" and row.prod_season is None and row.prod_outlet == 0.0
    assert row.prod_type_5 == "unknown" and row.prod_print is None


def test_nan_counts_as_missing(shop, spark):
    tx = shop[2].withColumn("sale_revenue", F.when(F.col("sale_id") == 5, F.lit(float("nan"))).otherwise(F.col("sale_revenue")))
    train, test, _ = shop
    row = CustomerFeatures(tx, train, test).raw([1]).filter("cust_id = 22").first()
    assert row.total_revenue == pytest.approx(46.0) and row.n_items == 2 and row.std_item_revenue is None


def test_prepared_columns(shop):
    row = prepare_transactions(shop[2]).filter("sale_id = 6").first()
    assert (row.order_year, row.order_month, row.order_quarter) == (2017, "2017-03", "2017Q1")
    assert row.collection_year == 2016 and row.prod_size == 30.0 and row.has_discount == 1 and row.is_returned == 0


def test_quality_report(matrix, shop):
    train, test, _ = shop
    got = {(r.section, r.name): r.value for r in quality_report(matrix, train, test).collect()}
    assert got["coverage", "train_in_matrix"] == 5 and got["coverage", "n_test"] == 2
    assert got["shape", "rows"] == 7
    assert max(v for (s, _), v in got.items() if s == "missing_pct") == 100.0


def test_imputing_leaves_no_missing_value(matrix):
    columns = [c for c in matrix.columns if c != "cust_id"]
    medians = prep.fit_medians(matrix, columns)
    filled = prep.impute(matrix, medians)
    missing = filled.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in columns]).first()
    assert not any(missing)
    # No value at all: kept, as zero.
    assert medians["std_inter_purchase_days"] == 0.0


def test_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaling = prep.fit_scaling(df, ["a", "b"])
    assert scaling["a"] == (2.0, 1.0) and scaling["b"] == (5.0, 1.0)
    assert [tuple(r) for r in prep.scale(df, scaling).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_splits_are_stratified_and_repeatable(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.when(F.col("id") < 30, 1.0).otherwise(0.0).alias("y"))
    first = prep.stratified_split(df, "k", "y", 0.2, 11)
    sizes = {tuple(r[:2]): r[2] for r in first.groupBy("split", "y").count().collect()}
    assert sizes == {("val", 1.0): 6, ("train", 1.0): 24, ("val", 0.0): 14, ("train", 0.0): 56}
    again = prep.stratified_split(df.repartition(3), "k", "y", 0.2, 11)
    assert {tuple(r) for r in first.collect()} == {tuple(r) for r in again.collect()}
    plain = {r[0]: r[1] for r in prep.plain_split(df, "k", 42, 0.3, 0.5).groupBy("split").count().collect()}
    assert plain == {"train": 70, "val": 15, "test": 15}
    folds = prep.stratified_folds(df, "k", "y", 5, 11).groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("p"))
    assert {(r.n, r.p) for r in folds.collect()} == {(20, 6.0)}


def test_shuffled_positions_with_repeated_and_missing_keys(spark):
    rows = [(k, "x" * 50, float(k or 0)) for k in [1, 1, 2, 3, 3, 3, None, None, 4]]
    df = spark.createDataFrame(rows, "k bigint, wide string, y double").repartition(4)
    placed = prep._shuffled(df, "k", 5, [])
    assert placed.columns == ["k", "wide", "y", "_pos"]
    order = [r.k for r in sorted(placed.collect(), key=lambda r: r._pos)]
    assert sorted(r._pos for r in placed.collect()) == list(range(1, 10))
    assert sorted(order, key=lambda k: k or 0) == [None, None, 1, 1, 2, 3, 3, 3, 4] and order[:2] == [None, None]
    assert len([k for i, k in enumerate(order) if i == 0 or order[i - 1] != k]) == 5
    # Whole rows are not gathered for their order: no window over a stratum sees the wide column.
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Window" in line and "sum(" in line and "wide" in line]


def test_alignment_raises_on_missing_rows(spark):
    features = spark.createDataFrame([(1, 2.0)], "k bigint, x double")
    with pytest.raises(ValueError, match="alignment"):
        prep.align(features, spark.createDataFrame([(1,), (2,)], "k bigint"), "k")
    with pytest.raises(ValueError, match="text"):
        prep.align(features.withColumn("t", F.lit("a")), features.select("k"), "k")
