"""Profiling tables and binned reports of the customer workload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog.common import Catalogue, r
from ledgerline.catalog.revenue_features import P, PREPARED, REF, day_count
from ledgerline.operators import binning, profile
from ledgerline.params import ProfileParams
from ledgerline.session import materialise
from ledgerline.sources import files, roles

catalogue = Catalogue()
PP = ProfileParams()
TARGET = "revenue_2018_2019"
TX = roles.TRANSACTION_ORACLE
BOTH = f"{roles.TRANSACTION_ORACLE}, {roles.CUSTOMER_ORACLE}"


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.transactions(spark, sf_dir)


def stacked(pairs: list[tuple[str, str]], source: str, name: str = "statistic") -> str:
    return " union all ".join(f"select '{n}' as {name}, {r(e)} as value from {source}" for n, e in pairs)


_TARGET_ROWS = [
    ("n_customers", "count(*)"),
    ("n_zero", "count(*) filter (where y = 0)"),
    ("pct_zero", "avg((y = 0)::int) * 100"),
    ("n_positive", "count(*) filter (where y > 0)"),
    ("pct_positive", "avg((y > 0)::int) * 100"),
    ("n_negative", "count(*) filter (where y < 0)"),
    ("mean", "avg(y)"),
    ("std", "stddev_samp(y)"),
    ("min", "min(y)"),
    ("max", "max(y)"),
    ("q25", "quantile_cont(y, 0.25)"),
    ("q50", "quantile_cont(y, 0.5)"),
    ("q75", "quantile_cont(y, 0.75)"),
    *[
        (f"positive_p{round(q * 100):02d}", f"quantile_cont(y, {q}) filter (where y > 0)")
        for q in PP.target_quantiles
    ],
]


@catalogue.add(
    "w1_target_summary",
    f"with {roles.CUSTOMER_ORACLE}, t as (select {TARGET} as y from train) " + stacked(_TARGET_ROWS, "t"),
)
def target_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero, positive and negative targets, description and positive quantiles."""
    return profile.target_summary(materialise(roles.train(spark, sf_dir), "train"), TARGET, PP)


_TX_COLUMNS = list(roles._transaction_columns("//"))


@catalogue.add(
    "w1_missing_report",
    f"with {TX}, m as ("
    + " union all ".join(f"select '{c}' as column_name, count(*) - count({c}) as n_missing, count(*) as n from tx" for c in _TX_COLUMNS)
    + f") select column_name, n_missing, {r('round_even(n_missing / n * 100, 2)')} as pct_missing from m",
)
def missing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values per column."""
    return profile.missing_report(transactions(spark, sf_dir))


def _top(column: str, n: int, keep_null: bool, source: str = "tx") -> str:
    where = "" if keep_null else f" where {column} is not null"
    return (
        f"(select {column} as value, count(*) as n from {source}{where} group by 1"
        f" order by n desc, value asc nulls last limit {n})"
    )


def _text_sql(column: str) -> str:
    bad = f"(select * from tx where {column} is not null and try_cast({column} as double) is null)"
    return (
        f"select '{column}' as column_name, 'top_values' as section, value, n from {_top(column, PP.top_text_values, True)}"
        f" union all select '{column}', 'n_non_numeric', null, count(*) from {bad}"
        f" union all select '{column}', 'non_numeric_values', value, n from {_top(column, PP.top_text_values, False, bad)}"
    )


@catalogue.add("w1_nonnumeric", f"with {TX} " + " union all ".join(_text_sql(c) for c in PP.text_quality_columns))
def nonnumeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns that should be numbers: frequent values and what is not numeric."""
    return profile.text_quality(transactions(spark, sf_dir), PP.text_quality_columns, PP.top_text_values)


@catalogue.add(
    "w1_tx_quality",
    f"""with {TX} select count(*) as n_rows, count(distinct cust_id) as n_customers, count(distinct sale_id) as n_orders,
 count(distinct prod_id) as n_products, min(order_date) as order_date_min, max(order_date) as order_date_max,
 min(pack_date) as pack_date_min, max(pack_date) as pack_date_max, count(returned_to_shop_id) as n_returned_items from tx""",
)
def tx_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global counts and ranges of the transactions."""
    return profile.transaction_quality(transactions(spark, sf_dir))


def _describe_sql(column: str, source: str) -> str:
    return (
        f"select '{column}' as feature, count({column}) as n, {r(f'avg({column})')} as mean, {r(f'stddev_samp({column})')} as std,"
        f" {r(f'min({column})')} as min, {r(f'max({column})')} as max, {r(f'quantile_cont({column}, 0.25)')} as q25,"
        f" {r(f'quantile_cont({column}, 0.5)')} as q50, {r(f'quantile_cont({column}, 0.75)')} as q75 from {source}"
    )


@catalogue.add(
    "w1_tx_describe",
    f"with {TX} {_describe_sql('sale_revenue', 'tx')} union all {_describe_sql('sale_discount_applied', 'tx')}",
)
def tx_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact descriptions of the money columns."""
    return profile.describe(transactions(spark, sf_dir), ["sale_revenue", "sale_discount_applied"])


_STATS = f"""stats as (select cust_id, count(*) as n_rows, count(distinct sale_id) as n_orders, count(distinct prod_id) as n_products,
 {r('sum(sale_revenue)')} as total_revenue, min(order_date) as first_order, max(order_date) as last_order,
 {day_count('max(order_date)', 'min(order_date)')} as customer_lifespan_days from tx group by 1)"""


@catalogue.add("w1_customer_stats", f"with {TX}, {_STATS} select * from stats")
def customer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity per customer."""
    return profile.customer_statistics(transactions(spark, sf_dir))


@catalogue.add(
    "w1_order_count_shares",
    f"""with {TX}, {_STATS} select {r('avg((n_orders = 1)::int) * 100')} as pct_one_order,
 {r('avg((n_orders >= 5)::int) * 100')} as pct_five_or_more from stats""",
)
def order_count_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of customers with one and with at least five orders."""
    return profile.order_count_shares(profile.customer_statistics(transactions(spark, sf_dir)))


@catalogue.add(
    "w1_coverage",
    f"""with {BOTH} select 'train' as part, count(*) filter (where cust_id in (select cust_id from tx)) as n_in_transactions,
 count(*) as n_customers from train union all
 select 'test', count(*) filter (where cust_id in (select cust_id from tx)), count(*) from test""",
)
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and test customers seen in the transactions."""
    stats = transactions(spark, sf_dir).groupBy("cust_id").agg(F.count(F.lit(1)).alias("n"))
    return profile.coverage(roles.train(spark, sf_dir), roles.test(spark, sf_dir), stats)


_CATEGORIES = [c for c in PP.categorical_columns if c in _TX_COLUMNS]


@catalogue.add(
    "w1_cardinality",
    f"with {TX} "
    + " union all ".join(
        f"select '{c}' as column_name, count(distinct {c}) as n_unique, {r(f'avg(({c} is null)::int) * 100')} as pct_missing from tx"
        for c in _CATEGORIES
    ),
)
def cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values and missing share of the categorical columns."""
    return profile.cardinality(transactions(spark, sf_dir), PP.categorical_columns)


@catalogue.add("w1_top_brands", f"with {TX} select * from {_top('prod_brand', PP.top_brand_count, False)}")
def top_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent brands."""
    return profile.value_counts(transactions(spark, sf_dir), "prod_brand", PP.top_brand_count)


@catalogue.add(
    "w1_type_counts",
    f"with {TX} select prod_type_1 as value, count(*) as n from tx group by 1",
)
def type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items per type, missing kept."""
    return profile.value_counts(transactions(spark, sf_dir), "prod_type_1", None, True)


@catalogue.add("w1_top_seasons", f"with {TX} select * from {_top('prod_season', PP.top_season_count, True)}")
def top_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent seasons, missing kept."""
    return profile.value_counts(transactions(spark, sf_dir), "prod_season", PP.top_season_count, True)


QUICK = f"""quick as (select cust_id, count(distinct sale_id) as n_orders, count(*) as n_items,
 sum(sale_revenue) as total_revenue_1617, avg(sale_revenue) as mean_revenue, max(order_date) as last_order,
 min(order_date) as first_order, sum(sale_discount_applied) as total_discount, count(distinct prod_brand) as n_unique_brands,
 count(returned_to_shop_id) as n_returns, {day_count(REF, 'max(order_date)')} as recency_days,
 {day_count('max(order_date)', 'min(order_date)')} as tenure_days, count(returned_to_shop_id) / count(*) as return_rate
 from tx group by 1),
 qf as (select train.*, quick.* exclude (cust_id), ({TARGET} > 0)::int as is_returner from train left join quick using (cust_id))"""
_MONEY = ("total_revenue_1617", "mean_revenue", "total_discount", "return_rate")


def quick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.quick_features(
        transactions(spark, sf_dir), roles.train(spark, sf_dir), TARGET, P.reference_date, PP
    )


@catalogue.add(
    "w1_quick_features",
    f"with {BOTH}, {QUICK} select * replace ("
    + ", ".join(f"{r(c)} as {c}" for c in _MONEY)
    + ") from qf",
)
def quick_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Light customer features with the target."""
    return quick(spark, sf_dir)


@catalogue.add(
    "w1_target_corr",
    f"with {BOTH}, {QUICK} "
    + " union all ".join(f"select '{c}' as feature, {r(f'corr({c}, {TARGET})')} as correlation from qf" for c in PP.quick_columns),
)
def target_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of the light features with the target."""
    return profile.target_correlations(quick(spark, sf_dir), PP.quick_columns, TARGET)


def _compare(c: str) -> str:
    no, yes = f"avg({c}) filter (where is_returner = 0)", f"avg({c}) filter (where is_returner = 1)"
    return (
        f"select '{c}' as feature, {r(no)} as non_returner, {r(yes)} as returner,"
        f" {r(f'case when {no} <> 0 then {yes} / {no} end')} as \"ratio_R_to_NR\" from qf"
    )


@catalogue.add("w1_group_compare", f"with {BOTH}, {QUICK} " + " union all ".join(_compare(c) for c in PP.quick_columns))
def group_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature means of returners and others."""
    return profile.compare_groups(
        quick(spark, sf_dir), PP.quick_columns, F.col("is_returner") == 1, ("returner", "non_returner"), "ratio_R_to_NR"
    )


@catalogue.add(
    "w1_sign_counts",
    f"""with {TX} select count(*) filter (where sale_revenue = 0) as n_zero_revenue,
 count(*) filter (where sale_revenue < 0) as n_negative_revenue, count(returned_to_shop_id) as n_returned from tx""",
)
def sign_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero and negative revenue rows, returned rows."""
    return profile.sign_counts(transactions(spark, sf_dir))


@catalogue.add(
    "w1_ratio_to_baseline",
    f"""with g as (select event_type, round(avg(value), 6) as mean_value, round(stddev_samp(value), 6) as std_value, count(*) as n_events from events group by 1),
 b as (select * from g where event_type = 'view')
 select g.event_type, {r('g.mean_value')} as mean_value, {r('g.std_value')} as std_value, g.n_events,
 {r('g.mean_value / b.mean_value')} as mean_value_vs_view, {r('g.n_events / b.n_events')} as n_events_vs_view from g, b""",
)
def ratio_to_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each group's figures over those of the baseline group."""
    groups = roles.table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.round(F.avg("value"), 6).alias("mean_value"),
        F.round(F.stddev_samp("value"), 6).alias("std_value"),
        F.count(F.lit(1)).alias("n_events"),
    )
    return profile.ratio_to_baseline(groups, "event_type", "view", ["mean_value", "n_events"])


def _hist_sql(source: str, value: str, bins: int, clip: float | None = None) -> str:
    shown = f"least({value}, {clip})" if clip is not None else value
    return f"""v as (select {shown}::double as v from {source} where {value} is not null),
 e as (select case when min(v) = max(v) then min(v) - 0.5 else min(v) end as lo, case when min(v) = max(v) then max(v) + 0.5 else max(v) end as hi from v),
 w as (select lo, hi, (hi - lo) / {bins} as width from e),
 c as (select least(floor((v - lo) / width), {bins - 1})::int as bin_no, count(*) as n from v, w group by 1)
 select i::int as bin_no, {r('lo + i * width')} as lower, {r('lo + (i + 1) * width')} as upper, coalesce(n, 0) as n
 from range({bins}) t(i) cross join w left join c on c.bin_no = i"""


@catalogue.add("w1_hist_target", f"with {roles.CUSTOMER_ORACLE}, " + _hist_sql("train", TARGET, PP.target_bins))
def hist_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of the target."""
    return binning.histogram(roles.train(spark, sf_dir), F.col(TARGET), PP.target_bins)


@catalogue.add(
    "w1_hist_log_target",
    f"with {roles.CUSTOMER_ORACLE}, pos as (select ln(1 + {TARGET}) as ly from train where {TARGET} > 0), "
    + _hist_sql("pos", "ly", PP.target_bins),
)
def hist_log_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of log1p of the positive targets."""
    positive = roles.train(spark, sf_dir).filter(F.col(TARGET) > 0)
    return binning.histogram(positive, F.log1p(TARGET), PP.target_bins)


@catalogue.add(
    "w1_hist_orders",
    f"with {TX}, s as (select cust_id, count(distinct sale_id) as n_orders from tx group by 1), "
    + _hist_sql("s", "n_orders", PP.order_bins, PP.order_clip),
)
def hist_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by number of orders, clipped."""
    stats = profile.customer_statistics(transactions(spark, sf_dir))
    return binning.histogram(stats, F.col("n_orders"), PP.order_bins, PP.order_clip)


@catalogue.add(
    "w1_hist_revenue",
    f"with {TX}, s as (select cust_id, round(sum(sale_revenue), 2) as rev from tx group by 1), "
    + _hist_sql("s", "rev", PP.revenue_bins, PP.revenue_clip),
)
def hist_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by revenue, clipped."""
    stats = profile.customer_statistics(transactions(spark, sf_dir))
    return binning.histogram(stats, F.round("total_revenue", 2), PP.revenue_bins, PP.revenue_clip)


def _outcome() -> list:
    return [
        F.avg("is_returner").alias("returner_rate"),
        F.avg(TARGET).alias("mean_revenue"),
        F.count(F.lit(1)).alias("n"),
    ]


def _qbin_sql(column: str, q: int) -> str:
    """Quantile bins in SQL: distinct edges, right-closed, first edge included."""
    edges = ", ".join(f"quantile_cont(x, {i / q!r})" for i in range(q + 1))
    return f"""src as (select {column} as x, is_returner, {TARGET} as y from qf),
 el as (select distinct unnest([{edges}]) as edge from src where x is not null),
 bins as (select row_number() over (order by edge) - 1 as bin_no, edge as lower, lead(edge) over (order by edge) as upper from el),
 b as (select * from bins where upper is not null)
 select b.bin_no::int as bin_no, {r('b.lower')} as lower, {r('b.upper')} as upper, {r('avg(is_returner)')} as returner_rate,
 {r('avg(y)')} as mean_revenue, count(x) as n from b left join src on (x > b.lower or (b.bin_no = 0 and x = b.lower)) and x <= b.upper
 group by b.bin_no, b.lower, b.upper"""


@catalogue.add("w1_qbin_recency", f"with {BOTH}, {QUICK}, " + _qbin_sql("recency_days", PP.recency_bins))
def qbin_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome by recency decile."""
    q = materialise(quick(spark, sf_dir), "quick")
    edges = binning.quantile_edges(q, "recency_days", PP.recency_bins)
    return binning.binned(q, F.col("recency_days"), edges, _outcome(), zero_filled=["n"])


_SPEND = QUICK.replace("sum(sale_revenue) as total_revenue_1617", "round(sum(sale_revenue), 2) as total_revenue_1617")


@catalogue.add("w1_qbin_spend", f"with {BOTH}, {_SPEND}, " + _qbin_sql("total_revenue_1617", PP.spend_bins))
def qbin_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome by spend decile."""
    q = quick(spark, sf_dir).withColumn("total_revenue_1617", F.round("total_revenue_1617", 2))
    q = materialise(q, "quick")
    edges = binning.quantile_edges(q, "total_revenue_1617", PP.spend_bins)
    return binning.binned(q, F.col("total_revenue_1617"), edges, _outcome(), zero_filled=["n"])


_FREQ = ", ".join(
    f"({i}, {float(lo)}, {float(hi)}, '{label}')"
    for i, (lo, hi, label) in enumerate(zip(PP.frequency_edges, PP.frequency_edges[1:], PP.frequency_labels))
)


@catalogue.add(
    "w1_freq_bucket",
    f"""with {BOTH}, {QUICK}, b(bin_no, lower, upper, label) as (values {_FREQ})
 select bin_no, {r('lower')} as lower, {r('upper')} as upper, label, {r('avg(is_returner)')} as returner_rate,
 {r(f'avg({TARGET})')} as mean_revenue, count(n_orders) as n from b left join qf on n_orders > lower and n_orders <= upper group by 1, lower, upper, 4""",
)
def freq_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome by order-count bucket."""
    return binning.binned(
        quick(spark, sf_dir),
        F.col("n_orders"),
        PP.frequency_edges,
        _outcome(),
        include_lowest=False,
        labels=PP.frequency_labels,
        zero_filled=["n"],
    )


@catalogue.add(
    "w1_contract_repair",
    f"""with {TX} select cust_id, sale_id, prod_id, sale_revenue, prod_brand, 'unknown' as prod_color, cast(null as varchar) as prod_season,
 0.0e0 as prod_outlet, 'unknown' as prod_type_3 from tx""",
)
def contract_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absent optional columns come back with their defaults."""
    narrow = transactions(spark, sf_dir).drop("prod_color", "prod_season", "prod_outlet")
    full = files.with_transaction_contract(narrow)
    return full.select(
        "cust_id", "sale_id", "prod_id", "sale_revenue", "prod_brand", "prod_color", "prod_season", "prod_outlet", "prod_type_3"
    )
