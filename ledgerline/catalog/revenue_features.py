"""Feature tiers and the whole customer matrix, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog.common import Catalogue, r
from ledgerline.functions.expr import brand_flag_name
from ledgerline.params import (
    CLASSIC_BRANDS,
    PREMIUM_BRANDS,
    SPORT_BRANDS,
    TOP_BRANDS,
    FeatureParams,
)
from ledgerline.plans.features import CustomerFeatures, quality_report
from ledgerline.session import materialise
from ledgerline.sources import roles

catalogue = Catalogue()
P = FeatureParams()
ID_COLUMNS = ("cust_id", "split", "fold")
TYPES = sorted({*roles.TYPE_ROLES.values()})


def customer_features(spark: SparkSession, sf_dir: str, store: bool = False) -> CustomerFeatures:
    return CustomerFeatures(
        roles.transactions(spark, sf_dir), roles.train(spark, sf_dir), roles.test(spark, sf_dir), P, store
    )


# -- SQL twins ---------------------------------------------------------------------------


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


REF = f"timestamp '{P.reference_date}'"

PREPARED = (
    roles.TRANSACTION_ORACLE
    + ", "
    + roles.CUSTOMER_ORACLE
    + """, dig as (select *, regexp_replace(prod_season, '[^0-9]', '', 'g') as digits from tx),
prep as (select * exclude (prod_size), try_cast(prod_size as double) as prod_size,
  cast(year(order_date) as int) as order_year, strftime(order_date, '%Y-%m') as order_month,
  concat(year(order_date), 'Q', quarter(order_date)) as order_quarter, month(order_date) as order_month_num,
  (returned_to_shop_id is not null)::int as is_returned, abs(sale_discount_applied) as abs_discount,
  (abs(sale_discount_applied) > 0)::int as has_discount,
  case when length(digits) >= 2 then case when right(digits, 2)::int < 50 then 2000 + right(digits, 2)::int
       else 1900 + right(digits, 2)::int end end as collection_year from dig),
ord as (select cust_id, sale_id, sum(sale_revenue) as order_revenue, max(is_returned) as order_returned,
  min(order_date) as order_day from prep group by 1, 2)"""
)


def day_count(later: str, earlier: str) -> str:
    return f"cast(floor(epoch({later} - {earlier}) / 86400) as int)"


def tier_sql(final: str, more: str = "") -> str:
    return f"with {PREPARED}{more} {final}"


ORDERS = """, oc as (select cust_id, count(*) as n_orders, avg(order_revenue) as mean_order_revenue,
 cast(sum(order_returned) as bigint) as n_orders_with_return from ord group by 1)"""

TIER_SQL: dict[int, str] = {}
TIER_SQL[1] = tier_sql(
    f"""select i.cust_id, n_items, {r('total_revenue')} as total_revenue, {r('median_item')} as median_item_revenue,
 {r('max_item')} as max_item_revenue, {r('std_item')} as std_item_revenue, last_order_date, first_order_date,
 n_unique_brands, n_orders, {r('mean_order_revenue')} as mean_order_revenue, {r('n_items / n_orders')} as n_items_per_order,
 {day_count(REF, 'last_order_date')} as recency_days, {day_count(REF, 'first_order_date')} as first_order_days_ago,
 {day_count('last_order_date', 'first_order_date')} as tenure_days, {r('gross')} as gross_revenue,
 {r('case when gross > 0 then total_revenue / gross else 1.0 end')} as net_to_gross_revenue_ratio
 from i join oc using (cust_id)""",
    ORDERS
    + """, i as (select cust_id, count(*) as n_items, sum(sale_revenue) as total_revenue,
 quantile_cont(sale_revenue, 0.5) as median_item, max(sale_revenue) as max_item, stddev_samp(sale_revenue) as std_item,
 max(order_date) as last_order_date, min(order_date) as first_order_date, count(distinct prod_brand) as n_unique_brands,
 coalesce(sum(sale_revenue + abs_discount) filter (where is_returned = 0), 0) as gross from prep group by 1)""",
)
TIER_SQL[2] = tier_sql(
    f"""select i.cust_id, n_returns, n_orders_with_return, {r('lost')} as revenue_lost_to_returns,
 {r('n_returns / n_items')} as return_rate, {r('n_orders_with_return / n_orders')} as pct_orders_with_return
 from i join oc using (cust_id)""",
    ORDERS
    + """, i as (select cust_id, count(*) as n_items, cast(sum(is_returned) as bigint) as n_returns,
 abs(coalesce(sum(sale_revenue) filter (where sale_revenue < 0), 0)) as lost from prep group by 1)""",
)
TIER_SQL[3] = tier_sql(
    f"""select cust_id, {r('disc')} as total_discount_amt, {r('mean_disc')} as mean_discount_amt,
 {r('max_disc')} as max_discount_amt, n_disc as n_discounted_items, {r('n_disc / n_items')} as pct_items_discounted,
 {r('case when rev + disc > 0 then disc / (rev + disc) else 0 end')} as discount_rate from i""",
    """, i as (select cust_id, count(*) as n_items, sum(sale_revenue) as rev, sum(abs_discount) as disc,
 avg(abs_discount) as mean_disc, max(abs_discount) as max_disc, cast(sum(has_discount) as bigint) as n_disc from prep group by 1)""",
)
TIER_SQL[4] = tier_sql(
    f"""select cust_id, {r('ln(1 + n_orders)')} as log_n_orders, {r('ln(1 + greatest(rev, 0))')} as log_total_revenue,
 (n_orders = 1)::int as is_one_time_buyer, (n_orders >= 2)::int as is_repeat_buyer, (n_orders >= 10)::int as is_loyal,
 (rev > 250)::int as is_high_value_customer, (n_orders >= 5)::int as is_high_frequency_customer,
 ({day_count(REF, 'last_day')} <= 90)::int as bought_recently from i join oc using (cust_id)""",
    ORDERS
    + ", i as (select cust_id, round(sum(sale_revenue), 6) as rev, max(order_date) as last_day from prep group by 1)",
)
TIER_SQL[5] = tier_sql(
    f"""select i.cust_id, n_active_months, n_active_quarters, {r('r16')} as revenue_2016, {r('r17')} as revenue_2017,
 {r('r17 - r16')} as revenue_trend,
 {r('least(case when r16 > 0 then r17 / r16 when r17 > 0 then 20 else 0 end, 20)')} as revenue_growth_ratio,
 {r('mean_gap')} as mean_inter_purchase_days, {r('std_gap')} as std_inter_purchase_days,
 n_orders_last_3m, {r('r3')} as revenue_last_3m, n_orders_last_6m, {r('r6')} as revenue_last_6m, n_returns_last_6m,
 {r('d6')} as discount_amt_last_6m, {r('case when rev > 0 then r6 / rev else 0 end')} as share_revenue_last_6m,
 {r('case when n_orders > 0 then n_orders_last_6m / n_orders else 0 end')} as share_orders_last_6m,
 (r17 > 0)::int as bought_in_2017 from i join oc using (cust_id) left join gap using (cust_id)""",
    ORDERS
    + f""", lagged as (select cust_id, {day_count('order_day', 'lag(order_day) over (partition by cust_id order by order_day, sale_id)')} as gap_days from ord),
 gap as (select cust_id, avg(gap_days) as mean_gap, stddev_samp(gap_days) as std_gap from lagged group by 1),
 i as (select cust_id, round(sum(sale_revenue), 6) as rev, count(distinct order_month) as n_active_months,
 count(distinct order_quarter) as n_active_quarters,
 round(coalesce(sum(sale_revenue) filter (where order_year = 2016), 0), 6) as r16,
 round(coalesce(sum(sale_revenue) filter (where order_year = 2017), 0), 6) as r17,
 count(distinct sale_id) filter (where order_date >= {REF} - interval 90 day) as n_orders_last_3m,
 coalesce(sum(sale_revenue) filter (where order_date >= {REF} - interval 90 day), 0) as r3,
 count(distinct sale_id) filter (where order_date >= {REF} - interval 180 day) as n_orders_last_6m,
 coalesce(sum(sale_revenue) filter (where order_date >= {REF} - interval 180 day), 0) as r6,
 cast(coalesce(sum(is_returned) filter (where order_date >= {REF} - interval 180 day), 0) as bigint) as n_returns_last_6m,
 coalesce(sum(abs_discount) filter (where order_date >= {REF} - interval 180 day), 0) as d6 from prep group by 1)""",
)
TIER_SQL[6] = tier_sql(
    f"""select cust_id, count(distinct prod_id) as n_unique_products, count(distinct prod_color) as n_unique_colors,
 count(distinct prod_season) as n_unique_seasons, count(distinct prod_size) as n_unique_sizes,
 {r('avg(prod_size)')} as mean_prod_size, {r('stddev_samp(prod_size)')} as std_prod_size from prep group by 1"""
)
_PCT = ", ".join(f"{r(f'sum((prod_type_1 = {quoted([k])})::int) / count(prod_type_1)')} as pct_{k}" for k in TYPES)


def _any_type(kinds) -> str:
    return f"max(coalesce((prod_type_1 in ({quoted(kinds)}))::int, 0))"


TIER_SQL[7] = tier_sql(
    f"""select cust_id, {_PCT}, count(distinct prod_type_1) as n_distinct_type_1,
 coalesce(any_value(kind), 'unknown') as dominant_type_1,
 {_any_type(P.kids_types)} as buys_kids, {_any_type(P.adult_types)} as buys_adults,
 (count(distinct prod_type_1) >= 3)::int as buys_for_family,
 (min(coalesce((prod_type_1 = 'women')::int, 0)) = 1)::int as is_purely_women_buyer
 from prep left join modes using (cust_id) group by 1""",
    """, kinds as (select cust_id, prod_type_1 as kind, count(*) as n from prep where prod_type_1 is not null group by 1, 2),
 modes as (select cust_id, kind from (select *, row_number() over (partition by cust_id order by n desc, kind) as k from kinds) where k = 1)""",
)
_FLAGS = {brand_flag_name(b): b for b in TOP_BRANDS}
TIER_SQL[8] = tier_sql(
    "select cust_id, "
    + ", ".join(f"case when tops > 0 then {n} end as {n}" for n in _FLAGS)
    + f", case when tops > 0 then {' + '.join(_FLAGS)} end as n_unique_top_brands, {r('top_share')} as pct_orders_top15_brand,"
    + " is_premium_brand_buyer, is_sport_brand_buyer, is_classic_brand_buyer from i",
    ", i as (select cust_id, "
    + ", ".join(f"max((prod_brand = '{b}')::int) as {n}" for n, b in _FLAGS.items())
    + f", sum((prod_brand in ({quoted(TOP_BRANDS)}))::int) as tops, avg((prod_brand in ({quoted(TOP_BRANDS)}))::int) as top_share,"
    + f" max((prod_brand in ({quoted(PREMIUM_BRANDS)}))::int) as is_premium_brand_buyer,"
    + f" max((prod_brand in ({quoted(SPORT_BRANDS)}))::int) as is_sport_brand_buyer,"
    + f" max((prod_brand in ({quoted(CLASSIC_BRANDS)}))::int) as is_classic_brand_buyer from prep group by 1)",
)
TIER_SQL[9] = tier_sql(
    f"""select cust_id, {r('avg(collection_year)')} as mean_collection_year,
 count(distinct collection_year) as n_unique_collection_years,
 {r('avg(coalesce((collection_year >= 2017)::int, 0))')} as pct_recent_collection,
 {r('avg(coalesce((collection_year <= 2015)::int, 0))')} as pct_old_stock,
 {r('avg(order_year - collection_year)')} as mean_collection_lag,
 count(distinct sale_id) filter (where order_month_num in (11, 12)) as n_orders_in_holiday from prep group by 1"""
)
TIER_SQL[10] = tier_sql(
    f"""select cust_id, {r('avg(prod_web_only)')} as pct_web_only, {r('avg(prod_outlet)')} as mean_outlet,
 {r('avg((prod_outlet > (select quantile_cont(prod_outlet, 0.5) from prep))::int)')} as pct_outlet_high,
 {r('avg((prod_comfort_sole is not null)::int)')} as pct_with_comfort_features,
 {r('avg((prod_comfort_wear is not null)::int)')} as pct_with_comfort_wear,
 {r('avg((prod_heel is null)::int)')} as missing_prod_heel_rate,
 {r('avg((prod_clasp is null)::int)')} as missing_prod_clasp_rate from prep group by 1"""
)
TIER_SQL[11] = tier_sql(
    f"""select p.cust_id, {r('avg(ln(1 + coalesce(b.n, 0)))')} as mean_log_brand_popularity,
 {r('avg(ln(1 + coalesce(q.n, 0)))')} as mean_log_product_popularity,
 {r('avg((coalesce(b.n, 0) < (select quantile_cont(n, 0.2) from bc))::int)')} as rare_brand_item_rate
 from prep p left join bc b on p.prod_brand = b.prod_brand left join pc q on p.prod_id = q.prod_id group by 1""",
    """, bc as (select prod_brand, count(*) as n from prep where cust_id in (select cust_id from train) group by 1),
 pc as (select prod_id, count(*) as n from prep where cust_id in (select cust_id from train) group by 1)""",
)

TIER_NAMES = {
    1: "core",
    2: "returns",
    3: "discounts",
    4: "engagement",
    5: "time",
    6: "diversity",
    7: "types",
    8: "brands",
    9: "season",
    10: "channel",
    11: "popularity",
}


def _register_tier(tier: int) -> None:
    @catalogue.add(f"w1_tier{tier:02d}_{TIER_NAMES[tier]}", TIER_SQL[tier])
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        # A tier that reads the transactions several times stores them first.
        several = len(CustomerFeatures.BLOCKS[tier]) > 1 or tier == 11
        return customer_features(spark, sf_dir, store=several).raw([tier])


for _tier in TIER_SQL:
    _register_tier(_tier)


def _cleaned(tier_columns: dict[int, list[str]]) -> str:
    """SQL of the cleaned matrix: the tiers joined, reindexed, flags filled, types one-hot."""
    parts, columns = [], []
    for tier, names in tier_columns.items():
        for n in names:
            if n in ("last_order_date", "first_order_date"):
                continue
            if n == "dominant_type_1":
                columns += [f"coalesce((t7.dominant_type_1 = '{k}')::int, 0) as dominant_type_1_{k}" for k in P.dominant_types]
            elif n.startswith("buys_") or n == "n_unique_top_brands":
                columns.append(f"coalesce(t{tier}.{n}, 0) as {n}")
            else:
                columns.append(f"t{tier}.{n}")
        parts.append(f" left join ({TIER_SQL[tier]}) t{tier} on t{tier}.cust_id = ids.cust_id")
    ids = f"(with {PREPARED} select cust_id from prep union select cust_id from train union select cust_id from test) ids"
    return f"select ids.cust_id, {', '.join(columns)} from {ids}{''.join(parts)}"


TIER_COLUMNS = {
    1: "n_items total_revenue median_item_revenue max_item_revenue std_item_revenue last_order_date first_order_date n_unique_brands n_orders mean_order_revenue n_items_per_order recency_days first_order_days_ago tenure_days gross_revenue net_to_gross_revenue_ratio",
    2: "n_returns n_orders_with_return revenue_lost_to_returns return_rate pct_orders_with_return",
    3: "total_discount_amt mean_discount_amt max_discount_amt n_discounted_items pct_items_discounted discount_rate",
    4: "log_n_orders log_total_revenue is_one_time_buyer is_repeat_buyer is_loyal is_high_value_customer is_high_frequency_customer bought_recently",
    5: "n_active_months n_active_quarters revenue_2016 revenue_2017 revenue_trend revenue_growth_ratio mean_inter_purchase_days std_inter_purchase_days n_orders_last_3m revenue_last_3m n_orders_last_6m revenue_last_6m n_returns_last_6m discount_amt_last_6m share_revenue_last_6m share_orders_last_6m bought_in_2017",
    6: "n_unique_products n_unique_colors n_unique_seasons n_unique_sizes mean_prod_size std_prod_size",
    7: " ".join(f"pct_{k}" for k in TYPES)
    + " n_distinct_type_1 dominant_type_1 buys_kids buys_adults buys_for_family is_purely_women_buyer",
    8: " ".join(_FLAGS)
    + " n_unique_top_brands pct_orders_top15_brand is_premium_brand_buyer is_sport_brand_buyer is_classic_brand_buyer",
    9: "mean_collection_year n_unique_collection_years pct_recent_collection pct_old_stock mean_collection_lag n_orders_in_holiday",
    10: "pct_web_only mean_outlet pct_outlet_high pct_with_comfort_features pct_with_comfort_wear missing_prod_heel_rate missing_prod_clasp_rate",
    11: "mean_log_brand_popularity mean_log_product_popularity rare_brand_item_rate",
}
MATRIX_SQL = _cleaned({t: c.split() for t, c in TIER_COLUMNS.items()})


@catalogue.add("w1_matrix_clean", MATRIX_SQL)
def matrix_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole matrix, ready for models."""
    return customer_features(spark, sf_dir, store=True).matrix()


MATRIX_NAMES = [
    n
    for t, names in TIER_COLUMNS.items()
    for n in names.split()
    if n not in ("last_order_date", "first_order_date", "dominant_type_1")
] + [f"dominant_type_1_{k}" for k in P.dominant_types]


@catalogue.add(
    "w1_matrix_quality",
    f"with m as materialized ({MATRIX_SQL}), {roles.CUSTOMER_ORACLE}, miss as ("
    + " union all ".join(f"select '{n}' as name, avg(({n} is null)::int) * 100 as value from m" for n in MATRIX_NAMES)
    + f"""), top as (select name, value from miss order by value desc, name limit 10)
 select 'shape' as section, 'rows' as name, cast(count(*) as double) as value from m
 union all select 'shape', 'columns', {float(len(MATRIX_NAMES))}
 union all select 'coverage', 'train_in_matrix', cast(count(*) as double) from train where cust_id in (select cust_id from m)
 union all select 'coverage', 'n_train', cast(count(*) as double) from train
 union all select 'coverage', 'test_in_matrix', cast(count(*) as double) from test where cust_id in (select cust_id from m)
 union all select 'coverage', 'n_test', cast(count(*) as double) from test
 union all select 'missing_pct', name, {r('value')} from top""",
)
def matrix_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shape, coverage and most incomplete columns of the matrix."""
    features = customer_features(spark, sf_dir, store=True)
    matrix = materialise(features.matrix(), "matrix")
    return quality_report(matrix, features.train, features.test)


@catalogue.add(
    "w1_core_rfm",
    f"""with {PREPARED} select cust_id, {day_count(REF, 'max(order_date)')} as recency_days,
 count(distinct sale_id) as n_orders, {r('sum(sale_revenue)')} as total_revenue from prep group by 1""",
)
def core_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recency, frequency and revenue per customer."""
    return customer_features(spark, sf_dir).recency_frequency_money()


@catalogue.add(
    "w1_popularity_thresholds",
    f"""with {PREPARED}, bc as (select prod_brand as v, count(*) as n from prep where cust_id in (select cust_id from train) group by 1),
 pc as (select prod_id as v, count(*) as n from prep where cust_id in (select cust_id from train) group by 1)
 select 'prod_brand' as column_name, count(*) as n_values, {r('quantile_cont(n, 0.2)')} as rare_threshold from bc
 union all select 'prod_id', count(*), {r('quantile_cont(n, 0.2)')} from pc""",
)
def popularity_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of values and the count below which one is rare, from training customers."""
    from ledgerline.operators.quantiles import grouped_quantiles

    features = customer_features(spark, sf_dir, store=True)
    parts = []
    for column in ("prod_brand", "prod_id"):
        counts = materialise(features.popularity_counts(column), "popularity")
        limit = grouped_quantiles(counts, [], "popularity", {"q": P.rare_quantile})
        parts.append(
            counts.agg(F.count(F.lit(1)).alias("n_values")).select(
                F.lit(column).alias("column_name"), "n_values", limit.scalar().alias("rare_threshold")
            )
        )
    return parts[0].unionByName(parts[1])
