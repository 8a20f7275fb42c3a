"""Profiling tables: one aggregation per table, unpivoted where the report is long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.expr import as_flag, numeric_or_null, ratio_nonzero, stack_columns, whole_days
from ledgerline.operators.quantiles import column_quantiles, grouped_quantiles
from ledgerline.params import ProfileParams
from ledgerline.session import materialise

QUARTILES = {"q25": 0.25, "q50": 0.50, "q75": 0.75}


def count_if(condition: Column) -> Column:
    return F.sum(as_flag(condition))


def as_rows(one_row: DataFrame, columns: Sequence[str], name: str = "statistic", value: str = "value") -> DataFrame:
    return one_row.select(F.inline(stack_columns(columns, name, value)))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles; one row per column.

    The columns are stored first: beyond a size, quartiles read them several times.
    """
    df = materialise(df.select(*columns), "described")
    long = df.select(F.inline(stack_columns(columns, "feature", "value")))
    basic = long.groupBy("feature").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return basic.join(column_quantiles(df, columns, QUARTILES), "feature", "left")


def target_summary(train: DataFrame, target: str, params: ProfileParams) -> DataFrame:
    """Sign counts and shares, description, and quantiles of the positive part."""
    y, at = F.col(target), params.positive_threshold
    n = F.count(F.lit(1))
    counts = train.agg(
        n.alias("n_customers"),
        count_if(y == at).alias("n_zero"),
        (count_if(y == at) / n * 100).alias("pct_zero"),
        count_if(y > at).alias("n_positive"),
        (count_if(y > at) / n * 100).alias("pct_positive"),
        count_if(y < at).alias("n_negative"),
        F.avg(y).alias("mean"),
        F.stddev_samp(y).alias("std"),
        F.min(y).alias("min"),
        F.max(y).alias("max"),
    )
    quartiles = grouped_quantiles(train, [], target, QUARTILES)
    names = {f"positive_p{round(q * 100):02d}": q for q in params.target_quantiles}
    positive = grouped_quantiles(train.filter(y > at), [], target, names)
    return (
        as_rows(counts, counts.columns)
        .unionByName(as_rows(quartiles, list(QUARTILES)))
        .unionByName(as_rows(positive, list(names)))
    )


def missing_report(df: DataFrame) -> DataFrame:
    """Missing count and percentage per column, most incomplete first."""
    n = F.count(F.lit(1))
    counts = df.agg(n.alias("_rows"), *[count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("n_missing"), F.col("_rows").alias("_rows"))
            for c in df.columns
        ]
    )
    return (
        counts.select(F.inline(cells))
        .select("column_name", "n_missing", F.bround(F.col("n_missing") / F.col("_rows") * 100, 2).alias("pct_missing"))
        .orderBy(F.desc("n_missing"), "column_name")
    )


def value_counts(df: DataFrame, column: str, n: int | None = None, keep_null: bool = False) -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    source = df if keep_null else df.filter(F.col(column).isNotNull())
    counts = source.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), F.asc_nulls_last("value"))
    return ordered.limit(n) if n else ordered


def text_quality(df: DataFrame, columns: Sequence[str], top: int) -> DataFrame:
    """Per text column: most frequent values, and how many and which are not numbers."""
    parts = []
    for name in columns:
        bad = df.filter(F.col(name).isNotNull() & numeric_or_null(F.col(name)).isNull())
        total = bad.agg(F.lit("n_non_numeric").alias("section"), F.lit(None).cast("string").alias("value"), F.count(F.lit(1)).alias("n"))
        frequent = value_counts(df, name, top, keep_null=True).select(F.lit("top_values").alias("section"), "value", "n")
        wrong = value_counts(bad, name, top).select(F.lit("non_numeric_values").alias("section"), "value", "n")
        for part in (frequent, total, wrong):
            parts.append(part.select(F.lit(name).alias("column_name"), "section", "value", "n"))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def transaction_quality(tx: DataFrame) -> DataFrame:
    """Rows, distinct ids, date ranges and returned items in one row."""
    return tx.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("cust_id").alias("n_customers"),
        F.count_distinct("sale_id").alias("n_orders"),
        F.count_distinct("prod_id").alias("n_products"),
        F.min("order_date").alias("order_date_min"),
        F.max("order_date").alias("order_date_max"),
        F.min("pack_date").alias("pack_date_min"),
        F.max("pack_date").alias("pack_date_max"),
        count_if(F.col("returned_to_shop_id").isNotNull()).alias("n_returned_items"),
    )


def customer_statistics(tx: DataFrame) -> DataFrame:
    stats = tx.filter(F.col("cust_id").isNotNull()).groupBy("cust_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("sale_id").alias("n_orders"),
        F.count_distinct("prod_id").alias("n_products"),
        F.coalesce(F.sum("sale_revenue"), F.lit(0.0)).alias("total_revenue"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
    )
    return stats.withColumn("customer_lifespan_days", whole_days(F.col("last_order"), F.col("first_order")))


def coverage(train: DataFrame, test: DataFrame, stats: DataFrame) -> DataFrame:
    """How many train and test customers have transactions."""
    parts = train.select("cust_id", F.lit("train").alias("part")).union(test.select("cust_id", F.lit("test")))
    seen = stats.select("cust_id", F.lit(1).alias("seen"))
    return parts.join(seen, "cust_id", "left").groupBy("part").agg(
        F.count("seen").alias("n_in_transactions"), F.count(F.lit(1)).alias("n_customers")
    )


def cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values and percentage missing per listed column that exists."""
    present = [c for c in columns if c in df.columns]
    missing = df.agg(*[(F.avg(F.col(c).isNull().cast("int")) * 100).alias(c) for c in present])
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in present])))
    unique = long.groupBy("column_name").agg(F.count_distinct("v").alias("n_unique"))
    return unique.join(as_rows(missing, present, "column_name", "pct_missing"), "column_name")


def quick_features(tx: DataFrame, train: DataFrame, target: str, reference_date: str, params: ProfileParams) -> DataFrame:
    """Light per-customer features joined to the target. Discounts keep their sign here."""
    ref = F.lit(reference_date).cast(tx.schema["order_date"].dataType)
    quick = (
        tx.filter(F.col("cust_id").isNotNull())
        .groupBy("cust_id")
        .agg(
            F.count_distinct("sale_id").alias("n_orders"),
            F.count(F.lit(1)).alias("n_items"),
            F.coalesce(F.sum("sale_revenue"), F.lit(0.0)).alias("total_revenue_1617"),
            F.avg("sale_revenue").alias("mean_revenue"),
            F.max("order_date").alias("last_order"),
            F.min("order_date").alias("first_order"),
            F.coalesce(F.sum("sale_discount_applied"), F.lit(0.0)).alias("total_discount"),
            F.count_distinct("prod_brand").alias("n_unique_brands"),
            F.count("returned_to_shop_id").alias("n_returns"),
        )
        .withColumns(
            {
                "recency_days": whole_days(ref, F.col("last_order")),
                "tenure_days": whole_days(F.col("last_order"), F.col("first_order")),
                "return_rate": F.col("n_returns") / F.col("n_items"),
            }
        )
    )
    return train.join(quick, "cust_id", "left").withColumn(
        "is_returner", as_flag(F.col(target) > params.positive_threshold)
    )


def target_correlations(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of each column with the target over complete pairs."""
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target)).alias(c) for c in columns])
    return as_rows(one, columns, "feature", "correlation").orderBy(F.desc("correlation"), "feature")


def compare_groups(df: DataFrame, columns: Sequence[str], flag: Column, names: tuple[str, str], ratio: str) -> DataFrame:
    """Mean of each column where ``flag`` holds and where it does not, and their ratio."""
    yes, no = names
    value = F.col("value")
    long = df.withColumn("_flag", as_flag(flag)).select(
        "_flag", F.inline(stack_columns(columns, "feature", "value"))
    )
    return (
        long.groupBy("feature")
        .agg(F.avg(F.when(F.col("_flag") == 0, value)).alias(no), F.avg(F.when(F.col("_flag") == 1, value)).alias(yes))
        .withColumn(ratio, ratio_nonzero(F.col(yes), F.col(no)))
    )


def sign_counts(tx: DataFrame) -> DataFrame:
    rev = F.col("sale_revenue")
    return tx.agg(
        count_if(rev == 0).alias("n_zero_revenue"),
        count_if(rev < 0).alias("n_negative_revenue"),
        count_if(F.col("returned_to_shop_id").isNotNull()).alias("n_returned"),
    )


def order_count_shares(stats: DataFrame) -> DataFrame:
    """Share of customers with exactly one and with at least five orders."""
    n = F.col("n_orders")
    return stats.agg(
        (F.avg(as_flag(n == 1)) * 100).alias("pct_one_order"),
        (F.avg(as_flag(n >= 5)) * 100).alias("pct_five_or_more"),
    )


def ratio_to_baseline(groups: DataFrame, key: str, baseline: str, metrics: Sequence[str]) -> DataFrame:
    """Each group's metrics over those of one baseline group (one row per group)."""
    base = groups.filter(F.col(key) == baseline)
    return groups.select(
        "*",
        *[ratio_nonzero(F.col(m), base.select(m).scalar()).alias(f"{m}_vs_{baseline}") for m in metrics],
    )
