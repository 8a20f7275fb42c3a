"""Views that let the star-schema tables play the roles of the workloads' inputs.

Each view has a SQL twin for the cross-check; both use whole-number arithmetic for money
so that every value is exact to the cent in any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.params import TOP_BRANDS

# Dates move 18 years forward so that the history of the tables covers 2016 and 2017.
SHIFT_YEARS = 18
HISTORY_FROM, HISTORY_TO = "1998-01-01", "2000-01-01"
TEST_SEGMENT = "BUILDING"
TARGET_PRIORITY = "1-URGENT"

TYPE_ROLES = {
    "PROMO": "women",
    "SMALL": "men",
    "LARGE": "boys",
    "ECONOMY": "girls",
    "MEDIUM": "unisex",
    "STANDARD": "unisex",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read as it lies."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str) -> str:
    return f"cast(round({column} * 100) as bigint)"


def _case(column: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"when {column} = '{k}' then '{v}'" for k, v in mapping.items())
    return f"case {whens} else {column} end"


BRAND_ROLES = {f"Brand#{i}": name for i, name in enumerate(TOP_BRANDS, 1)}


def _transaction_columns(div: str) -> dict[str, str]:
    """Column name to SQL expression; ``div`` is the engine's whole-number division."""
    net = f"({cents('l_extendedprice')} * (100 - {cents('l_discount')}))"
    saved = f"({cents('l_extendedprice')} * {cents('l_discount')})"
    return {
        "cust_id": "o_custkey",
        "sale_id": "l_orderkey",
        "prod_id": "l_partkey",
        "order_date": f"o_orderdate + interval {SHIFT_YEARS} year",
        "pack_date": f"l_shipdate + interval {SHIFT_YEARS} year",
        "sale_revenue": f"(case when l_returnflag = 'R' then -1 else 1 end) * ({net} {div} 100000) / 100.0e0",
        "sale_discount_applied": f"0.0e0 - ({saved} {div} 100000) / 100.0e0",
        "returned_to_shop_id": "case when l_returnflag = 'R' then cast(l_suppkey as varchar(20)) end",
        "prod_size": "case when p_size = 50 then 'XS' else cast(p_size as varchar(20)) end",
        "prod_brand": _case("p_brand", BRAND_ROLES),
        "prod_color": "split_part(p_name, ' ', 1)",
        "prod_season": (
            "case when p_size in (10, 20, 30, 40) then null else concat("
            "case when p_type in ('PROMO', 'SMALL', 'LARGE') then 'S' else 'W' end,"
            " lpad(cast(p_size as varchar(20)), 2, '0')) end"
        ),
        "prod_type_1": _case("p_type", TYPE_ROLES),
        "prod_heel": "nullif(p_type, 'PROMO')",
        "prod_material": "split_part(p_name, ' ', 2)",
        "prod_clasp": "nullif(p_type, 'SMALL')",
        "prod_comfort_sole": "nullif(p_type, 'LARGE')",
        "prod_comfort_wear": "nullif(p_type, 'ECONOMY')",
        "prod_web_only": "case when l_linestatus = 'F' then 1.0e0 else 0.0e0 end",
        "prod_outlet": "l_tax",
    }


TRANSACTION_ORACLE = (
    "tx as (select "
    + ", ".join(f"{sql} as {name}" for name, sql in _transaction_columns("//").items())
    + " from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey"
    + f" where o_orderdate >= timestamp '{HISTORY_FROM}' and o_orderdate < timestamp '{HISTORY_TO}')"
)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item rows of the two history years."""
    orders = table(spark, sf_dir, "orders").filter(
        (F.col("o_orderdate") >= F.lit(HISTORY_FROM).cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit(HISTORY_TO).cast("timestamp_ntz"))
    )
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    return joined.select(*[F.expr(sql).alias(name) for name, sql in _transaction_columns("div").items()])


_TARGET = f"({cents('o_totalprice')} {{div}} 1000) / 100.0e0"

CUSTOMER_ORACLE = (
    "target as (select o_custkey, sum(" + _TARGET.format(div="//") + ") as revenue from orders"
    f" where o_orderdate >= timestamp '{HISTORY_TO}' and o_orderpriority = '{TARGET_PRIORITY}' group by 1),"
    " train as (select c_custkey as cust_id, round(coalesce(revenue, 0.0), 2) as revenue_2018_2019"
    f" from customer left join target on c_custkey = o_custkey where c_mktsegment <> '{TEST_SEGMENT}'),"
    f" test as (select c_custkey as cust_id from customer where c_mktsegment = '{TEST_SEGMENT}')"
)


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the revenue of the later years, zero for most."""
    revenue = (
        table(spark, sf_dir, "orders")
        .filter(
            (F.col("o_orderdate") >= F.lit(HISTORY_TO).cast("timestamp_ntz"))
            & (F.col("o_orderpriority") == TARGET_PRIORITY)
        )
        .groupBy(F.col("o_custkey").alias("cust_id"))
        .agg(F.sum(F.expr(_TARGET.format(div="div"))).alias("revenue"))
    )
    ids = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != TEST_SEGMENT)
    return (
        ids.select(F.col("c_custkey").alias("cust_id"))
        .join(revenue, "cust_id", "left")
        .select("cust_id", F.round(F.coalesce("revenue", F.lit(0.0)), 2).alias("revenue_2018_2019"))
    )


def test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") == TEST_SEGMENT)
        .select(F.col("c_custkey").alias("cust_id"))
    )
