"""Exact quantiles (linear interpolation) and average ranks at any group size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.expr import stack_columns
from ledgerline.operators.segments import GROUP_ROWS, SEGMENT_ROWS, _fits, running_sum
from ledgerline.operators.skew import salted_lookup
from ledgerline.session import materialise


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    group_rows: int = GROUP_ROWS,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """One row per group with a column per entry of ``probs``; missing values are skipped.

    ``percentile`` holds a group's distinct values in one task, so it is used only while
    the largest group is within ``group_rows``. Beyond that, values are counted, running
    counts are built over range segments and the rows at the wanted positions are picked.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    if _fits(rows, keys, group_rows):
        return rows.groupBy(*keys).agg(*[F.percentile("_v", p).alias(n) for n, p in probs.items()])
    counts = materialise(rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    placed = running_sum(counts, keys, ["_v"], "_n", "_upto", 0, segment_rows)
    totals = placed.groupBy(*keys).agg(F.max("_upto").alias("_total"))
    with_total = placed.join(totals, list(keys)) if keys else placed.withColumn("_total", totals.scalar())
    picks = []
    for name, p in probs.items():
        at = (F.col("_total") - 1) * F.lit(float(p))
        for side, index in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            covers = (F.col("_upto") - F.col("_n") <= index) & (index < F.col("_upto"))
            picks.append(F.min(F.when(covers, F.col("_v"))).alias(f"{name}_{side}"))
        picks.append(F.max(at - F.floor(at)).alias(f"{name}_part"))
    found = with_total.groupBy(*keys).agg(*picks)
    return found.select(
        *keys,
        *[
            (F.col(f"{n}_lo") + F.col(f"{n}_part") * (F.col(f"{n}_hi") - F.col(f"{n}_lo"))).alias(n)
            for n in probs
        ],
    )


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Mapping[str, float], group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Quantiles of many columns: one row per column name (``feature``).

    One wide aggregation holds the values of all columns in one task at its end, so it is
    used only while rows times columns stay within ``group_rows``.
    """
    long = df.select(F.inline(stack_columns(columns, "feature", "value")))
    if df.count() * len(columns) <= group_rows:
        wide = df.agg(
            *[
                F.percentile(F.col(f"`{c}`").cast("double"), F.array(*[F.lit(float(p)) for p in probs.values()])).alias(c)
                for c in columns
            ]
        )
        arrays = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("q")) for c in columns])
        return wide.select(F.inline(arrays)).select(
            "feature", *[F.col("q")[i].alias(n) for i, n in enumerate(probs)]
        )
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    return names.join(grouped_quantiles(long, ["feature"], "value", probs, group_rows), "feature", "left")


def value_ranks(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    group_rows: int = GROUP_ROWS,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Distinct values with their count and average rank (ties share the mean position)."""
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("n_ties"))
    )
    placed = running_sum(counts, keys, [value], "n_ties", "_upto", group_rows, segment_rows)
    return placed.withColumn(
        "avg_rank", F.col("_upto") - F.col("n_ties") + (F.col("n_ties") + 1) / 2.0
    ).drop("_upto")


def with_average_rank(
    df: DataFrame, value: str, out: str, group_rows: int = GROUP_ROWS, segment_rows: int = SEGMENT_ROWS
) -> DataFrame:
    """``df`` with the average rank of ``value``; heavily tied values are spread in the join."""
    ranks = value_ranks(df, [], value, group_rows, segment_rows).withColumnRenamed("avg_rank", out)
    return salted_lookup(df, ranks, value, [out])
