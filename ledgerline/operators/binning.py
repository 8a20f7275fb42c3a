"""Quantile bins, fixed bins and equal-width histograms, right-closed, empty bins kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.quantiles import grouped_quantiles


def quantile_edges(df: DataFrame, column: str, q: int) -> list[float]:
    """Distinct edges of ``q`` equal-count bins; ties at an edge give fewer bins."""
    names = {f"e{i}": i / q for i in range(q + 1)}
    row = grouped_quantiles(df, [], column, names).first()
    found = [row[n] for n in names if row is not None and row[n] is not None]
    return sorted(set(found))


def bin_number(value: Column, edges: Sequence[float], include_lowest: bool) -> Column:
    """0-based bin of a right-closed partition; NULL outside it."""
    number = F.lit(None).cast("int")
    for i in range(len(edges) - 1, 0, -1):
        low = value >= edges[0] if include_lowest and i == 1 else value > edges[i - 1]
        number = F.when(low & (value <= edges[i]), F.lit(i - 1)).otherwise(number)
    return number


def bin_table(df: DataFrame, edges: Sequence[float], labels: Sequence[str] | None = None) -> DataFrame:
    """One row per bin: number, bounds and label."""
    rows = [
        (i, float(edges[i]), float(edges[i + 1]), labels[i] if labels else None)
        for i in range(len(edges) - 1)
    ]
    return df.sparkSession.createDataFrame(rows, "bin_no int, lower double, upper double, label string")


def binned(
    df: DataFrame,
    value: Column,
    edges: Sequence[float],
    stats: Sequence[Column],
    include_lowest: bool = True,
    labels: Sequence[str] | None = None,
    zero_filled: Sequence[str] = (),
) -> DataFrame:
    """Statistics per bin; bins without rows stay, with NULLs (or 0 for ``zero_filled``)."""
    inside = df.withColumn("bin_no", bin_number(value, edges, include_lowest)).filter(F.col("bin_no").isNotNull())
    grouped = inside.groupBy("bin_no").agg(*stats)
    table = bin_table(df, edges, labels)
    if not labels:
        table = table.drop("label")
    full = table.join(grouped, "bin_no", "left")
    return full.fillna(0, subset=list(zero_filled)) if zero_filled else full


def histogram(df: DataFrame, value: Column, bins: int, clip_at: float | None = None) -> DataFrame:
    """Equal-width counts over the range of the values, optionally clipped from above."""
    shown = F.least(value, F.lit(float(clip_at))) if clip_at is not None else value
    values = df.select(F.when(value.isNotNull(), shown.cast("double")).alias("v")).filter(F.col("v").isNotNull())
    low, high = values.agg(F.min("v"), F.max("v")).first()
    if low is None:
        low, high = 0.0, 1.0
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    number = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(number.alias("bin_no")).agg(F.count(F.lit(1)).alias("n"))
    table = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin_no"),
        (F.lit(low) + F.col("id") * width).alias("lower"),
        (F.lit(low) + (F.col("id") + 1) * width).alias("upper"),
    )
    return table.join(counts, "bin_no", "left").fillna(0, subset=["n"])
