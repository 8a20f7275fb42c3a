"""Ordered work (row numbers, running sums and minima, previous value) over groups of any size.

A plain window sends a whole group to one task. That is fine while the largest group is
small, and its size is checked. Beyond the limit the rows are range-partitioned by
(keys, order) and written, so a group spreads over many segments of bounded size; each
segment is worked on alone and a small table of per-segment totals links them.
Both ways give the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import materialise

GROUP_ROWS = 2_000_000
SEGMENT_ROWS = 1_000_000
SEGMENT = "_segment"


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    if not keys:
        return df.count()
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def _fits(df: DataFrame, keys: Sequence[str], limit: int) -> bool:
    """True when no group is larger than ``limit``; the row total decides first."""
    if df.count() <= limit:
        return True
    return bool(keys) and largest_group(df, keys) <= limit


def _whole(keys: Sequence[str]):
    return Window.partitionBy(*[F.col(k) for k in keys]) if keys else Window.partitionBy(F.lit(0))


def _segmented(df: DataFrame, keys, order, segment_rows: int) -> DataFrame:
    parts = max(2, math.ceil(df.count() / segment_rows))
    ranged = df.repartitionByRange(parts, *[F.col(c) for c in [*keys, *order]])
    return materialise(ranged.withColumn(SEGMENT, F.spark_partition_id()), "segments")


def _link(df: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join per-segment facts back; keys may be NULL."""
    renamed = facts.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col(SEGMENT).alias("_s"),
        *[c for c in facts.columns if c not in keys and c != SEGMENT],
    )
    condition = F.col(SEGMENT) == F.col("_s")
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(renamed, condition, "left").drop("_s", SEGMENT, *[f"_k_{k}" for k in keys])


def _running(df, keys, order, value, out, how, group_rows, segment_rows, before_row=False) -> DataFrame:
    fold = {"sum": F.sum, "min": F.min}[how]
    join_up = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + b, "min": F.least}[how]
    order_cols = [F.col(c) for c in order]
    upto = (Window.unboundedPreceding, -1 if before_row else Window.currentRow)
    if _fits(df, keys, group_rows):
        return df.withColumn(out, fold(value).over(_whole(keys).orderBy(*order_cols).rowsBetween(*upto)))
    parts = _segmented(df, keys, order, segment_rows)
    totals = parts.groupBy(*keys, SEGMENT).agg(fold(value).alias("_t"))
    before = _whole(keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    facts = totals.withColumn("_base", fold("_t").over(before)).drop("_t")
    inside = Window.partitionBy(*[F.col(k) for k in keys], F.col(SEGMENT)).orderBy(*order_cols)
    local = parts.withColumn("_run", fold(value).over(inside.rowsBetween(*upto)))
    linked = _link(local, facts, keys)
    return linked.withColumn(out, join_up(F.col("_base"), F.col("_run"))).drop("_base", "_run")


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    group_rows: int = GROUP_ROWS,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Sum of ``value`` up to and including the row. (keys, order) must be unique."""
    return _running(df, keys, order, value, out, "sum", group_rows, segment_rows)


def lowest_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    group_rows: int = GROUP_ROWS,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Lowest ``value`` of the rows before this one. (keys, order) must be unique."""
    return _running(df, keys, order, value, out, "min", group_rows, segment_rows, True)


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    group_rows: int = GROUP_ROWS,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """1-based position of a row in its group. (keys, order) must be unique."""
    numbered = running_sum(
        df.withColumn("_one", F.lit(1).cast("bigint")), keys, order, "_one", out, group_rows, segment_rows
    )
    return numbered.drop("_one")


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    group_rows: int = GROUP_ROWS,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """``value`` of the row before in the group, NULL for the first. (keys, order) unique."""
    order_cols = [F.col(c) for c in order]
    if _fits(df, keys, group_rows):
        return df.withColumn(out, F.lag(value).over(_whole(keys).orderBy(*order_cols)))
    parts = _segmented(df, keys, order, segment_rows)
    last = parts.groupBy(*keys, SEGMENT).agg(
        F.max_by(F.col(value), F.struct(*order_cols)).alias("_last")
    )
    facts = last.withColumn("_edge", F.lag("_last").over(_whole(keys).orderBy(SEGMENT))).drop("_last")
    inside = Window.partitionBy(*[F.col(k) for k in keys], F.col(SEGMENT)).orderBy(*order_cols)
    local = parts.withColumn("_prev", F.lag(value).over(inside)).withColumn(
        "_first", F.row_number().over(inside) == 1
    )
    linked = _link(local, facts, keys)
    return linked.withColumn(
        out, F.when(F.col("_first"), F.col("_edge")).otherwise(F.col("_prev"))
    ).drop("_prev", "_first", "_edge")
