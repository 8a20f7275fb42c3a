"""Lookups by keys of which a few may hold most rows of the joined side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000
#: Keys that the sketch follows. A key is heavy above ROWS_PER_TASK or a 2,000th of the rows, so at
#: most 2,000 are; the sketch's error is below a 7,500th.
TRACKED = 10_000
MOST_HEAVY = 2_000


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def heavy_hitters(rows: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> dict[int, int]:
    """Number of parts for each heavy key of ``rows``, by the hash of the key.

    One pass: tasks keep frequent-item sketches of a fixed size, which merge. Counts are estimates; a key
    gets as many parts as its rows fill tasks. Keys with a NULL are left out.
    """
    known = rows.where(~reduce(or_, (F.col(f"`{k}`").isNull() for k in keys)))
    found = known.select(_hash(keys).alias("h")).agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {MOST_HEAVY}, {TRACKED})").alias("top")).first()
    limit = max(rows_per_task, found["n"] // MOST_HEAVY)
    return {r["item"]: -(-r["count"] // limit) for r in found["top"] or [] if r["count"] > limit}


def salted_lookup(left: DataFrame, lookup: DataFrame, keys: str | Sequence[str], take: Sequence[str], how: str = "left", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Look up ``take`` by ``keys`` (unique in ``lookup``).

    The heavy keys are those of ``left``, the side whose rows pile up. Their rows are spread over as many
    parts as they fill tasks, and the matching lookup row is repeated as often; rows with a NULL key find
    nothing and are spread by their other columns. Rows equal in all columns stay together: count them first.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    lookup = lookup.select(*keys, *take)
    heavy = heavy_hitters(left, keys, rows_per_task)
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])  # the same part when a task runs again
    no_key = reduce(or_, (F.col(f"`{k}`").isNull() for k in keys))
    if not heavy:
        salted = left.withColumn("_salt", F.when(no_key, spread).otherwise(F.lit(0)))
        return salted.join(lookup.withColumn("_salt", F.lit(0).cast("long")), [*keys, "_salt"], how).drop("_salt")
    # At most MOST_HEAVY rows.
    parts = F.broadcast(left.sparkSession.createDataFrame(list(heavy.items()), "_h long, _parts long"))
    salted = left.withColumn("_h", _hash(keys)).join(parts, "_h", "left").withColumn(
        "_salt", F.when(no_key, spread).when(F.col("_parts").isNotNull(), F.pmod(spread, F.col("_parts"))).otherwise(F.lit(0))
    )
    copies = lookup.withColumn("_h", _hash(keys)).join(parts, "_h", "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    )
    return salted.drop("_h", "_parts").join(copies.drop("_h", "_parts"), [*keys, "_salt"], how).drop("_salt")
