"""Splits, folds, imputing, scaling and alignment; all repeatable from hashes of the id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.expr import as_flag
from ledgerline.operators.quantiles import column_quantiles
from ledgerline.operators.segments import running_sum


def draw(key: str, seed: int) -> Column:
    """Repeatable pseudo-random text per row, uniform over the ids."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string")))


def _shuffled(df: DataFrame, key: str, seed: int, strata: Sequence[str]) -> DataFrame:
    """``df`` with the position ``_pos`` of every row in the drawn order of its stratum.

    Only keys and counts are put in order; the rows themselves are dealt by key, so a stratum
    never gathers whole rows in one task. Rows with one key follow each other.
    """
    own = [*strata, key]
    counts = df.groupBy(*own).agg(F.count(F.lit(1)).alias("_n")).withColumn("_draw", draw(key, seed))
    placed = running_sum(counts, strata, ["_draw", key], "_n", "_upto").select(
        *[F.col(c).alias(f"_of_{c}") for c in own], (F.col("_upto") - F.col("_n")).alias("_before")
    )
    rows = df.withColumn("_nth", F.row_number().over(Window.partitionBy(*own).orderBy(F.lit(0))))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in own])
    joined = rows.join(placed, same).withColumn("_pos", F.col("_before") + F.col("_nth"))
    return joined.drop("_nth", "_before", *[f"_of_{c}" for c in own])


def stratified_split(df: DataFrame, key: str, target: str, share: float, seed: int) -> DataFrame:
    """``split`` = train / val; the same share of positive and other rows goes to val."""
    placed = _shuffled(df.withColumn("_stratum", as_flag(F.col(target) > 0)), key, seed, ["_stratum"])
    sizes = df.groupBy(as_flag(F.col(target) > 0).alias("_stratum")).agg(
        F.ceil(F.count(F.lit(1)) * share).alias("_take")
    )
    is_val = F.col("_pos") <= F.col("_take")
    # The right side has one row per stratum, two at most.
    return (
        placed.join(F.broadcast(sizes), "_stratum")
        .withColumn("split", F.when(is_val, "val").otherwise("train"))
        .drop("_stratum", "_take", "_pos")
    )


def plain_split(df: DataFrame, key: str, seed: int, holdout: float, test_of_holdout: float) -> DataFrame:
    """``split`` = train / val / test by position in a shuffled order."""
    rows = df.agg(F.ceil(F.count(F.lit(1)) * holdout).alias("h"))
    placed = _shuffled(df, key, seed, [])
    held = rows.scalar()
    tested = rows.select(F.ceil(F.col("h") * test_of_holdout)).scalar()
    part = F.when(F.col("_pos") <= tested, "test").when(F.col("_pos") <= held, "val").otherwise("train")
    return placed.withColumn("split", part).drop("_pos")


def stratified_folds(df: DataFrame, key: str, target: str, folds: int, seed: int) -> DataFrame:
    """``fold`` 0..folds-1, dealt in turn within positive and other rows."""
    placed = _shuffled(df.withColumn("_stratum", as_flag(F.col(target) > 0)), key, seed, ["_stratum"])
    return placed.withColumn("fold", ((F.col("_pos") - 1) % folds).cast("int")).drop("_stratum", "_pos")


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median per column; 0 for a column without any value."""
    rows = column_quantiles(df, columns, {"median": 0.5}).collect()
    found = {row["feature"]: row["median"] for row in rows}
    return {c: float(found[c]) if found.get(c) is not None else 0.0 for c in columns}


def impute(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(m)) for c, m in medians.items()}
    )


def fit_scaling(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column is divided by 1."""
    row = df.agg(
        *[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(F.col(f"`{c}`")).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def scale(df: DataFrame, scaling: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(f"`{c}`") - m) / s for c, (m, s) in scaling.items()})


def align(features: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Feature rows of the wanted ids with their other columns; raise when one is absent."""
    text = [f.name for f in features.schema.fields if f.dataType.simpleString() == "string" and f.name != key]
    if text:
        raise ValueError(f"model matrix has text columns: {text}")
    joined = wanted.join(features, key)
    n_wanted, n_joined = wanted.count(), joined.count()
    if n_wanted != n_joined:
        raise ValueError(f"alignment failed: {n_wanted} ids wanted, {n_joined} rows found")
    return joined
