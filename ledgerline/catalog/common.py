"""Helpers of the query catalogue: rounding on both sides and a small registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import apply_settings

DIGITS = 6
Query = Callable[[SparkSession, str], DataFrame]


def nudge(digits: int) -> float:
    """Far below the rounding digit; keeps exact ties from depending on the last bit."""
    return 10.0 ** -(digits + 3)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded so that the order of a sum does not show; negative zero removed."""
    return df.select(
        *[
            (F.round(F.col(f"`{f.name}`") + F.lit(nudge(digits)), digits) + F.lit(0.0)).alias(f.name)
            if f.dataType.simpleString() in ("double", "float")
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def r(expression: str, digits: int = DIGITS) -> str:
    return f"round(cast({expression} as double) + {nudge(digits)!r}, {digits}) + 0.0e0"


class Catalogue:
    """Named queries, each with its SQL twin where SQL can express it."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, oracle: str | None = None, digits: int = DIGITS):
        def register(function: Query) -> Query:
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                apply_settings(spark)
                return rounded(function(spark, sf_dir), digits)

            run.__name__ = name
            run.__doc__ = function.__doc__
            self.queries[name] = run
            if oracle is not None:
                self.oracles[name] = oracle
            return function

        return register
