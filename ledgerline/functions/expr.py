"""Column expressions shared by the plans. All stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def as_flag(condition: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def season_year(label: Column) -> Column:
    """Year of a season label: its last two digits, below 50 in this century."""
    digits = F.regexp_replace(label, "[^0-9]", "")
    short = F.substring(digits, -2, 2).try_cast("int")
    return F.when(
        F.length(digits) >= 2, F.when(short < 50, short + 2000).otherwise(short + 1900)
    )


def numeric_or_null(text: Column) -> Column:
    """Text as a double; NULL for what is not a number (including NaN)."""
    value = text.try_cast("double")
    return F.when(~F.isnan(value), value)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def sentinel_to_null(text: Column) -> Column:
    """Missing-value words become NULL."""
    return F.when(~F.lower(F.trim(text)).isin("nan", "none", "null"), text)


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, rounded down like a day count of a time span."""
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    return F.floor(micros / F.lit(float(MICROS_PER_DAY))).cast("int")


def days_before(moment: Column, days: int) -> Column:
    return moment - F.expr(f"INTERVAL {int(days)} DAYS")


def at_least(value: Column, low) -> Column:
    """Clip from below; NULL stays NULL (plain ``greatest`` would skip it)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(low).cast("double")))


def at_most(value: Column, high) -> Column:
    return F.when(value.isNotNull(), F.least(value, F.lit(high).cast("double")))


def ratio(numerator: Column, denominator: Column, otherwise=None) -> Column:
    """``numerator / denominator`` where the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(otherwise).cast("double"))


def ratio_nonzero(numerator: Column, denominator: Column) -> Column:
    """Plain ratio, NULL over a zero denominator."""
    return F.when(denominator != 0, numerator / denominator)


def round_exact(value: Column, digits: int) -> Column:
    """Round the double itself, not its decimal print, half to even.

    0.61235 is stored a little below its print, so four digits give 0.6123, as in plain
    Python. The product with a power of ten is kept exactly as the sum of two doubles, by
    splitting the value into an upper and a lower half, and compared with the midpoint.
    """
    power = F.lit(float(10**digits))
    wide = value * F.lit(134217729.0)  # 2^27 + 1
    upper = wide - (wide - value)
    lower = value - upper
    whole = F.floor(value * power).cast("double")
    past = (upper * power - (whole + 0.5)) + lower * power
    is_odd = F.pmod(whole, F.lit(2.0)) == 1.0
    up = (past > 0) | ((past == 0) & is_odd)
    return F.when(up, whole + 1.0).otherwise(whole) / power


def zero_below(value: Column, threshold) -> Column:
    return F.when(value < threshold, F.lit(0.0)).otherwise(value)


def brand_flag_name(brand: str) -> str:
    """Output column of a brand flag: blanks and every "and" give an underscore, pairs of them one."""
    return "buys_" + re.sub("__", "_", re.sub(" |and", "_", brand.lower()))


def one_hot(column: Column, value: str) -> Column:
    return as_flag(column == F.lit(value))


def multi_hot(labels: Column, classes: Column) -> Column:
    """0/1 vector over ``classes`` (an ordered array); labels outside it are ignored."""
    return F.transform(classes, lambda c: F.array_contains(labels, c).cast("int"))


def sigmoid(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def decide(scores: Column, threshold: float = 0.5) -> Column:
    return F.transform(scores, lambda s: (sigmoid(s) > threshold).cast("int"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def percent_label(share: Column) -> Column:
    """``12.34%``, rounded half to even."""
    return F.format_string("%.2f%%", round_exact(share * 100, 2))


def stack_columns(columns: Sequence[str], name: str, value: str) -> Column:
    """Array of (name, value) structs, to be exploded inline; values become doubles."""
    return F.array(
        *[
            F.struct(F.lit(c).alias(name), F.col(f"`{c}`").cast("double").alias(value))
            for c in columns
        ]
    )
