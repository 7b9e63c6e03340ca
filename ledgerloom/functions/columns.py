"""Column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0
MONEY = "decimal(18,6)"


def instant(value: str) -> Column:
    """A wall-clock literal, free of the session time zone."""
    return F.lit(value).cast("timestamp_ntz")


def elapsed_days(start: Column, end: Column) -> Column:
    """Fractional days from ``start`` to ``end``."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(MICROS_PER_DAY)


def money(value: Column) -> Column:
    """Fixed-point money, so that sums do not depend on partitioning or on task retries.

    Cleaning bounds an amount by max_quantity * max_price (1e9 by default), which leaves twelve
    integer digits free of overflow; sums widen to decimal(28,6) and then decimal(38,6).
    """
    return value.cast(MONEY)


def money_sum(value: Column) -> Column:
    """Exact sum of money as a double."""
    return F.sum(money(value)).cast("double")


def share(part: Column, whole: Column) -> Column:
    """``part / whole``, NULL where ``whole`` is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def category_of(description: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """First matching rule wins; patterns are unanchored."""
    chain = reduce(
        lambda acc, rule: acc.when(description.rlike(rule[1]), F.lit(rule[0])),
        rules[1:],
        F.when(description.rlike(rules[0][1]), F.lit(rules[0][0])),
    )
    return chain.otherwise(F.lit("other"))


def finite(value: Column) -> Column:
    """True for a present, finite double."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def half_up(value: Column) -> Column:
    """Nearest integer, halves upwards."""
    return F.floor(value + F.lit(0.5))
