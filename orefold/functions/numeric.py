"""Numbers: casts, returns and scaled or compounded aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def strict_double(c: Column) -> Column:
    """Text -> double; text that is no number fails the query (ANSI mode)."""
    return c.cast("double")


def strict_bigint(c: Column) -> Column:
    """Text -> bigint, fractions rounded; text that is no number fails the query."""
    return F.coalesce(c.try_cast("bigint"), F.round(c.cast("double")).cast("bigint"))


def tolerant_double(c: Column) -> Column:
    return c.try_cast("double")


def tolerant_bigint(c: Column) -> Column:
    return F.coalesce(c.try_cast("bigint"), F.round(c.try_cast("double")).try_cast("bigint"))


def tolerant_int(c: Column) -> Column:
    """Text -> int, fractions rounded (``12.7`` -> 13); anything else gives null."""
    return F.coalesce(c.try_cast("int"), F.round(c.try_cast("double")).try_cast("int"))


def simple_return(value: Column, base: Column) -> Column:
    """``(value - base) / base``; a zero base gives null."""
    return (value - base) / F.nullif(base, F.lit(0.0))


def in_thousands(c: Column) -> Column:
    """Double division: a decimal literal would make the result a decimal."""
    return c.cast("double") / F.lit(1000.0)


# aggregates

def weighted_mean(value: Column, weight: Column) -> Column:
    """Null values are skipped above the line, their weights still count below it."""
    return F.sum(value * weight) / F.nullif(F.sum(weight).cast("double"), F.lit(0.0))


def sum_where(condition: Column, value: Column) -> Column:
    """Sum with 0 for rows outside the condition: an empty window is 0, not null."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def count_where(condition: Column) -> Column:
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def compoundable(rate: Column) -> Column:
    """Row guard for ``compound``: keeps the logarithm's argument above 0.01."""
    return F.coalesce(rate, F.lit(0.0)) > -0.99


def compound(rate: Column) -> Column:
    """Product of ``1 + rate`` minus one; a null rate counts as 0."""
    return F.exp(F.sum(F.ln(F.lit(1.0) + F.coalesce(rate, F.lit(0.0))))) - F.lit(1.0)
