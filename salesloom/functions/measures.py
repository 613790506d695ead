"""Totals and averages of double measures, built in two steps.

A mart first adds up the fact per dimension id and only then joins the dimension,
so each measure needs a partial form that can be added up again.

A double that a decimal holds without change is added as that decimal, so the total does
not depend on the order in which partitions are merged. All others (NaN, infinity, too
large, more decimals than the type has) are added as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A plain sum: ten decimals, amounts up to 1e18; Spark's sum gets ten more digits.
EXACT = "decimal(28,10)"
# A weighted sum: the product with a weight of 19 digits still fits 38.
EXACT_WEIGHTED, WEIGHT = "decimal(18,8)", "decimal(19,0)"


def exactly(value: Column, type_name: str = EXACT) -> Column:
    """The double as a decimal, or NULL if that would change it."""
    held = value.try_cast(type_name)
    return F.when(held.cast("double") == value, held)


def partial_total(measure: str, prefix: str) -> list[Column]:
    """Partial sum of a double column as three aggregates."""
    value = F.col(measure)
    exact = exactly(value)
    return [
        F.sum(exact).alias(f"{prefix}_exact"),
        F.sum(F.when(exact.isNull(), value)).alias(f"{prefix}_rest"),
        F.count(value).alias(f"{prefix}_n"),
    ]


def partial_weighted(measure: str, weight: str, prefix: str) -> list[Column]:
    """The same of ``measure`` repeated ``weight`` times."""
    value, times = F.col(measure), F.col(weight)
    exact = exactly(value, EXACT_WEIGHTED)
    return [
        F.sum(exact * times.cast(WEIGHT)).alias(f"{prefix}_exact"),
        F.sum(F.when(exact.isNull(), value * times)).alias(f"{prefix}_rest"),
        F.coalesce(F.sum(F.when(value.isNotNull(), times)), F.lit(0)).alias(f"{prefix}_n"),
    ]


def merged(prefix: str) -> list[Column]:
    """Add up partial sums of the same measure."""
    return [F.sum(f"{prefix}_{part}").alias(f"{prefix}_{part}") for part in ("exact", "rest", "n")]


def total(prefix: str) -> Column:
    """The sum as double; NULL if there was no value."""
    exact = F.col(f"{prefix}_exact").cast("double")
    rest = F.col(f"{prefix}_rest")
    return F.coalesce(exact + rest, exact, rest)


def average(prefix: str) -> Column:
    """The mean over the values present; NULL if there was none."""
    return F.try_divide(total(prefix), F.col(f"{prefix}_n").cast("double"))
