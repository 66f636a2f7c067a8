"""Mean and variance from integer sums, so that the result does not depend on the partitioning."""

from __future__ import annotations

from pyspark.sql import Column


def mean(total: Column, count: Column) -> Column:
    return total.cast("double") / count


def variance(total: Column, squares: Column, count: Column) -> Column:
    """Population variance as E[x^2] - E[x]^2."""
    average = mean(total, count)
    return squares.cast("double") / count - average * average
