"""Aggregate expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def mean(column: str | Column) -> Column:
    """Sum over count, nulls ignored. Exact (independent of row order) for decimal input."""
    c = F.col(column) if isinstance(column, str) else column
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def mean_over(column: str | Column, window: WindowSpec) -> Column:
    """``mean`` over a window."""
    c = F.col(column) if isinstance(column, str) else column
    return F.try_divide(F.sum(c).over(window).cast("double"), F.count(c).over(window).cast("double"))


def skewness_sample_sd(column: str | Column) -> Column:
    """Third central moment over the cube of the sample standard deviation."""
    c = F.col(column) if isinstance(column, str) else column
    n = F.count(c)
    return F.skewness(c) * F.pow((n - 1) / n, F.lit(1.5))


def kurtosis_sample_sd(column: str | Column) -> Column:
    """Fourth central moment over the fourth power of the sample standard deviation, minus 3."""
    c = F.col(column) if isinstance(column, str) else column
    n = F.count(c)
    return (F.kurtosis(c) + 3) * F.pow(1 - F.try_divide(F.lit(1.0), n), F.lit(2.0)) - 3
