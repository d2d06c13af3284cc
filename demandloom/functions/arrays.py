"""Folds over one series held as ``array<double>``.

An array holds one value per day of the history window, so its length is bounded
by the window however large the data is.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def mean(values: Column) -> Column:
    """Mean of a non-empty array; null for an empty one."""
    return F.when(F.size(values) > 0, total(values) / F.size(values))


def counting(n: int) -> Column:
    """array(1, 2, ..., n)"""
    return F.sequence(F.lit(1), F.lit(n))
