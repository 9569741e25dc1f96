"""Exact money arithmetic: decimals inside, double at the edge.

Sums of doubles depend on the order of the rows, so a result would change with
the number of partitions. Sums of decimals do not.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dec(col: str | Column, scale: int = 2, precision: int = 18) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(f"decimal({precision},{scale})")


def exact_sum(col: str | Column, scale: int = 2) -> Column:
    return F.sum(dec(col, scale)).cast("double")


def exact_avg(col: str | Column, scale: int = 2) -> Column:
    return F.sum(dec(col, scale)).cast("double") / F.count(col)


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL where the denominator is zero."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
