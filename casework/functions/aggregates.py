"""Aggregate helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distinct_count(c: str | Column, approx: bool = False, rsd: float = 0.01) -> Column:
    """``count(DISTINCT c)``: exact by default (two-level aggregate, no Expand
    for a single distinct column); ``approx=True`` uses HyperLogLog++ with
    relative standard deviation ``rsd``, one fixed-size sketch per group
    instead of a shuffle of the distinct values."""
    col = F.col(c) if isinstance(c, str) else c
    return F.approx_count_distinct(col, rsd) if approx else F.countDistinct(col)


def quotient(a, b) -> Column:
    """``a / b`` of exact numbers with 18 digits after the point, to be rounded
    once by the caller. Spark keeps 6 digits of the quotient of two of its
    widest decimals, which would be rounded twice; operands of 9 digits after
    the point (and 11 before it) keep 18."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return a.cast("decimal(20,9)") / b.cast("decimal(20,9)")
