"""Text assembly helpers with PostgreSQL's NULL rules made explicit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def optional_fragment(prefix: str, c: str | Column) -> Column:
    """``coalesce(prefix || x, '')``: the fragment appears only when x is not NULL."""
    return F.coalesce(F.concat(F.lit(prefix), _col(c)), F.lit(""))


def concat_skip_nulls(*cols: str | Column) -> Column:
    """``concat(a, b, ...)`` in the PostgreSQL sense: NULL inputs are skipped.

    Spark's ``concat`` returns NULL if any input is NULL (that is SQL ``||``).
    """
    return F.concat_ws("", *[_col(c).cast("string") for c in cols])


def exact_ratio(num: str | Column, den: str | Column, scale: int, factor: int = 1,
                operand: str = "decimal(20,0)") -> Column:
    """``round(factor * num / den, scale)`` computed in decimals, half away from zero.

    ``operand`` is the type both sides are read as: the default is for
    integer counts, where Spark keeps 18 fractional digits in the quotient, far
    more than any tie needs; decimal operands name their own type, so none of
    their digits is lost before the division.
    """
    n = _col(num).cast(operand) * F.lit(factor).cast("decimal(5,0)")
    return F.round(n / _col(den).cast(operand), scale)


def percent_text(num: str | Column, den: str | Column, scale: int = 1) -> Column:
    """``round(100.0 * num / den, scale) || '%'``, e.g. ``30.7%`` or ``9%``."""
    return F.concat(exact_ratio(num, den, scale, factor=100).cast("string"), F.lit("%"))
