"""Reward and pricing rules: ordered CASE ladders turned into sums.

A rule list is evaluated top to bottom, first match wins, like a searched
CASE; amounts stay exact decimals until the caller casts the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def rule_ladder(rules: Sequence[tuple[Column, Column | float | int]],
                default: Column | float | int | None = None) -> Column:
    """``CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... ELSE default END``."""
    expr = None
    for cond, val in rules:
        v = val if isinstance(val, Column) else F.lit(val)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    if expr is None:
        return default if isinstance(default, Column) else F.lit(default)
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def points(amount: Column, per_unit: int = 10,
           multipliers: Sequence[tuple[Column, int]] = ()) -> Column:
    """``amount * per_unit``, times the first matching multiplier (else 1)."""
    base = amount * F.lit(per_unit)
    factor = rule_ladder(list(multipliers), 1) if multipliers else F.lit(1)
    return base * factor


def within_days_after(time: Column, anchor: Column, days: int = 7,
                      inclusive: bool = True) -> Column:
    """``time >= anchor AND time - anchor <= days`` (in whole days).

    With the default this spans the anchor day plus 7 more, i.e. 8 days,
    which is how the loyalty bonus week is coded; ``inclusive=False`` gives
    a 7-day window (``< days``).
    """
    d = F.datediff(F.to_date(time), F.to_date(anchor))
    return (time >= anchor) & ((d <= days) if inclusive else (d < days))


def price_by(key: Column, prices: dict, default: float | int = 0) -> Column:
    """Fixed price per key value (``CASE key WHEN 1 THEN 12 ... ELSE 0 END``)."""
    return rule_ladder([(key == k, v) for k, v in prices.items()], default)


def pay_per_unit(measure: Column, rate: str, scale: int = 2) -> Column:
    """``round(measure * rate, scale)`` in decimals (rounded per row, then
    summed). Only the product is rounded: the measure keeps the 18 digits
    after the point that a parsed measure has, the rate all of its own."""
    rate_value = Decimal(rate)
    digits = len(rate_value.as_tuple().digits)
    return F.round(measure.cast(f"decimal({37 - digits},18)") * F.lit(rate_value), scale)
