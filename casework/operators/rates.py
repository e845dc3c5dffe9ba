"""Conditional counts, shares, success rates and correlation summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.functions.text import exact_ratio


def cond_counts(df: DataFrame, by: str | Sequence[str] | None,
                conditions: dict[str, Column]) -> DataFrame:
    """``count(CASE WHEN p THEN 1 END)`` per named condition, per group.

    All counts come from one scan and one partial+final aggregate.
    """
    aggs = [F.count(F.when(cond, F.lit(1))).alias(name) for name, cond in conditions.items()]
    if not by:
        return df.agg(*aggs)
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(*aggs)


def distinct_and_flagged(df: DataFrame, key: str, cond: Column, total_name: str,
                         flagged_name: str) -> DataFrame:
    """``count(DISTINCT key)`` and ``count(DISTINCT CASE WHEN cond THEN key END)``.

    Two distinct aggregates over different expressions make Spark copy every
    row once per expression (``Expand``) before the shuffle. Here each key
    is reduced to one row first (a partial aggregate: does any of its rows
    match?), then one global count reads those rows. NULL keys are not
    counted, as in ``count(DISTINCT ...)``.
    """
    per_key = df.groupBy(key).agg(F.bool_or(F.coalesce(cond, F.lit(False))).alias("__any"))
    return per_key.agg(F.count(key).alias(total_name),
                       F.count_if(F.col("__any") & F.col(key).isNotNull()).alias(flagged_name))


def share_of_total(counts: DataFrame, count_col: str, name: str = "percentage",
                   scale: int | None = None) -> DataFrame:
    """``100.0 * n / sum(n) over ()`` for an already aggregated frame.

    One window over the group rows (one row per group, not per input row), so
    the input is computed once. Unrounded by default; with ``scale`` the
    share is rounded, exactly for integer and decimal counts.
    """
    total = F.sum(count_col).over(Window.partitionBy())
    return counts.withColumn(name, _percent(F.col(count_col), total, scale, counts.schema[count_col].dataType))


def _percent(n: Column, total: Column, scale: int | None, dtype: T.DataType) -> Column:
    """``100 * n / total`` as a double: of doubles, or rounded in decimals."""
    if scale is None:
        return F.lit(100.0) * n.cast("double") / total.cast("double")
    if isinstance(dtype, T.DecimalType):
        # a sum has ten digits more than its addends
        operand = f"decimal({min(38, dtype.precision + 10)},{dtype.scale})"
    elif isinstance(dtype, T.IntegralType):
        operand = "decimal(20,0)"
    else:
        raise TypeError(f"a rounded share needs integer or decimal counts, not {dtype.simpleString()}")
    return exact_ratio(n, total, scale, 100, operand).cast("double")


def success_rate(df: DataFrame, by: str | Sequence[str], ok: Column,
                 name: str = "success_percentage", scale: int | None = None,
                 ok_name: str | None = None, total_name: str | None = None) -> DataFrame:
    """Per group ``100 * count(*) FILTER (WHERE ok) / count(*)``, unrounded
    unless ``scale`` is given."""
    by = [by] if isinstance(by, str) else list(by)
    g = df.groupBy(*by).agg(F.count_if(ok).alias("__ok"), F.count(F.lit(1)).alias("__all"))
    out = g.withColumn(name, _percent(F.col("__ok"), F.col("__all"), scale, T.LongType()))
    out = out.withColumnRenamed("__ok", ok_name) if ok_name else out.drop("__ok")
    out = out.withColumnRenamed("__all", total_name) if total_name else out.drop("__all")
    return out


# The correlation bands and their wording.
STRONG = 0.70
WEAK = 0.20
LABELS = {
    "none": "No meaningful linear relationship",
    "strong_pos": "Yes: Strong positive relationship",
    "strong_neg": "Yes: Strong negative relationship",
    "pos": "Yes: Weak to moderate positive relationship",
    "neg": "Yes: Weak to moderate negative relationship",
    "unknown": "Relationship inconclusive",
}


def correlation_label(r: Column) -> Column:
    """Classify a Pearson coefficient into the fixed bands above."""
    return (F.when(F.abs(r) < WEAK, LABELS["none"])
            .when(r >= STRONG, LABELS["strong_pos"])
            .when(r <= -STRONG, LABELS["strong_neg"])
            .when(r > 0, LABELS["pos"])
            .when(r < 0, LABELS["neg"])
            .otherwise(LABELS["unknown"]))


def correlation_summary(df: DataFrame, x: str, y: str, digits: int = 6) -> DataFrame:
    """One row: ``corr(x, y)`` (rounded) and its label.

    Written with the covariance, because ``corr`` of a constant column divides
    by zero in ANSI mode; here, as in PostgreSQL, it is NULL. Rows in which
    either value is NULL do not count.
    """
    both = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop()
    r = both.agg(F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y")).alias("correlation"))
    return r.select(F.round("correlation", digits).alias("correlation"),
                    correlation_label(F.col("correlation")).alias("relation"))
