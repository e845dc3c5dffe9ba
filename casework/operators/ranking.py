"""Ranking with ties: top-k per group, first/last/n-th per entity, dense ids.

Design for skew (measured with ``scripts/skew_probe.py``)
-------------------------------------------------------
* ``rank() / dense_rank() = k`` per group is written as the window plus the
  filter, because Catalyst then inserts a *partial* ``WindowGroupLimit``
  before the shuffle: every map task keeps only its local top-k rows per
  key, so a key holding a third of the rows ships a handful of rows, not a
  third of the table.
* The global top with ties (no partition key) is a filter by the best value,
  a one-row aggregate, so ties never meet in one task.
* Ranks materialised for every row (``rank``, ``dense_rank`` as a column) come
  from one sort by range with the ties carried over the borders of ranges
  (``casework.operators.ranges``): no window on the group key.
* Global row numbers (``dense_ids``) number equal-depth ranges of the order
  side by side instead of a single-partition window.

Ordering follows PostgreSQL: NULLs last ascending, first descending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.sources.sinks import materialize


def _as_list(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def join_back(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``small`` (one row per key) onto ``df`` with NULL-safe key equality.

    Group keys may be NULL (SQL GROUP BY / PARTITION BY treat NULL as a
    value), so ``<=>`` is used; Spark still plans it as an equi-join.
    """
    keys = list(keys)
    if not keys:
        return with_scalars(df, small)
    renamed = small
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__k_{k}")
    cond = [df[k].eqNullSafe(renamed[f"__k_{k}"]) for k in keys]
    out = df.join(renamed, cond, how)
    return out.drop(*[f"__k_{k}" for k in keys])


def join_on(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``small`` onto ``df`` by plain equality, as SQL's ``ON a.k = b.k``:
    a NULL key matches nothing."""
    keys = list(keys)
    renamed = small
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__k_{k}")
    out = df.join(renamed, [df[k] == renamed[f"__k_{k}"] for k in keys], how)
    return out.drop(*[f"__k_{k}" for k in keys])


def scalar_row(one_row: DataFrame) -> Column:
    """The single row of a global aggregate as a struct-valued scalar subquery.

    ``one_row`` must yield exactly one row (an aggregate without grouping
    keys). Spark runs it once, before the outer plan, and inlines the value:
    nothing is joined and no row of the outer plan is paired with anything.
    """
    return one_row.select(F.struct(*one_row.columns)).scalar()


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach every column of a one-row aggregate to each row of ``df``."""
    packed = scalar_row(one_row)
    return df.select("*", *[packed.getField(c).alias(c) for c in one_row.columns])


def _ordered(value: str, descending: bool) -> Column:
    c = F.col(value)
    return c.desc_nulls_first() if descending else c.asc_nulls_last()


def top_with_ties(df: DataFrame, value: str, by: str | Sequence[str] | None = None,
                  largest: bool = True) -> DataFrame:
    """Rows whose ``value`` is the best in their group (``rank() ... = 1``).

    ``largest=True`` keeps the maximum (``ORDER BY value DESC``), else the
    minimum. Ties are all kept. NULL ranks as in PostgreSQL: before every
    value in descending order, after every value in ascending order. Per group
    this is the window with a rank filter (partial group limit before the
    shuffle). Without groups the best value is a one-row aggregate, read as a
    scalar subquery that shares the exchange below ``df``, and a filter keeps
    its rows where they are: no task sees all ties.
    """
    by = _as_list(by)
    if not by:
        best = F.max(value) if largest else F.min(value)
        if largest:
            best = F.when(F.bool_or(F.col(value).isNull()), None).otherwise(best)
        return df.where(F.col(value).eqNullSafe(df.agg(best.alias("best")).scalar()))
    w = Window.partitionBy(*by).orderBy(_ordered(value, largest))
    return df.withColumn("__r", F.rank().over(w)).where(F.col("__r") == 1).drop("__r")


def first_per(df: DataFrame, by: str | Sequence[str], order: str) -> DataFrame:
    """All rows at each group's earliest ``order`` value (dense_rank asc = 1)."""
    return nth_per(df, by, order, 1)


def last_per(df: DataFrame, by: str | Sequence[str], order: str) -> DataFrame:
    """All rows at each group's latest ``order`` value (dense_rank desc = 1)."""
    return nth_per(df, by, order, 1, descending=True)


def nth_per(df: DataFrame, by: str | Sequence[str], order: str, n: int,
            descending: bool = False) -> DataFrame:
    """All rows at each group's n-th distinct ``order`` value (dense_rank = n).

    Catalyst turns the filter into a group limit of n that also runs before
    the shuffle, so only rows that can still rank within the first n leave
    each map task.
    """
    w = Window.partitionBy(*_as_list(by)).orderBy(_ordered(order, descending))
    return df.withColumn("__r", F.dense_rank().over(w)).where(F.col("__r") == n).drop("__r")


def dense_rank_column(df: DataFrame, by: str | Sequence[str], order: str, name: str,
                      descending: bool = False, where: Column | None = None) -> DataFrame:
    """Add ``dense_rank() over (partition by by order by order)`` as ``name``.

    The ranks come from one sort by range (``ranges.rank_columns``), so neither
    a hot group nor a missing group key puts its rows or its values in one
    task. With ``where``, only matching rows are ranked and the others get NULL
    (``CASE WHEN p THEN dense_rank() ... END``).
    """
    from casework.operators.ranges import rank_columns

    if where is None:
        return rank_columns(df, order, by, dense=name, descending=descending)
    flagged = df.withColumn("__ranked", where)
    ranked = rank_columns(flagged, order, [*_as_list(by), "__ranked"], dense=name, descending=descending)
    return ranked.withColumn(name, F.when(F.col("__ranked"), F.col(name))).drop("__ranked")


def dense_ids(df: DataFrame, order: Sequence[str], name: str = "row_id",
              ranges: int | None = None) -> DataFrame:
    """``row_number() over (order by <order>)`` without a single-partition window.

    The rows are cut into ``ranges`` ranges of about equal row counts
    (default: the session's shuffle partitions) by a range shuffle on all order
    columns, sorted within their range and written, with their place, as a
    stage in the shared folder. The place is the range and the position in it,
    so a count per range and a running sum over those few rows give the offset
    of each range. The number of ranges does not depend on the values: an
    outlier or a hot leading value costs nothing, as long as further order
    columns tell its rows apart (rows equal in all of them share a range).

    The stage is written when the function is called; a lost executor reads it
    again. ``order`` should be a total order (list every column that can break
    a tie) for the ids to be deterministic.
    """
    order, spark = list(order), df.sparkSession
    conf = spark.conf.get("spark.sql.shuffle.partitions", "200")
    ranges = ranges or (int(conf) if str(conf).isdigit() else 200)
    placed = (df.repartitionByRange(max(1, ranges), *order).sortWithinPartitions(*order)
              .withColumn("__at", F.monotonically_increasing_id()))
    placed = materialize(spark, placed, "dense_ids", view=False).withColumn("__p", F.shiftright("__at", 33))
    counts = placed.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    within = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.join(offsets, "__p").withColumn(name, (F.col("__off") + within + 1).cast("bigint"))
            .select(*df.columns, name))


def sort_like_sql(df: DataFrame, *keys: str | tuple[str, str]) -> DataFrame:
    """``ORDER BY k1 [DESC], ...`` with PostgreSQL's NULL placement made explicit.

    PostgreSQL puts NULLs last ascending and first descending; Spark's
    defaults are the opposite, so each key states its NULL order. Keys are
    names (ascending) or ``(name, "desc")``. The sort is a range-partitioned
    shuffle plus per-partition sorts, so it scales out with the result.
    """
    cols = []
    for k in keys:
        name, direction = (k, "asc") if isinstance(k, str) else k
        c = F.col(name)
        cols.append(c.desc_nulls_first() if direction == "desc" else c.asc_nulls_last())
    return df.orderBy(*cols)
