"""Ordered text lists per group (``string_agg ... ORDER BY``), with counts.

Lists are assembled from *pre-aggregated* (group, item) counts: the
collected array per group holds one entry per distinct item, bounded by the
item domain, never one entry per input row. Repeated items are expanded
back (``array_repeat``) only inside the final expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.functions.text import concat_skip_nulls


def _sorted_labels(entries: Column) -> Column:
    """Sort an array<struct<k, label, n>> by k and expand labels n times."""
    ordered = F.array_sort(entries)
    return F.flatten(F.transform(ordered, lambda e: F.array_repeat(e["label"], e["n"].cast("int"))))


def ordered_list(df: DataFrame, by: Sequence[str], item: str, name: str,
                 sep: str = ", ", where: Column | None = None,
                 sort_key: str | None = None) -> DataFrame:
    """``string_agg(item, sep ORDER BY item) [FILTER (WHERE p)]`` per group.

    Duplicates are kept (a bag). NULL items are skipped; a group with no
    (matching) item gets NULL, like ``string_agg`` over no rows.
    """
    by = list(by)
    src = df.where(F.col(item).isNotNull())
    if where is not None:
        src = src.where(where)
    k = F.col(sort_key) if sort_key else F.col(item)
    counted = src.groupBy(*by, item, *( [sort_key] if sort_key else [])).agg(
        F.count(F.lit(1)).alias("__n"))
    entry = F.struct(k.alias("k"), F.col(item).cast("string").alias("label"), F.col("__n").alias("n"))
    lists = counted.groupBy(*by).agg(F.collect_list(entry).alias("__e"))
    return lists.select(*by, F.array_join(_sorted_labels(F.col("__e")), sep).alias(name))


def counted_list(df: DataFrame, by: Sequence[str], item: str, name: str,
                 sep: str = ", ", count_fmt: str = "x") -> DataFrame:
    """Sorted distinct items per group, prefixed ``<n>x`` when an item repeats.

    ``Bacon, Bacon, Beef`` becomes ``2xBacon, Beef``; the order is by item.
    """
    by = list(by)
    counted = (df.where(F.col(item).isNotNull())
                 .groupBy(*by, item).agg(F.count(F.lit(1)).alias("__n")))
    label = F.when(F.col("__n") > 1,
                   concat_skip_nulls("__n", F.lit(count_fmt), item)).otherwise(F.col(item).cast("string"))
    entry = F.struct(F.col(item).alias("k"), label.alias("label"), F.lit(1).alias("n"))
    lists = counted.groupBy(*by).agg(F.collect_list(entry).alias("__e"))
    return lists.select(*by, F.array_join(_sorted_labels(F.col("__e")), sep).alias(name))


def filtered_lists(df: DataFrame, by: Sequence[str], item: str, lists: dict[str, Column],
                   sep: str = ", ", counted: bool = False) -> DataFrame:
    """Several ``string_agg(item, sep ORDER BY item) FILTER (WHERE p)`` at once.

    One aggregate counts, per (group, item), how many rows match each filter;
    a second collects those counts per group. Each named list is NULL when no
    row of the group matches its filter. Groups appear when they have at
    least one non-NULL item.

    With ``counted=True`` the rows are already aggregated: each value of
    ``lists`` is a count column (how often the row's item belongs to that
    list), e.g. from a cheaper aggregate on a numeric key before the item
    labels were joined. Rows with the same item in a group need not be
    merged: sorted, their repeats come out adjacent.
    """
    by = list(by)
    names = list(lists)
    src = df.where(F.col(item).isNotNull())
    if counted:
        per_item = src.select(*by, item, *[lists[n].alias(f"__n{i}") for i, n in enumerate(names)])
    else:
        per_item = (src.groupBy(*by, item)
                    .agg(*[F.count_if(lists[n]).alias(f"__n{i}") for i, n in enumerate(names)]))
    entry = F.struct(F.col(item).alias("k"), *[F.col(f"__n{i}") for i in range(len(names))])
    grouped = per_item.groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("__e"))
    def repeat_by(field: str):
        # one-argument lambda: F.transform reads a two-argument one as (x, index)
        return lambda e: F.array_repeat(e["k"].cast("string"), e[field].cast("int"))

    out = []
    for i, n in enumerate(names):
        arr = F.flatten(F.transform(F.col("__e"), repeat_by(f"__n{i}")))
        out.append(F.when(F.size(arr) > 0, F.array_join(arr, sep)).alias(n))
    return grouped.select(*by, *out)
