"""Multi-valued attributes: tagged explosion and bag-edited ingredient rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.functions.arrays import bag_edit, empty_if_null


def tagged_explode_outer(df: DataFrame, lists: dict[str, Column], keep: list[str],
                         tag_name: str = "mod_type", value_name: str = "value",
                         element_type: str = "string") -> DataFrame:
    """One row per (tag, element) across several list columns, rows kept.

    This is ``LEFT JOIN LATERAL (SELECT 'a', unnest(x) UNION ALL SELECT 'b',
    unnest(y)) ON true``: each row's lists become one array of
    (tag, element) structs and a single ``explode_outer`` emits them, so a
    row whose lists are all NULL/empty still appears once with NULL tag and
    value. No join or shuffle: a ``Generate`` in the same stage as the scan.
    """
    def tag_with(t: str):
        # one-argument lambda: F.transform reads a two-argument one as (x, index)
        return lambda x: F.struct(F.lit(t).alias(tag_name), x.alias(value_name))

    parts = [F.transform(empty_if_null(arr, element_type), tag_with(tag))
             for tag, arr in lists.items()]
    tagged = F.concat(*parts) if len(parts) > 1 else parts[0]
    return (df.select(*keep, F.explode_outer(tagged).alias("__tv"))
            .select(*keep, F.col(f"__tv.{tag_name}").alias(tag_name),
                    F.col(f"__tv.{value_name}").alias(value_name)))


def explode_bag(df: DataFrame, base: Column, remove: Column | None, add: Column | None,
                keep: list[str], name: str = "item", element_type: str = "string") -> DataFrame:
    """One row per element of ``(base EXCEPT remove) UNION ALL add``.

    A row whose edited bag is empty disappears (plain ``explode``).
    """
    bag = bag_edit(base, remove, add, element_type)
    return df.select(*keep, F.explode(bag).alias(name))
