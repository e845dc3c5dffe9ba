"""Multi-valued attributes packed in text, and bag edits on them.

``'1, 5'`` becomes ``['1', '5']``; a recipe minus exclusions plus extras is
one array expression per row, so no join or shuffle is needed for it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(c: str | Column, sep: str = ",", element_type: str | None = None) -> Column:
    """``string_to_array(s, sep)`` with each element trimmed.

    NULL stays NULL; an empty string gives an empty array, as in PostgreSQL
    (Spark's ``split('')`` alone would give ``['']``), a blank one a single
    empty element. ``sep`` is taken literally, not as an expression.
    """
    s = _col(c)
    parts = F.transform(F.split(s, re.escape(sep)), lambda x: F.trim(x))
    if element_type:
        parts = F.transform(parts, lambda x: x.cast(element_type))
    empty = F.array().cast(f"array<{element_type or 'string'}>")
    return F.when(s.isNull(), F.lit(None)).when(s == "", empty).otherwise(parts)


def empty_if_null(arr: Column, element_type: str = "string") -> Column:
    """A NULL array acts like no elements (``unnest(NULL)`` yields no rows)."""
    return F.coalesce(arr, F.array().cast(f"array<{element_type}>"))


def bag_edit(base: Column, remove: Column | None = None, add: Column | None = None,
             element_type: str = "string") -> Column:
    """``(base EXCEPT remove) UNION ALL add`` as one array.

    EXCEPT is a set operation: the base list is de-duplicated and every copy
    of a removed element disappears. The added elements are appended
    afterwards as a bag, so an extra that repeats a base element counts twice
    and an extra is never cancelled by an exclusion.
    """
    b = empty_if_null(base, element_type)
    r = empty_if_null(remove, element_type) if remove is not None else None
    kept = F.array_except(b, r) if r is not None else F.array_distinct(b)
    if add is None:
        return kept
    return F.concat(kept, empty_if_null(add, element_type))
