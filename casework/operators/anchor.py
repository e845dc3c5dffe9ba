"""Events relative to a per-entity anchor date (membership, sign-up, trial).

An anchor table holds one row per entity (``key``, ``anchor``). Events are
equi-joined to it on the entity key with a residual inequality on time, so
Spark plans a hash join (broadcast when AQE measures the anchor side as
small, otherwise a sort-merge join on the key) and filters in the same stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.operators.ranking import first_per, join_on, last_per


def first_event_anchor(events: DataFrame, key: str, time: str, where: Column | None = None,
                       name: str = "anchor", as_date: bool = True) -> DataFrame:
    """One anchor per entity: its earliest (matching) event, e.g. first sign-up."""
    src = events.where(where) if where is not None else events
    t = F.min(time)
    return src.groupBy(key).agg((F.to_date(t) if as_date else t).alias(name))


def relative_to_anchor(events: DataFrame, anchors: DataFrame, key: str, time: str,
                       anchor: str = "anchor", side: str = "after",
                       inclusive: bool = True) -> DataFrame:
    """Events of anchored entities on one side of their anchor.

    ``side='after'``: ``time >= anchor`` (``>`` if not inclusive);
    ``side='before'``: ``time < anchor``, whatever ``inclusive`` is;
    ``side='any'``: all events of anchored entities. Entities without an
    anchor drop out (inner join), as in a member-only report.
    """
    joined = join_on(events, anchors, [key])
    t, a = F.col(time), F.col(anchor)
    if side == "after":
        return joined.where(t >= a if inclusive else t > a)
    if side == "before":
        return joined.where(t < a)
    if side == "any":
        return joined
    raise ValueError(side)


def first_after_anchor(events: DataFrame, anchors: DataFrame, key: str, time: str,
                       anchor: str = "anchor", how: str = "inner") -> DataFrame:
    """Events on each entity's first date at/after its anchor (ties kept).

    Entities without an anchor drop out; with ``how="left"`` all their events
    count, as if they were anchored before the first one.
    """
    if how == "left":
        joined = join_on(events, anchors, [key], "left")
        return first_per(joined.where(F.col(anchor).isNull() | (F.col(time) >= F.col(anchor))), key, time)
    return first_per(relative_to_anchor(events, anchors, key, time, anchor, "after"), key, time)


def last_before_anchor(events: DataFrame, anchors: DataFrame, key: str, time: str,
                       anchor: str = "anchor") -> DataFrame:
    """Events on each entity's last date strictly before its anchor (ties kept)."""
    return last_per(relative_to_anchor(events, anchors, key, time, anchor, "before"), key, time)


def totals_relative(events: DataFrame, anchors: DataFrame, key: str, time: str,
                    amount: Column, anchor: str = "anchor", side: str = "before",
                    count_name: str = "total_items", sum_name: str = "total_amount") -> DataFrame:
    """Per entity: number of events and summed amount on one side of the anchor."""
    rel = relative_to_anchor(events, anchors, key, time, anchor, side)
    return rel.groupBy(key).agg(F.count(F.lit(1)).alias(count_name), F.sum(amount).alias(sum_name))


def member_flag(events: DataFrame, anchors: DataFrame, key: str, time: str,
                anchor: str = "anchor", name: str = "member",
                yes: str = "Y", no: str = "N") -> DataFrame:
    """Every event with a Y/N flag: ``time >= anchor`` (left join, no anchor -> N)."""
    joined = join_on(events, anchors, [key], how="left")
    return joined.withColumn(name, F.when(F.col(time) >= F.col(anchor), yes).otherwise(no))
