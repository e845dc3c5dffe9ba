"""Customer lifecycle over an entity's event log: next state, state at a date,
conversion after the first event, time to a milestone.

Event logs are keyed by entity and ordered by time. A plain
``lead() over (partition by entity order by time)`` sorts each entity in one
task, which fails when one entity holds a large share of the log. The
operators here avoid that: questions about every row's successor use
``ranges.next_value`` (one sort by range), questions about an entity's first
rows use ``first_row_next`` (a group limit of two rows before the shuffle),
and last-state questions use ``max_by`` aggregates, which combine map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.operators.ranking import join_on


def state_at(df: DataFrame, key: str, time: str, state: str, at: Column,
             tiebreak: Sequence[str] = (), name: str | None = None) -> DataFrame:
    """Each entity's state as of a bound: the value of its latest row with
    ``time`` satisfying ``at`` (e.g. ``time <= '2020-12-31'``).

    Same rows as "filter, then ``lead``, keep rows without a successor", but
    as a ``max_by`` aggregate: partial per map task, so only one row per
    entity and task is shuffled and no window sorts a whole entity. (The
    struct ordering makes Spark use its sort-based aggregate.)
    """
    ordering = F.struct(F.col(time), *[F.col(c) for c in tiebreak])
    return (df.where(at).groupBy(key)
              .agg(F.max_by(state, ordering).alias(name or state)))


def first_row_next(df: DataFrame, key: str, order: Sequence[str], value: str,
                   name: str = "next_value") -> DataFrame:
    """Per entity: its first row's ``value`` and the value of the row after it.

    (``lead`` read at each entity's first row.) ``order`` must be total.
    Entities with a single row get NULL.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    # the filter becomes a group limit that also runs before the shuffle
    two = df.select(key, F.col(value).alias("__v"), rank.alias("__r")).where(F.col("__r") <= 2)
    return two.groupBy(key).agg(F.max(F.when(F.col("__r") == 1, F.col("__v"))).alias("current"),
                                F.max(F.when(F.col("__r") == 2, F.col("__v"))).alias(name))


def milestone_after_anchor(anchors: DataFrame, milestones: DataFrame, key: str,
                           anchor: str, time: str, name: str = "milestone") -> DataFrame:
    """Per anchored entity, the first milestone time strictly after its anchor.

    ``anchors`` has one row per entity, so the join emits each milestone row
    at most once (no pairs within an entity); the minimum is a partial
    aggregate.
    """
    cand = join_on(milestones.select(key, time), anchors.select(key, anchor), [key])
    return (cand.where(F.col(time) > F.col(anchor))
                .groupBy(key, anchor).agg(F.min(time).alias(name)))
