"""Group statistics attached to detail rows (``agg(x) over (partition by k)``).

A window without ORDER BY over the whole group equals the group aggregate
joined back to its rows. The aggregate is two-phase (partial per map task),
so a hot group is reduced before the shuffle, and the join back is a
(NULL-safe) equi-join that AQE can broadcast or split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from casework.operators.ranking import join_back


def with_group_stats(df: DataFrame, by: Sequence[str], stats: dict[str, Column]) -> DataFrame:
    """Add per-group aggregates (``{name: F.avg(x)}``) as columns of every row."""
    by = list(by)
    agg = df.groupBy(*by).agg(*[c.alias(n) for n, c in stats.items()])
    return join_back(df, agg, by)
