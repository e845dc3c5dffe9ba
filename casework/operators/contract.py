"""Row contracts on a sink: NOT NULL and CHECK rules as a valid/rejected split.

Parquet tables cannot enforce ``CHECK`` constraints, so the contract runs as
part of the job: every row is tagged with the first rule it breaks, valid
rows go to the sink and rejected rows keep their reason for inspection.
The tag is a plain projection (no shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


class Rule:
    """A named row rule. ``kind='not_null'`` fails on NULL; ``kind='check'``
    fails only when the condition is FALSE (SQL CHECK: NULL passes)."""

    def __init__(self, name: str, cond: Column, kind: str = "check"):
        self.name, self.cond, self.kind = name, cond, kind

    def failed(self) -> Column:
        if self.kind == "not_null":
            return self.cond.isNull()
        return F.coalesce(~self.cond, F.lit(False))


def not_null(*cols: str) -> list[Rule]:
    return [Rule(f"{c} is null", F.col(c), "not_null") for c in cols]


def check(name: str, cond: Column) -> Rule:
    return Rule(name, cond, "check")


def tag_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reject_reason``: the first failing rule's name, NULL when valid."""
    reason = None
    for r in rules:
        reason = F.when(r.failed(), F.lit(r.name)) if reason is None \
            else reason.when(r.failed(), F.lit(r.name))
    return df.withColumn(REASON, reason if reason is not None else F.lit(None).cast("string"))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the tag, rejected rows with ``reject_reason``)."""
    tagged = tag_violations(df, rules)
    return (tagged.where(F.col(REASON).isNull()).drop(REASON),
            tagged.where(F.col(REASON).isNotNull()))


def contract_summary(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Counts per outcome: (status 'valid'/'rejected', reason, n_rows)."""
    tagged = tag_violations(df, rules)
    return (tagged.groupBy(F.when(F.col(REASON).isNull(), "valid").otherwise("rejected").alias("status"),
                           F.col(REASON).alias("reason"))
                  .agg(F.count(F.lit(1)).alias("n_rows")))
