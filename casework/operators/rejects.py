"""Parsing with a side output: good rows, rejected rows with their reason, and
both counts, in one pass over the input."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from casework.functions.clean import MEASURE, MISSING_TOKENS, NON_NUMERIC, null_tokens, parse_measure, unreadable_measure

REASONS = ("no number", "several points", "too many digits")


def measure_fault(c: str | Column, tokens: Iterable[str] = MISSING_TOKENS, dtype: str = MEASURE) -> Column:
    """Why a text holds no number of ``dtype``: one of ``REASONS``, or NULL if it
    holds one or is missing."""
    left = F.regexp_replace(null_tokens(c, tokens), NON_NUMERIC, "")
    no_number, points, digits = REASONS
    reason = (F.when(~left.rlike("[0-9]"), no_number).when(left.rlike(r"\..*\."), points).otherwise(digits))
    return F.when(unreadable_measure(c, tokens, dtype), reason)


def parse_with_rejects(df: DataFrame, measures: Mapping[str, str], tokens: Iterable[str] = MISSING_TOKENS, dtype: str = MEASURE,
                       observation: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(parsed, rejected) of ``df`` for ``measures``: new column -> text column.

    Parsed: every row of ``df`` with the new columns, NULL where the text is
    missing or holds no number. Rejected: the rows of ``df`` as they came, once
    per text that holds no number, with ``column``, ``value`` and ``reason``.
    With ``observation``, running the parsed frame counts the ``rows`` and the
    ``rejected`` texts on the way (``Dataset.observe``): no second pass. Both
    frames are projections of one expression, so the plan reads the input once
    for each that is used.
    """
    tokens = list(tokens)
    faults = F.array(*[F.struct(F.lit(text).alias("column"), F.col(text).alias("value"), measure_fault(text, tokens, dtype).alias("reason")) for text in measures.values()])
    tagged = df.withColumn("__faults", F.filter(faults, lambda f: f["reason"].isNotNull()))
    values = [parse_measure(text, tokens, dtype).alias(new) for new, text in measures.items()]
    kept = [c for c in df.columns if c not in measures]
    seen = tagged if observation is None else tagged.observe(observation, F.count(F.lit(1)).alias("rows"), F.sum(F.size("__faults")).alias("rejected"))
    rejected = tagged.select(*df.columns, F.explode("__faults").alias("__f")).select(*df.columns, "__f.column", "__f.value", "__f.reason")
    return seen.select(*kept, *values), rejected
