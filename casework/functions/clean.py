"""Cleaning of dirty text columns: sentinel tokens and unit-suffixed measures.

All helpers return Columns, so they fuse into the surrounding projection
(whole-stage codegen) and never leave the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The missing-value spellings the cleaning rules recognise.
# Pickup time, distance and duration treat 'null' and '' as missing;
# exclusions, extras and cancellation additionally treat 'NaN' as missing.
MISSING_TOKENS = ("null", "")
MISSING_TOKENS_WITH_NAN = ("null", "", "NaN")

# Fixed value: everything that is not a digit or a dot is stripped from a
# measure before the numeric cast ('23.4 km' -> '23.4', '25mins' -> '25').
NON_NUMERIC = r"[^0-9.]"


# Fixed value: the widest decimal that keeps digits on both sides of the point.
MEASURE = "decimal(38,18)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c: str | Column, tokens: Iterable[str] = MISSING_TOKENS) -> Column:
    """Map sentinel spellings of "missing" to NULL; other values pass through.

    ``CASE WHEN x IN (tokens) THEN NULL ELSE x END``; NULL stays NULL.
    Idempotent: applying it twice gives the same column.
    """
    c = _col(c)
    return F.when(~c.isin(*list(tokens)), c)


def parse_measure(c: str | Column, tokens: Iterable[str] = MISSING_TOKENS,
                  dtype: str = MEASURE) -> Column:
    """Unit-suffixed text to a number: sentinels to NULL, strip units, cast.

    The default type is Spark's widest decimal (20 digits before and 18 after
    the point). ``try_cast`` keeps ANSI mode from failing a whole job on a
    single unparsable value: such a value becomes NULL, and
    ``unreadable_measure`` tells it from a missing one.
    """
    cleaned = F.regexp_replace(null_tokens(c, tokens), NON_NUMERIC, "")
    return F.when(cleaned != "", cleaned).try_cast(dtype)


def unreadable_measure(c: str | Column, tokens: Iterable[str] = MISSING_TOKENS,
                       dtype: str = MEASURE) -> Column:
    """True where a text is given but holds no number of ``dtype``: no digit,
    two points, or more digits before or after the point than the type has."""
    given = null_tokens(c, tokens)
    value = parse_measure(c, tokens, dtype)
    digits = F.regexp_extract(F.regexp_replace(given, NON_NUMERIC, ""), r"\.([0-9]*?)0*$", 1)
    kept = F.regexp_extract(value.cast("string"), r"\.([0-9]*?)0*$", 1)
    return given.isNotNull() & (value.isNull() | (digits != kept))


def digits_as_number(c: str | Column, dtype: str = "bigint") -> Column:
    """First run of digits in a text (``Brand#19`` -> 19, ``{"k": 69}`` -> 69)."""
    found = F.regexp_extract(_col(c), r"([0-9]+)", 1)
    return F.when(found != "", found).try_cast(dtype)
