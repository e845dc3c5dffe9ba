"""Window questions over a total order, cut into ranges instead of keys.

A SQL window puts all rows of a key (without a key: all rows) in one task. Here
the rows are sorted by range of (key, order, ...) and written once as a stage:
ranges hold about equal numbers of rows whatever the keys are. Inside a range a
forward scan compares each row with the one before. What crosses a border is
one row per range: its first and last key, its counts and its last values. A
pass over these few rows (at most ``ranges``, a parameter) gives every range
what it continues: its offset, the start of the tie and of the group that run
on, the last row's values.

``rank_columns`` (rank, dense_rank, row_number), ``next_value`` and ``previous_value``
(lead, lag), ``last_known`` (the last value that isn't null), ``last_anchor`` (as-of
merge) and ``counts_over_time`` (sweep line) are read from the same scan. Rows of one tie need not share a range: a hash of
the row is the last sort column, so a value that fills a third of the table is
dealt to several ranges.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.sources.sinks import materialize

_SCAN = [("__p", T.LongType()), ("__i", T.LongType()), ("__tie", T.LongType()), ("__grp", T.LongType()), ("__d", T.LongType()), ("__dg", T.LongType())]


def _names(cols: str | Sequence[str] | None) -> list[str]:
    return [] if cols is None else [cols] if isinstance(cols, str) else list(cols)


def _differs(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Row by row: not the same value (nulls are the same, NaNs too)."""
    null_a, null_b = (np.asarray(x.is_null()) for x in (a, b))
    same = np.asarray(pc.fill_null(pc.equal(a, b), False))
    if pa.types.is_floating(a.type):
        same = same | np.asarray(pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return np.where(null_a | null_b, null_a != null_b, ~same)


def _scan(batches: Iterator[pa.RecordBatch], by, ties, lag, fill) -> Iterator[pa.RecordBatch]:
    """One range in order: positions, starts of ties and groups, carried values."""
    at, before = 0, None          # rows so far, the last row
    tie, grp, d, dg = -1, -1, 0, -1
    known: dict[str, pa.Array] = {}
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        column = {name: b.column(b.schema.get_field_index(name)) for name in b.schema.names}

        def shifted(name):
            head = before[name] if before is not None else column[name].slice(0, 1)
            return pa.concat_arrays([head, column[name].slice(0, n - 1)])

        new_grp, new_tie = np.zeros(n, bool), np.zeros(n, bool)
        for name in by:
            new_grp |= _differs(column[name], shifted(name))
        for name in ties:
            new_tie |= _differs(column[name], shifted(name))
        if before is None:
            new_grp[0] = new_tie[0] = False  # told by the borders
        new_tie |= new_grp
        place = np.arange(at, at + n)
        ds = d + np.cumsum(new_tie)
        starts = np.maximum.accumulate(np.where(new_tie, place, tie))
        groups = np.maximum.accumulate(np.where(new_grp, place, grp))
        dgs = np.maximum.accumulate(np.where(new_grp, ds, dg))
        out = [np.full(n, b.column(b.schema.get_field_index("__p"))[0].as_py()), place, starts, groups, ds, dgs]
        extra = []
        for name in lag:
            value = shifted(name)
            gone = new_grp.copy()
            gone[0] |= before is None
            extra.append(pc.if_else(pa.array(gone), pa.scalar(None, value.type), value))
        for name in fill:
            value = column[name]
            last = np.maximum.accumulate(np.where(np.asarray(value.is_valid()), np.arange(n), -1))
            own = np.maximum(groups - at, -1)    # the group's start, if in this batch
            pool = pa.concat_arrays([known.get(name, pa.nulls(1, value.type)), value])
            take = np.where(last >= np.maximum(own, 0), last + 1, np.where(own >= 0, -1, 0))
            got = pool.take(pa.array(np.where(take < 0, 0, take), mask=take < 0))
            extra.append(got)
            known[name] = got.slice(n - 1, 1)
        at += n
        tie, grp, d, dg = int(starts[-1]), int(groups[-1]), int(ds[-1]), int(dgs[-1])
        before = {name: c.slice(n - 1, 1) for name, c in column.items()}
        keep = [name for name in b.schema.names if name != "__p"]
        yield pa.RecordBatch.from_arrays(
            [column[k] for k in keep] + [pa.array(x.astype(np.int64)) for x in out] + extra,
            names=keep + [k for k, _ in _SCAN] + [f"__lag_{k}" for k in lag] + [f"__fill_{k}" for k in fill])


def _same(a, b) -> bool:
    return all(x == y or (x is None and y is None) or (x != x and y != y) for x, y in zip(a, b))


def scan_in_order(df: DataFrame, by: str | Sequence[str] | None, order: Sequence[Column], ties: Sequence[str] = (),
                  lag: Sequence[str] = (), fill: Sequence[str] = (), ranges: int | None = None, name: str = "ranges") -> DataFrame:
    """``df`` with what a window partitioned by ``by`` and ordered by ``order`` sees.

    Adds ``__number`` (row_number in the group), ``__rank`` and ``__dense``
    (rank and dense_rank by the values of ``ties``), ``__lag_x`` for each x of
    ``lag`` (the value of the row before in the group) and ``__fill_x`` for each
    x of ``fill`` (the last value that isn't null at or before the row in the
    group). NULL is a group and a tie of its own. The stage is written when the
    function is called.
    """
    by, spark = _names(by), df.sparkSession
    conf = spark.conf.get("spark.sql.shuffle.partitions", "200")
    ranges = max(1, ranges or (int(conf) if str(conf).isdigit() else 200))
    keys = [F.col(c).asc_nulls_first() for c in by]
    spread = F.xxhash64(*df.columns)
    placed = (df.repartitionByRange(ranges, *keys, *order, spread).sortWithinPartitions(*keys, *order, spread)
              .withColumn("__p", F.spark_partition_id().cast("long")))
    schema = T.StructType([*df.schema.fields, *(T.StructField(k, t) for k, t in _SCAN),
                           *(T.StructField(f"__lag_{k}", df.schema[k].dataType) for k in lag),
                           *(T.StructField(f"__fill_{k}", df.schema[k].dataType) for k in fill)])
    ties, lag, fill = list(ties), list(lag), list(fill)
    scanned = materialize(spark, placed.mapInArrow(lambda it: _scan(it, by, ties, lag, fill), schema), name, view=False)
    carried = spark.createDataFrame(_borders(scanned, by, ties, lag, fill), T.StructType(
        [T.StructField(k, T.LongType()) for k in ("__p", "__offset", "__doff", "__ctie", "__cgrp", "__cdg")] + [T.StructField("__on", T.BooleanType())]
        + [T.StructField(f"__clag_{k}", df.schema[k].dataType) for k in lag] + [T.StructField(f"__cfill_{k}", df.schema[k].dataType) for k in fill]))
    # one row per range
    x = scanned.join(F.broadcast(carried), "__p")
    place = F.col("__offset") + F.col("__i")
    start = F.when(F.col("__grp") >= 0, F.col("__offset") + F.col("__grp")).otherwise(F.col("__cgrp"))
    tie = F.when(F.col("__tie") >= 0, F.col("__offset") + F.col("__tie")).otherwise(F.col("__ctie"))
    first_tie = F.when(F.col("__dg") >= 0, F.col("__doff") + F.col("__dg")).otherwise(F.col("__cdg"))
    goes_on = F.col("__grp") < 0
    return x.select(
        *df.columns, (place - start + 1).alias("__number"), (tie - start + 1).alias("__rank"), (F.col("__doff") + F.col("__d") - first_tie + 1).alias("__dense"),
        *(F.when((F.col("__i") == 0) & F.col("__on"), F.col(f"__clag_{k}")).otherwise(F.col(f"__lag_{k}")).alias(f"__lag_{k}") for k in lag),
        *(F.when(goes_on & F.col("__on") & F.col(f"__fill_{k}").isNull(), F.col(f"__cfill_{k}")).otherwise(F.col(f"__fill_{k}")).alias(f"__fill_{k}") for k in fill))


def _borders(scanned: DataFrame, by, ties, lag, fill) -> list[tuple]:
    """What each range continues, from one row per range."""
    head = F.min_by(F.struct(F.col("__i"), *by, *ties), "__i").alias("head")
    tail = F.max_by(F.struct(F.col("__i"), *by, *ties), "__i").alias("tail")
    rows = scanned.groupBy("__p").agg(
        F.count(F.lit(1)).alias("n"), head, tail, F.max("__tie").alias("tie"), F.max("__grp").alias("grp"), F.max("__d").alias("d"), F.max("__dg").alias("dg"),
        *(F.max_by(k, "__i").alias(f"lag_{k}") for k in lag), *(F.max_by(f"__fill_{k}", "__i").alias(f"fill_{k}") for k in fill)).collect()
    out, before = [], None
    offset = doff = tie = grp = dg = 0
    last_fill: dict = {}
    for r in sorted(rows, key=lambda r: r["__p"]):
        key, full = tuple(r.head)[1:1 + len(by)], tuple(r.head)[1:]
        on = before is not None and _same(before[:len(by)], key)
        same_tie = on and _same(before, full)
        if not same_tie:          # the first row starts a tie, maybe a group
            doff, tie = doff + 1, offset
        if not on:
            grp, dg, last_fill = offset, doff, {}
        out.append((r["__p"], offset, doff, tie, grp, dg, on, *((r_lag.get(k) if on else None) for k in lag), *(last_fill.get(k) for k in fill)))
        if r.tie >= 0:
            tie = offset + r.tie
        if r.grp >= 0:
            grp, dg, last_fill = offset + r.grp, doff + r.dg, {}
        for k in fill:
            last_fill[k] = last_fill.get(k) if r[f"fill_{k}"] is None else r[f"fill_{k}"]
        offset, doff, before = offset + r.n, doff + r.d, tuple(r.tail)[1:]
        r_lag = {k: r[f"lag_{k}"] for k in lag}
    return out


def _sql_order(name: str, descending: bool) -> Column:
    return F.col(name).desc_nulls_first() if descending else F.col(name).asc_nulls_last()


def rank_columns(df: DataFrame, order: str | Sequence[str], by: str | Sequence[str] | None = None, rank: str | None = None, dense: str | None = None,
                 number: str | None = None, descending: bool = False, ranges: int | None = None) -> DataFrame:
    """Add ``rank()``, ``dense_rank()`` and / or ``row_number()`` over
    (partition by ``by`` order by ``order``) for every row, under the given names.

    NULLs rank as in PostgreSQL (last ascending, first descending). Without
    ``by`` all rows are one group. Row numbers within a tie follow a hash of
    the row.
    """
    order = _names(order)
    x = scan_in_order(df, by, [_sql_order(c, descending) for c in order], ties=order, ranges=ranges, name="ranks")
    named = [(rank, "__rank"), (dense, "__dense"), (number, "__number")]
    return x.select(*df.columns, *(F.col(c).alias(n) for n, c in named if n))


def previous_value(df: DataFrame, key: str | Sequence[str], order: Sequence[str], value: str, name: str, ranges: int | None = None) -> DataFrame:
    """Add ``lag(value) over (partition by key order by order...)`` as ``name``."""
    x = scan_in_order(df, key, [F.col(c).asc_nulls_last() for c in order], lag=[value], ranges=ranges, name="lags")
    return x.select(*df.columns, F.col(f"__lag_{value}").alias(name))


def next_value(df: DataFrame, key: str | Sequence[str], order: Sequence[str], value: str, name: str, ranges: int | None = None,
               first_flag: str | None = None) -> DataFrame:
    """Add ``lead(value) over (partition by key order by order...)`` as ``name``.

    The rows are scanned from the last to the first, so the next row's value is
    that of the row before in the scan. ``order`` should be total within a key:
    with ties the choice is arbitrary in SQL as well. ``first_flag`` adds a
    boolean that marks each key's first row (by a scan of its own).
    """
    if first_flag:
        numbered = rank_columns(df, order, key, number="__first", ranges=ranges)
        df = numbered.withColumn(first_flag, F.col("__first") == 1).drop("__first")
    x = scan_in_order(df, key, [F.col(c).desc_nulls_first() for c in order], lag=[value], ranges=ranges, name="leads")
    return x.select(*df.columns, F.col(f"__lag_{value}").alias(name))


def last_known(df: DataFrame, key: str | Sequence[str], order: Sequence[str], value: str, name: str, ranges: int | None = None) -> DataFrame:
    """Add ``last_value(value ignore nulls)`` from the key's start to the row."""
    x = scan_in_order(df, key, [F.col(c).asc_nulls_last() for c in order], fill=[value], ranges=ranges, name="last-known")
    return x.select(*df.columns, F.col(f"__fill_{value}").alias(name))


def last_anchor(events: DataFrame, anchors: DataFrame, key: str, time: str, anchor: str, name: str | None = None,
                inclusive: bool = True, ranges: int | None = None) -> DataFrame:
    """As-of merge: every event with its key's last anchor at or before its time
    (before it, if not ``inclusive``); NULL without one.

    Events and anchors are one sequence by (key, time), in which the anchor is
    carried forward; nothing is joined, so a key with many events and many
    anchors makes no pairs. Rows without a key or a time get no anchor; anchors
    without one are left out.
    """
    name = name or anchor
    cols = [c for c in events.columns if c != name]
    marks = anchors.where(F.col(key).isNotNull() & F.col(anchor).isNotNull()).select(
        F.col(key).alias("__key"), F.col(anchor).alias("__t"), F.lit(0 if inclusive else 1).alias("__turn"), F.col(anchor).alias("__anchor"))
    rows = events.select(F.col(key).alias("__key"), F.col(time).alias("__t"), F.lit(1 if inclusive else 0).alias("__turn"), F.struct(*cols).alias("__row"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    x = scan_in_order(both, "__key", [F.col("__t").asc_nulls_last(), F.col("__turn").asc()], fill=["__anchor"], ranges=ranges, name="as-of")
    found = F.when(F.col("__key").isNotNull() & F.col("__t").isNotNull(), F.col("__fill___anchor"))
    return x.where("__row is not null").select("__row.*", found.alias(name))


def counts_over_time(df: DataFrame, key: str, time: str, state: str, dates: Sequence, tiebreak: Sequence[str] = (),
                     name: str = "n", ranges: int | None = None) -> DataFrame:
    """(at, ``state``, ``name``): keys per state at each of ``dates``, by a sweep line.

    A key is in the state of its latest row at or before the end of a date.
    Each row that changes a key's state counts +1 for the new state and -1 for
    the one left, on its day; the running sum per state up to a date is the
    count, for any number of dates in one pass over the log. States without a
    key at a date are left out; a null state is a state like any other. What
    meets for the running sum is one row per state and date asked for.
    """
    asked = F.array(*[F.lit(d).cast("date") for d in sorted(set(dates))])
    last = F.struct(F.col(time), *[F.col(c) for c in tiebreak])
    # several rows of a key on one day: the last one tells the day's state;
    # wrapped, so that a null state differs from no row before
    daily = (df.where(F.col(key).isNotNull() & F.col(time).isNotNull()).groupBy(F.col(key).alias("__key"), F.to_date(time).alias("__day"))
             .agg(F.max_by(F.struct(F.col(state).alias("v")), last).alias("__state")))
    moves = previous_value(daily, "__key", ["__day"], "__state", "__left", ranges)
    moves = moves.where(F.col("__left").isNull() | ~F.col("__left.v").eqNullSafe(F.col("__state.v")))
    steps = moves.select("__day", F.explode(F.array(F.struct(F.col("__state").alias("s"), F.lit(1).alias("d")),
                                                    F.struct(F.col("__left").alias("s"), F.lit(-1).alias("d")))).alias("m")).where("m.s is not null")
    # a change counts from the first date at or after its day on
    at = F.element_at(F.filter(asked, lambda a: a >= F.col("__day")), 1)
    changes = (steps.where(F.col("__day") <= F.array_max(asked)).groupBy(F.col("m.s.v").alias("__s"), at.alias("at")).agg(F.sum("m.d").alias("__d")))
    zeros = changes.groupBy("__s").agg(F.min("at").alias("__from")).select("__s", F.explode(F.filter(asked, lambda a: a >= F.col("__from"))).alias("at"), F.lit(0).alias("__d"))
    per_date = changes.unionByName(zeros).groupBy("__s", "at").agg(F.sum("__d").alias("__d"))
    so_far = F.sum("__d").over(Window.partitionBy("__s").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    return per_date.select("at", F.col("__s").alias(state), so_far.cast("bigint").alias(name)).where(F.col(name) > 0)
