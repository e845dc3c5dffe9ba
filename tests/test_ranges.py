"""Window questions by sorted ranges against Spark's own windows."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from casework.operators import counts_over_time, last_anchor, last_known, next_value, previous_value, rank_columns


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(3)
    values = [None, float("nan"), -0.0, 0.0, 1.5, 2.5, 9.0]
    data = [(rnd.choice([None, 1, 1, 1, 1, 2, 3]), rnd.choice(values), i, rnd.choice([None, "a", "b"])) for i in range(1500)]
    return spark.createDataFrame(data, "k long, v double, id long, s string").repartition(6)


@pytest.mark.parametrize("by", [None, "k", ["k", "s"]])
@pytest.mark.parametrize("descending", [False, True])
def test_rank_columns(table, by, descending):
    order = F.col("v").desc_nulls_first() if descending else F.col("v").asc_nulls_last()
    keys = [by] if isinstance(by, str) else by or []
    w = Window.partitionBy(*keys).orderBy(order)
    got = rank_columns(table, "v", by, rank="r", dense="d", number="n", descending=descending, ranges=7)
    plan = got._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    want = table.withColumn("r", F.rank().over(w)).withColumn("d", F.dense_rank().over(w))
    assert rows(got, "id", "r", "d") == rows(want, "id", "r", "d")
    sizes = {tuple(r)[:-1]: r["count"] for r in table.groupBy(*keys).count().collect()}
    for r in got.groupBy(*keys).agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.countDistinct("n").alias("m")).collect():
        size = sizes[tuple(r)[:-3]]
        assert (r.lo, r.hi, r.m) == (1, size, size)


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_lead_lag_and_last_known(table, ranges):
    w = Window.partitionBy("k").orderBy(F.col("v").asc_nulls_last(), "id")
    want = table.withColumn("n", F.lead("s").over(w)).withColumn("p", F.lag("s").over(w)).withColumn("l", F.last("s", ignorenulls=True).over(w))
    assert rows(next_value(table, "k", ["v", "id"], "s", "n", ranges), "id", "n") == rows(want, "id", "n")
    assert rows(previous_value(table, "k", ["v", "id"], "s", "p", ranges), "id", "p") == rows(want, "id", "p")
    assert rows(last_known(table, "k", ["v", "id"], "s", "l", ranges), "id", "l") == rows(want, "id", "l")


def test_empty_and_single_rows(spark, table):
    none = table.where("id < 0")
    assert rank_columns(none, "v", "k", rank="r").count() == 0
    assert next_value(none, "k", ["v"], "s", "n").count() == 0
    one = rank_columns(table.where("id = 5"), "v", rank="r", dense="d", number="n").first()
    assert (one.r, one.d, one.n) == (1, 1, 1)


def test_rows_of_one_tie_span_ranges(spark):
    df = spark.range(4000).select(F.lit(7).alias("v"), "id")
    got = rank_columns(df, "v", rank="r", dense="d", number="n", ranges=8)
    assert got.where("r <> 1 or d <> 1").count() == 0 and got.select("n").distinct().count() == 4000


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("ranges", [2, 9])
def test_last_anchor(spark, inclusive, ranges):
    rnd = random.Random(8)
    events = [(i, rnd.choice([None, 1, 1, 2, 3, 4]), rnd.choice([None, *range(60)])) for i in range(300)]
    marks = [(rnd.choice([None, 1, 1, 1, 2, 3]), rnd.choice([None, *range(60)])) for _ in range(60)]
    e = spark.createDataFrame(events, "id long, k long, t int")
    a = spark.createDataFrame(marks, "k long, since int")
    got = {r.id: r.since for r in last_anchor(e, a, "k", "t", "since", inclusive=inclusive, ranges=ranges).collect()}
    for i, k, t in events:
        past = [s for m, s in marks if None not in (m, s, k, t) and m == k and (s <= t if inclusive else s < t)]
        assert got.pop(i) == (max(past) if past else None)
    assert not got


def test_counts_over_time(spark):
    rnd = random.Random(2)
    day = dt.date(2024, 1, 1)
    data = [(rnd.choice([None, *range(12)]), dt.datetime(2024, 1, rnd.randrange(1, 25), rnd.randrange(24)), rnd.choice(["a", "b", None]), i) for i in range(200)]
    df = spark.createDataFrame(data, "k long, ts timestamp_ntz, s string, id long")
    dates = [day + dt.timedelta(days=n) for n in (0, 3, 4, 9, 30, -5)]
    got = {(r["at"], r.s): r.n for r in counts_over_time(df, "k", "ts", "s", dates, ["id"], ranges=4).collect()}
    want: dict = {}
    for at in dates:
        latest: dict = {}
        for k, ts, s, i in sorted(data, key=lambda r: (r[1], r[3])):
            if k is not None and ts.date() <= at:
                latest[k] = s
        for s in latest.values():
            want[at, s] = want.get((at, s), 0) + 1
    assert got == want
