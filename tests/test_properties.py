"""Property tests: invariants that must hold for any input."""

import datetime as dt

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casework.functions import bag_edit
from casework.operators import (
    cond_counts, dense_ids, dense_rank_column, next_value, share_of_total, state_at,
)

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
small_ints = st.lists(st.integers(0, 6), max_size=6)


@SETTINGS
@given(st.lists(st.tuples(small_ints, small_ints, small_ints), min_size=1, max_size=8))
def test_bag_edit_size(spark, bags):
    df = spark.createDataFrame(bags, "b array<int>, r array<int>, a array<int>")
    got = df.select(F.size(bag_edit(F.col("b"), F.col("r"), F.col("a"), "int")).alias("n")).collect()
    assert [r.n for r in got] == [len(set(b) - set(r)) + len(a) for b, r, a in bags]


events = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 200), st.sampled_from("abc")),
                  min_size=1, max_size=40)


def _frame(spark, evs):
    base = dt.datetime(2024, 1, 1)
    data = [(i, k, base + dt.timedelta(hours=h), s) for i, (k, h, s) in enumerate(evs)]
    return spark.createDataFrame(data, "id long, k long, ts timestamp_ntz, s string")


@SETTINGS
@given(events)
def test_counts_sum_to_total_and_shares_to_100(spark, evs):
    df = _frame(spark, evs)
    c = cond_counts(df, "k", {n: F.col("s") == n for n in "abc"}).collect()
    assert sum(r.a + r.b + r.c for r in c) == len(evs)
    shares = share_of_total(df.groupBy("s").agg(F.count(F.lit(1)).alias("n")), "n").collect()
    assert abs(sum(r.percentage for r in shares) - 100) < 0.01 * len(shares) + 1e-9


@SETTINGS
@given(events)
def test_snapshot_at_last_time_is_last_row(spark, evs):
    df = _frame(spark, evs)
    got = state_at(df, "k", "ts", "s", F.lit(True), tiebreak=["id"])
    last = {}
    for i, (k, h, s) in sorted(enumerate(evs), key=lambda x: (x[1][1], x[0])):
        last[k] = s
    assert rows(got) == sorted(last.items(), key=repr)


@SETTINGS
@given(events, st.integers(1, 7))
def test_repartitioning_does_not_change_results(spark, evs, parts):
    df = _frame(spark, evs)
    shuffled = df.repartition(parts)
    for f in (lambda d: next_value(d, "k", ["ts", "id"], "s", "n"),
              lambda d: dense_ids(d, ["k", "ts", "id"], "rid"),
              lambda d: dense_rank_column(d, ["k"], "ts", "r")):
        assert rows(f(df)) == rows(f(shuffled))
