"""Operator properties: each skew-safe rewrite equals the plain window form
it replaces, on data where one key holds a third of the rows."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from casework.functions import bag_edit, null_tokens, tokens
from casework.operators import (
    dense_ids, dense_rank_column, filtered_lists, next_value, nth_per, share_of_total, state_at,
    top_with_ties, with_group_stats, with_scalars,
)


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    data = []
    for i in range(900):
        key = 0 if i % 3 == 0 else rnd.randrange(1, 40)          # key 0 holds a third
        ts = base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 20))
        data.append((i, key, ts, rnd.choice("abcde"), rnd.randrange(0, 5)))
    return spark.createDataFrame(
        data, "id long, k long, ts timestamp_ntz, state string, v int")


def test_dense_ids_equal_global_row_number(skewed):
    got = dense_ids(skewed, ["v", "k", "id"], "rid")
    want = skewed.withColumn("rid", F.row_number().over(Window.orderBy("v", "k", "id")))
    assert rows(got, "id", "rid") == rows(want, "id", "rid")
    assert sorted(r.rid for r in got.collect()) == list(range(1, 901))


def test_next_value_equals_lead(skewed):
    got = next_value(skewed, "k", ["ts", "id"], "state", "nxt")
    want = skewed.withColumn("nxt", F.lead("state").over(Window.partitionBy("k").orderBy("ts", "id")))
    assert rows(got, "id", "nxt") == rows(want, "id", "nxt")


def test_nth_per_equals_dense_rank(skewed):
    d = skewed.withColumn("day", F.to_date("ts"))
    for n in (1, 2, 3):
        got = nth_per(d, "k", "day", n)
        want = d.withColumn("r", F.dense_rank().over(Window.partitionBy("k").orderBy("day"))) \
            .where(F.col("r") == n)
        assert rows(got, "id") == rows(want, "id")


def test_top_with_ties_equals_rank(skewed):
    counts = skewed.groupBy("k", "state").agg(F.count(F.lit(1)).alias("n"))
    got = top_with_ties(counts, "n", by="k")
    want = counts.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy(F.desc("n")))) \
        .where("r = 1")
    assert rows(got, "k", "state", "n") == rows(want, "k", "state", "n")
    g = top_with_ties(counts, "n")
    w = counts.withColumn("r", F.rank().over(Window.orderBy(F.desc("n")))).where("r = 1")
    assert rows(g, "k", "state") == rows(w, "k", "state")


def test_dense_rank_column_with_condition(skewed):
    d = skewed.withColumn("day", F.to_date("ts"))
    got = dense_rank_column(d, ["k"], "day", "r", where=F.col("v") > 1)
    win = F.dense_rank().over(Window.partitionBy("k", F.col("v") > 1).orderBy("day"))
    want = d.withColumn("r", F.when(F.col("v") > 1, win))
    assert rows(got, "id", "r") == rows(want, "id", "r")


def test_state_at_equals_last_row_without_successor(skewed):
    bound = F.col("ts") < F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    got = state_at(skewed, "k", "ts", "state", bound, tiebreak=["id"])
    f = skewed.where(bound).withColumn(
        "nx", F.lead("id").over(Window.partitionBy("k").orderBy("ts", "id")))
    want = f.where(F.col("nx").isNull()).select("k", "state")
    assert rows(got) == rows(want)


def test_group_stats_equal_window(skewed):
    got = with_group_stats(skewed, ["k"], {"a": F.avg("v"), "c": F.count("v")})
    w = Window.partitionBy("k")
    want = skewed.withColumn("a", F.avg("v").over(w)).withColumn("c", F.count("v").over(w))
    assert rows(got, "id", "a", "c") == rows(want, "id", "a", "c")


def test_share_sums_to_100(skewed):
    counts = skewed.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
    total = sum(r.percentage for r in share_of_total(counts, "n").collect())
    assert abs(total - 100) < 0.05


def test_filtered_lists_match_python(spark):
    data = [(1, "b", True), (1, "a", True), (1, "b", True), (1, "c", False), (2, "x", False),
            (3, None, True)]
    df = spark.createDataFrame(data, "g int, item string, f boolean")
    got = {r.g: (r.yes, r.no) for r in filtered_lists(
        df, ["g"], "item", {"yes": F.col("f"), "no": ~F.col("f")}).collect()}
    assert got == {1: ("a, b, b", "c"), 2: (None, "x")}


def test_cleaning_and_bags(spark):
    df = spark.createDataFrame([("null",), ("",), (None,), ("1, 5",), ("NaN",)], "s string")
    once = df.select(null_tokens("s", ("null", "", "NaN")).alias("s"))
    twice = once.select(null_tokens("s", ("null", "", "NaN")).alias("s"))
    assert rows(once) == rows(twice) == sorted([(None,)] * 4 + [("1, 5",)], key=repr)
    t = spark.createDataFrame([("",), (None,), (" 2 ,3",)], "s string").select(
        tokens("s", ",", "int").alias("t"))
    assert sorted(map(repr, (r.t for r in t.collect()))) == sorted(map(repr, [[], None, [2, 3]]))
    b = spark.createDataFrame([([1, 2, 2, 3], [2], [1, 1])], "b array<int>, r array<int>, a array<int>")
    got = b.select(bag_edit(F.col("b"), F.col("r"), F.col("a"), "int").alias("x")).first().x
    # set difference de-duplicates the base and removes every copy; extras are appended as a bag
    assert got == [1, 3, 1, 1]
    n = b.select(bag_edit(F.col("b"), F.lit(None).cast("array<int>"), None, "int").alias("x")).first().x
    assert n == [1, 2, 3]


def test_first_row_next_equals_lead_on_first_rows(skewed):
    from casework.operators import first_row_next
    got = first_row_next(skewed, "k", ["ts", "id"], "state", "nxt")
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = (skewed.withColumn("rn", F.row_number().over(w))
            .withColumn("nxt", F.lead("state").over(w)).where("rn = 1")
            .select("k", F.col("state").alias("current"), "nxt"))
    assert rows(got) == rows(want)


def test_sort_like_sql_null_placement(spark):
    from casework.operators import sort_like_sql
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    assert [r.x for r in sort_like_sql(df, "x").collect()] == [1, 3, None]
    assert [r.x for r in sort_like_sql(df, ("x", "desc")).collect()] == [None, 3, 1]


def test_dense_ids_with_null_leading_keys(spark):
    data = [(None, 5), (3, 1), (None, 2), (1, 7), (2, 2), (3, 0)]
    df = spark.createDataFrame(data, "a int, b int")
    got = dense_ids(df, ["a", "b"], "rid")
    want = df.withColumn("rid", F.row_number().over(Window.orderBy("a", "b")))
    assert rows(got, "a", "b", "rid") == rows(want, "a", "b", "rid")


def test_next_value_first_flag(skewed):
    got = next_value(skewed, "k", ["ts", "id"], "state", "nxt", first_flag="first")
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = skewed.withColumn("first", F.row_number().over(w) == 1)
    assert rows(got, "id", "first") == rows(want, "id", "first")


def test_filtered_lists_counted_equals_row_form(spark):
    data = [(1, 10, "b", True), (1, 11, "b", False), (1, 12, "a", True), (1, 10, "b", True),
            (2, 13, "x", False)]
    df = spark.createDataFrame(data, "g int, key int, item string, f boolean")
    rowwise = filtered_lists(df, ["g"], "item", {"yes": F.col("f"), "no": ~F.col("f")})
    pre = df.groupBy("g", "key", "item").agg(F.count_if("f").alias("y"), F.count_if(~F.col("f")).alias("n"))
    counted = filtered_lists(pre, ["g"], "item", {"yes": F.col("y"), "no": F.col("n")}, counted=True)
    assert rows(rowwise) == rows(counted) == [(1, "a, b, b", "b"), (2, None, "x")]


def test_dense_ids_split_hot_leading_value(spark):
    # key 7 holds a third of the rows: its range is split by the second column
    data = [(7 if i % 3 == 0 else i, i % 50, i) for i in range(600)]
    df = spark.createDataFrame(data, "a long, b int, c long")
    got = dense_ids(df, ["a", "b", "c"], "rid")
    want = df.withColumn("rid", F.row_number().over(Window.orderBy("a", "b", "c")))
    assert rows(got, "c", "rid") == rows(want, "c", "rid")


def test_null_group_keys_behave_like_windows(spark):
    data = [(None, 1, "a"), (None, 2, "b"), (None, 2, "c"), (1, 5, "d"), (1, 3, "e"), (2, None, "f")]
    df = spark.createDataFrame(data, "k int, v int, s string")
    w = Window.partitionBy("k")
    got = top_with_ties(df, "v", by="k")
    want = df.withColumn("r", F.rank().over(w.orderBy(F.col("v").desc_nulls_first()))).where("r = 1")
    assert rows(got, "s") == rows(want, "s")
    got = dense_rank_column(df, ["k"], "v", "r")
    want = df.withColumn("r", F.dense_rank().over(w.orderBy("v")))
    assert rows(got, "s", "r") == rows(want, "s", "r")
    got = with_group_stats(df, ["k"], {"m": F.max("v")})
    assert rows(got, "s", "m") == rows(df.withColumn("m", F.max("v").over(w)), "s", "m")
    got = next_value(df.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")),
                     "k", ["ts", "s"], "s", "n")
    assert rows(got, "s", "n") == rows(df.withColumn("n", F.lead("s").over(w.orderBy("s"))), "s", "n")


def test_with_scalars_equals_cross_join_of_one_row(skewed):
    one = skewed.agg(F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"))
    got = with_scalars(skewed.select("id"), one)
    want = skewed.select("id").crossJoin(one)
    assert got.columns == ["id", "hi", "n"]
    assert rows(got) == rows(want)
    # an aggregate over no rows is still one row (NULL max, zero count)
    empty = skewed.where("v < 0")
    none = with_scalars(skewed.select("id").limit(2), empty.agg(F.max("v").alias("hi"),
                                                                F.count(F.lit(1)).alias("n")))
    assert [(r.hi, r.n) for r in none.collect()] == [(None, 0), (None, 0)]


def test_dense_ids_wide_int_span(spark):
    # max - min exceeds the int range: the range arithmetic must not overflow
    data = [(i, -2_000_000_000 + i * 400_000_000, i % 3) for i in range(11)]
    df = spark.createDataFrame(data, "id int, a int, b int")
    got = dense_ids(df, ["a", "b", "id"], "rid")
    want = df.withColumn("rid", F.row_number().over(Window.orderBy("a", "b", "id")))
    assert rows(got, "id", "rid") == rows(want, "id", "rid")


def test_dense_ids_special_doubles(spark):
    # NULL, infinities and NaN in both leading columns, with a hot NaN value
    rnd = random.Random(7)
    special = [None, float("nan"), float("inf"), float("-inf")]
    data = []
    for i in range(300):
        a = float("nan") if i % 3 == 0 else rnd.choice(special + [rnd.uniform(-5, 5)] * 6)
        b = rnd.choice(special + [float(rnd.randrange(0, 50))] * 6)
        data.append((i, a, b))
    df = spark.createDataFrame(data, "id int, a double, b double")
    got = dense_ids(df, ["a", "b", "id"], "rid")
    want = df.withColumn("rid", F.row_number().over(Window.orderBy("a", "b", "id")))
    assert rows(got, "id", "rid") == rows(want, "id", "rid")


def test_next_value_splits_hot_hour(spark):
    # key 0 has 400 rows in one hour; NULL times come last, as in PostgreSQL
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1, 10)
    data = [(i, 0 if i < 400 else rnd.randrange(1, 9),
             base + dt.timedelta(seconds=rnd.randrange(0, 3600) if i < 400 else rnd.randrange(0, 86400)),
             rnd.choice("abcd")) for i in range(700)]
    data.append((700, None, base, "z"))
    data.append((701, 3, None, "y"))
    df = spark.createDataFrame(data, "id long, k long, ts timestamp_ntz, s string")
    w = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_last(), "id")
    want = df.withColumn("n", F.lead("s").over(w)).withColumn(
        "first", F.row_number().over(w) == 1)
    got = next_value(df, "k", ["ts", "id"], "s", "n", first_flag="first")
    assert rows(got, "id", "n", "first") == rows(want, "id", "n", "first")
    d = df.withColumn("day", F.to_date("ts"))
    got = next_value(d, "k", ["day", "id"], "s", "n", ranges=3)
    want = d.withColumn("n", F.lead("s").over(Window.partitionBy("k").orderBy(F.col("day").asc_nulls_last(), "id")))
    assert rows(got, "id", "n") == rows(want, "id", "n")


def test_distinct_and_flagged_equals_two_distinct_counts(skewed):
    from casework.operators import distinct_and_flagged
    d = skewed.union(skewed.limit(3).withColumn("k", F.lit(None).cast("long")))
    cond = (F.col("state") == "a") & (F.col("v") > 1)
    got = distinct_and_flagged(d, "k", cond, "n", "m").collect()
    want = d.agg(F.countDistinct("k").alias("n"),
                 F.countDistinct(F.when(cond, F.col("k"))).alias("m")).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    none = distinct_and_flagged(d.where("v < 0"), "k", cond, "n", "m").collect()
    assert [tuple(r) for r in none] == [(0, 0)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_dense_ids_date_and_timestamp_columns(spark, zone):
    # a hot leading date split by a zone-less timestamp (including times in a
    # daylight-saving gap), and a timestamp leading column
    rnd = random.Random(5)
    base = dt.datetime(2024, 3, 10, 0, 0)
    data = []
    for i in range(400):
        day = dt.date(2024, 3, 10) if i % 2 == 0 else dt.date(2024, 1, 1) + dt.timedelta(rnd.randrange(0, 200))
        t = base + dt.timedelta(minutes=rnd.randrange(0, 240), microseconds=rnd.randrange(0, 10**6))
        data.append((i, day, t, None if i % 37 == 0 else t))
    df = spark.createDataFrame(data, "id int, d date, t timestamp_ntz, z timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for order in (["d", "t", "id"], ["z", "id"]):
            src = df if order[0] != "z" else df.withColumn("z", F.col("z").cast("timestamp"))
            got = dense_ids(src, order, "rid")
            want = src.withColumn("rid", F.row_number().over(Window.orderBy(*order)))
            assert rows(got, "id", "rid") == rows(want, "id", "rid")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_dense_ids_by_text_and_with_an_outlier(spark):
    # the ranges are of equal depth: neither the values' type nor an outlier matters
    df = spark.createDataFrame([(f"{i % 7}", i if i else 10**12) for i in range(500)], "s string, n long")
    got = dense_ids(df, ["n", "s"], "rid", ranges=5)
    want = df.withColumn("rid", F.row_number().over(Window.orderBy("n", "s")))
    assert rows(got, "n", "rid") == rows(want, "n", "rid")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # the offsets' window stands on a count per range, not on rows or values
    window = plan[plan.index("Window"):]
    assert "Aggregate [__p" in window.split("Relation")[0]


@pytest.mark.parametrize("largest", [True, False])
def test_global_top_with_ties_ranks_null_like_the_grouped_form(spark, largest):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 5), (4, 2)], "id int, v int")
    for part in (df, df.where("v IS NOT NULL"), df.where("v IS NULL"), df.where("false")):
        grouped = top_with_ties(part.withColumn("g", F.lit(1)), "v", by="g", largest=largest)
        assert rows(top_with_ties(part, "v", largest=largest), "id") == rows(grouped, "id")
    assert rows(top_with_ties(df, "v"), "id") == [(1,)]
    assert rows(top_with_ties(df, "v", largest=False), "id") == [(4,)]


def test_global_top_with_ties_has_no_window(skewed):
    counts = skewed.groupBy("k", "state").agg(F.count(F.lit(1)).alias("n"))
    plan = top_with_ties(counts, "n")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Subquery" in plan


def test_anchor_joins_match_no_null_key(spark):
    from casework.operators import first_after_anchor, member_flag, milestone_after_anchor
    day = dt.date(2024, 1, 1)
    events = spark.createDataFrame([(1, None, day), (2, 7, day)], "id int, k int, t date")
    anchors = spark.createDataFrame([(None, day), (7, day)], "k int, anchor date")
    assert rows(first_after_anchor(events, anchors, "k", "t"), "id") == [(2,)]
    assert rows(member_flag(events, anchors, "k", "t"), "id", "member") == [(1, "N"), (2, "Y")]
    later = events.withColumn("t", F.date_add("t", 3))
    assert rows(milestone_after_anchor(anchors, later, "k", "anchor", "t"), "k") == [(7,)]


def test_shares_keep_decimals_and_refuse_rounded_doubles(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(Decimal("0.4"),), (Decimal("1.4"),)], "n decimal(10,1)")
    assert rows(share_of_total(df, "n", scale=2), "percentage") == [(22.22,), (77.78,)]
    assert rows(share_of_total(spark.createDataFrame([(9,), (4,)], "n long"), "n"), "percentage") == [(100 * 4 / 13,), (100 * 9 / 13,)]
    with pytest.raises(TypeError):
        share_of_total(df.withColumn("n", F.col("n").cast("double")), "n", scale=2)


def test_correlation_of_a_constant_is_inconclusive(spark):
    from casework.operators import correlation_summary
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 9.0)], "x double, y double")
    assert rows(correlation_summary(df, "x", "y")) == [(None, "Relationship inconclusive")]
    assert rows(correlation_summary(df.where("false"), "x", "y")) == [(None, "Relationship inconclusive")]
