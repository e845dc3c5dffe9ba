"""Column helpers: calendar parts, elapsed time, text and cleaning edge cases."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from casework.functions import (
    concat_skip_nulls, date_after, day_bucket_label, elapsed_minutes, in_year, minute_field,
    month_start, optional_fragment, parse_measure, percent_text, week_from_jan1, weekday_name,
)


def _one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("x")).first().x


def test_week_from_jan1(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, d),) for d in (1, 7, 8, 15)]
                               + [(dt.date(2020, 12, 31),)], "d date")
    got = [r.w for r in df.select(week_from_jan1("d").alias("w")).collect()]
    assert got == ["01", "01", "02", "03", "53"]          # 2020 is a leap year: day 366


def test_weekday_and_month_start(spark):
    r = spark.createDataFrame([(dt.datetime(2020, 1, 1, 18, 5),)], "t timestamp_ntz") \
        .select(weekday_name("t").alias("w"), month_start("t").alias("m")).first()
    assert (r.w, r.m) == ("wednesday", dt.date(2020, 1, 1))


def test_minute_field_wraps_and_keeps_sign(spark):
    schema = "a timestamp_ntz, b timestamp_ntz"
    a = dt.datetime(2020, 1, 2, 23, 51, 23)
    assert _one(spark, minute_field("a", "b"), schema, (a, dt.datetime(2020, 1, 3, 0, 12, 37))) == 21
    assert _one(spark, minute_field("a", "b"), schema, (a, a + dt.timedelta(hours=1, minutes=10))) == 10
    assert _one(spark, minute_field("a", "b"), schema, (a, a - dt.timedelta(minutes=10))) == -10


def test_elapsed_minutes_round_half_up(spark):
    schema = "a timestamp_ntz, b timestamp_ntz"
    a = dt.datetime(2020, 1, 1)
    for secs, want in ((30, "0.50"), (20, "0.33"), (1, "0.02"), (0.3, "0.01"), (-30, "-0.50")):
        got = _one(spark, elapsed_minutes("a", "b"), schema, (a, a + dt.timedelta(seconds=secs)))
        assert got == Decimal(want), secs


def test_range_predicates_are_half_open(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 15, 23, 59),), (dt.datetime(2024, 1, 16),),
                                (dt.datetime(1997, 12, 31, 23, 59),), (dt.datetime(1998, 1, 1),)],
                               "t timestamp_ntz")
    assert df.where(date_after("t", "2024-01-15")).count() == 1
    assert df.where(in_year("t", 1997)).count() == 1


def test_day_buckets(spark):
    df = spark.createDataFrame([(d,) for d in (0, 1, 30, 31, 60, 61, 104)], "d int")
    got = [r.p for r in df.select(day_bucket_label("d").alias("p")).collect()]
    assert got == ["0-30", "0-30", "0-30", "31-60", "31-60", "61-90", "91-120"]


def test_text_helpers(spark):
    df = spark.createDataFrame([("a", None, 7)], "s string, n string, k int")
    r = df.select(optional_fragment(" - x ", "s").alias("o1"), optional_fragment(" - x ", "n").alias("o2"),
                  concat_skip_nulls("k", F.lit("x"), "n", "s").alias("c")).first()
    assert (r.o1, r.o2, r.c) == (" - x a", "", "7xa")
    p = spark.createDataFrame([(307, 1000), (92, 1000), (1, 8)], "a long, b long")
    got = [r.t for r in p.select(percent_text("a", "b", 1).alias("t")).collect()]
    assert got == ["30.7%", "9.2%", "12.5%"]
    assert [r.t for r in p.select(percent_text("a", "b", 0).alias("t")).collect()] == ["31%", "9%", "13%"]


def test_parse_measure_spellings(spark):
    vals = ["20km", "23.4 km", "23.4", "32 minutes", "20 mins", "25mins", "15 minute", "10minutes",
            "null", "", None, "km"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r.x for r in df.select(parse_measure("s").alias("x")).collect()]
    assert got == [Decimal(x) if x else None for x in
                   ["20", "23.4", "23.4", "32", "20", "25", "15", "10", None, None, None, None]]


def test_parse_measure_keeps_its_digits(spark):
    from casework.functions import unreadable_measure
    vals = ["23.456 km", "123456789.5 km", "1.2.3", "null", None, "km", "0.1234567890123456789", "7 km"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = df.select(parse_measure("s").alias("x"), unreadable_measure("s").alias("bad")).collect()
    assert [r.x for r in got[:6]] == [Decimal("23.456"), Decimal("123456789.5"), None, None, None, None]
    assert [r.bad for r in got] == [False, False, True, False, False, True, True, False]


def test_pay_rounds_only_the_product(spark):
    from casework.operators import pay_per_unit
    df = spark.createDataFrame([(Decimal("12.345"),)], "m decimal(10,3)")
    r = df.select(pay_per_unit(F.col("m"), "0.3").alias("a"), pay_per_unit(F.col("m"), "0.00015", 6).alias("b")).first()
    assert (r.a, r.b) == (Decimal("3.70"), Decimal("0.001852"))


def test_tokens_take_the_separator_literally(spark):
    from casework.functions import tokens
    df = spark.createDataFrame([("a|b|c", "a.b", "", " ", None)], "p string, d string, e string, b string, n string")
    r = df.select(tokens("p", "|").alias("p"), tokens("d", ".").alias("d"), tokens("e").alias("e"),
                  tokens("b").alias("b"), tokens("n").alias("n")).first()
    assert (r.p, r.d, r.e, r.b, r.n) == (["a", "b", "c"], ["a", "b"], [], [""], None)


def test_distinct_count_exact_and_approx(spark):
    from casework.functions import distinct_count
    df = spark.range(0, 5000).select((F.col("id") % 1000).alias("v"))
    r = df.agg(distinct_count("v").alias("e"), distinct_count("v", approx=True, rsd=0.02).alias("a")).first()
    assert r.e == 1000 and abs(r.a - 1000) <= 60
