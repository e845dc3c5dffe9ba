"""Registered jobs on the driver tables.

The driver's tables (TPC-H-like star plus an ``events`` log) stand in for
the case-study tables:

* sales lines  -> ``lineitem`` joined to ``orders`` (customer, order date)
                  and ``part`` (product name and price);
* membership   -> each user's first ``signup`` event in ``events``;
* deliveries   -> lines not returned (``l_returnflag <> 'R'``);
* subscriptions-> ``events`` (user, type as plan, time) and ``orders``.

Each job takes ``(spark, sf_dir)`` and returns a lazy DataFrame. Every job
reads whole tables; filters are business predicates, written so Catalyst can
push them into the Parquet scan.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.functions import (
    date_after, date_at_most, day_bucket_label, days_between, distinct_count, elapsed_micros,
    elapsed_minutes, exact_ratio, hour_of_day, in_year, minute_field, month_start,
    null_tokens, optional_fragment, parse_measure, percent_text, quotient, tokens,
    week_from_jan1, weekday_name,
)
from casework.functions.arrays import bag_edit
from casework.operators import (
    cond_counts, contract_summary, correlation_summary, counted_list, dense_ids,
    dense_rank_column, distinct_and_flagged, filtered_lists, first_after_anchor,
    counts_over_time, first_event_anchor, first_per, first_row_next, last_anchor,
    next_value, parse_with_rejects,
    join_on, last_before_anchor, member_flag, milestone_after_anchor,
    nth_per, ordered_list, pay_per_unit, points, price_by, relative_to_anchor,
    rank_columns, share_of_total, sort_like_sql, state_at, success_rate, tagged_explode_outer,
    top_with_ties,
    totals_relative, with_group_stats, with_scalars, within_days_after,
)
from casework.operators.contract import check, not_null, split_valid
from casework.session import checkpoint_dir
from casework.sources import Tables, append_once, load_table, on_dates, read_committed, write_by_date
from casework.sources.sinks import append


def _money(c: str):
    # a double's own digits: sums are exact and do not depend on their order
    return F.col(c).cast("decimal(30,12)")


def _exact_avg(c, scale: int = 2):
    """``round(avg(c), scale)`` on decimals, exact (sum / count, wide scale)."""
    return F.round(F.sum(c) / F.count(c).cast("decimal(20,0)"), scale)


def _sales(t: Tables) -> DataFrame:
    """Sales lines: (customer_id, order_date, product_id, l_orderkey)."""
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"),
                             F.col("o_custkey").alias("customer_id"),
                             F.to_date("o_orderdate").alias("order_date"))
    return t.lineitem.select("l_orderkey", F.col("l_partkey").alias("product_id")) \
        .join(orders, "l_orderkey")


def _menu(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("product_id"),
                         F.col("p_name").alias("product_name"),
                         F.col("p_retailprice").alias("price"))


def _members(t: Tables) -> DataFrame:
    """One anchor per user: the date of the first sign-up (``join_date``)."""
    return first_event_anchor(t.events, "user_id", "ts",
                              where=F.col("event_type") == "signup", name="join_date")


def _visits(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id", "event_type", "value",
                           F.to_date("ts").alias("visit_date"))


def _delivered(t: Tables) -> DataFrame:
    return t.lineitem.where(F.col("l_returnflag") != "R")


# ---------------------------------------------------------------- case 1 shapes

def spend_per_customer(spark: SparkSession, d: str) -> DataFrame:
    """Total spent per customer: sum of product prices over their sales lines.

    Lines are priced and summed per order first (shuffle on part key, then a
    partial aggregate to one row per order), so the join with ``orders`` sees
    one row per order instead of one per line.
    """
    t = Tables(spark, d)
    priced = t.lineitem.select("l_orderkey", "l_partkey").join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), _money("p_retailprice").alias("price")),
        "l_partkey")
    per_order = priced.groupBy("l_orderkey").agg(F.sum("price").alias("order_total"))
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return (per_order.join(orders, "l_orderkey")
            .groupBy(F.col("o_custkey").alias("customer"))
            .agg(F.sum("order_total").cast("double").alias("total")))


def visit_days(spark: SparkSession, d: str, approx: bool = False) -> DataFrame:
    """Distinct visit days per user (``approx=True``: HyperLogLog++ estimate)."""
    t = Tables(spark, d)
    return t.events.groupBy("user_id").agg(
        distinct_count(F.to_date("ts"), approx).alias("n_visited"))


def first_day_items(spark: SparkSession, d: str) -> DataFrame:
    """Items bought on each customer's first purchase day (ties and repeats kept)."""
    t = Tables(spark, d)
    first_day = first_per(_sales(t), "customer_id", "order_date")
    return first_day.join(_menu(t), "product_id").select(
        "customer_id", "product_id", "product_name")


def top_item_overall(spark: SparkSession, d: str) -> DataFrame:
    """Most purchased product(s) over all lines, with their purchase count."""
    t = Tables(spark, d)
    counts = t.lineitem.groupBy(F.col("l_partkey").alias("product_id")).agg(
        F.count(F.lit(1)).alias("n_purchase"))
    top = top_with_ties(counts, "n_purchase")
    return top.join(_menu(t), "product_id").select("product_id", "product_name", "n_purchase")


def top_item_per_customer(spark: SparkSession, d: str) -> DataFrame:
    """Each user's most frequent event type(s), ties kept."""
    t = Tables(spark, d)
    counts = t.events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n_events"))
    return top_with_ties(counts, "n_events", by="user_id")


def first_after_anchor_q(spark: SparkSession, d: str) -> DataFrame:
    """Purchases on each member's first purchase day on/after joining."""
    t = Tables(spark, d)
    purchases = _visits(t).where(F.col("event_type") == "purchase")
    out = first_after_anchor(purchases, _members(t), "user_id", "visit_date", "join_date")
    return out.select("user_id", "event_id", "visit_date")


def last_before_anchor_q(spark: SparkSession, d: str) -> DataFrame:
    """Purchases on each member's last purchase day before joining."""
    t = Tables(spark, d)
    purchases = _visits(t).where(F.col("event_type") == "purchase")
    out = last_before_anchor(purchases, _members(t), "user_id", "visit_date", "join_date")
    return out.select("user_id", "event_id", "visit_date")


def totals_before_anchor(spark: SparkSession, d: str) -> DataFrame:
    """Number of purchases and amount spent by each member before joining."""
    t = Tables(spark, d)
    purchases = _visits(t).where(F.col("event_type") == "purchase")
    out = totals_relative(purchases, _members(t), "user_id", "visit_date", _money("value"),
                          "join_date", "before")
    return out.withColumn("total_amount", F.col("total_amount").cast("double"))


def points_rules(spark: SparkSession, d: str) -> DataFrame:
    """10 points per unit spent, purchases earn double; per user."""
    t = Tables(spark, d)
    e = t.events
    pts = points(_money("value"), 10, [(F.col("event_type") == "purchase", 2)])
    out = e.groupBy("user_id").agg(F.sum(_money("value")).cast("double").alias("total_spent"),
                                   F.sum(pts).cast("double").alias("points_earned"))
    return sort_like_sql(out, ("points_earned", "desc"))


def points_bonus_window(spark: SparkSession, d: str) -> DataFrame:
    """Members' points of 1 to 20 January: double within 0..7 days of joining,
    else 10/unit."""
    t = Tables(spark, d)
    e = relative_to_anchor(_visits(t), _members(t), "user_id", "visit_date", "join_date", "any")
    bonus = within_days_after(F.col("visit_date"), F.col("join_date"), 7)
    pts = points(_money("value"), 10, [(bonus, 2)])
    out = (e.where(F.col("visit_date").between(F.lit("2024-01-01").cast("date"), F.lit("2024-01-20").cast("date")))
           .groupBy("user_id").agg(F.sum(pts).cast("double").alias("points_earned")))
    return sort_like_sql(out, ("points_earned", "desc"))


def member_flag_q(spark: SparkSession, d: str) -> DataFrame:
    """Every event with member flag Y (on/after the user's join date) or N."""
    t = Tables(spark, d)
    out = member_flag(_visits(t), _members(t), "user_id", "visit_date", "join_date")
    out = out.select("user_id", "event_id", "visit_date", "event_type", "value", "member")
    return sort_like_sql(out, "user_id", "visit_date", ("value", "desc"))


def member_rank(spark: SparkSession, d: str) -> DataFrame:
    """As ``member_flag`` plus a dense rank of visit dates over member rows only."""
    t = Tables(spark, d)
    flagged = member_flag(_visits(t), _members(t), "user_id", "visit_date", "join_date")
    ranked = dense_rank_column(flagged, ["user_id"], "visit_date", "ranking",
                               where=F.col("member") == "Y")
    out = ranked.select("user_id", "event_id", "visit_date", "event_type", "value", "member",
                        F.col("ranking").cast("bigint").alias("ranking"))
    return sort_like_sql(out, "user_id", "visit_date", ("value", "desc"))


# ---------------------------------------------------------------- case 2 shapes

def null_tokens_q(spark: SparkSession, d: str) -> DataFrame:
    """Priority spelled '4-NOT SPECIFIED' or '' counts as missing; known per status."""
    t = Tables(spark, d)
    clean = t.orders.select("o_orderstatus",
                            null_tokens("o_orderpriority", ("4-NOT SPECIFIED", "")).alias("prio"))
    return clean.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"),
                                              F.count("prio").alias("n_priority_known"))


def parse_measure_q(spark: SparkSession, d: str) -> DataFrame:
    """Number inside unit-suffixed text: ``Brand#19`` -> 19.0 per part."""
    t = Tables(spark, d)
    return t.part.select("p_partkey",
                         parse_measure("p_brand").cast("double").alias("brand_number"))


def parse_props(spark: SparkSession, d: str) -> DataFrame:
    """Number inside ``{"k": 69}`` property text, per event."""
    t = Tables(spark, d)
    return t.events.select("event_id", parse_measure("props").cast("double").alias("k"))


LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
              "l_shipdate"]


def line_id(spark: SparkSession, d: str) -> DataFrame:
    """Dense line ids 1..n over the total order of all line columns."""
    t = Tables(spark, d)
    ided = dense_ids(t.lineitem, LINE_ORDER, "line_id")
    return ided.select("line_id", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       "l_quantity")


def tagged_changes(spark: SparkSession, d: str) -> DataFrame:
    """One row per word of each part's name (tag 'name') and type (tag 'type');
    a part of size 1 counts as unchanged and keeps one row without a word."""
    t = Tables(spark, d)
    changed = lambda c: F.when(F.col("p_size") > 1, F.col(c))
    return tagged_explode_outer(
        t.part, {"name": tokens(changed("p_name"), " "), "type": tokens(changed("p_type"), " ")},
        keep=["p_partkey"], tag_name="mod_type", value_name="token")


def top_change_token(spark: SparkSession, d: str) -> DataFrame:
    """Most frequent name word(s) across parts, ties kept."""
    changes = tagged_changes(spark, d)
    counts = (changes.where((F.col("mod_type") == "name") & F.col("token").isNotNull())
              .groupBy("token").agg(F.count(F.lit(1)).alias("n_usage")))
    return top_with_ties(counts, "n_usage")


def bag_edit_counts(spark: SparkSession, d: str) -> DataFrame:
    """Ingredient use over delivered lines: name words minus {red, blue}, plus type.

    Lines are counted per part first; the bag edit runs once per part and
    each ingredient is weighted by its part's line count.
    """
    t = Tables(spark, d)
    per_part = _delivered(t).groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count(F.lit(1)).alias("n_lines"))
    bag = bag_edit(tokens("p_name", " "), F.array(F.lit("red"), F.lit("blue")),
                   F.array(F.col("p_type")))
    items = (per_part.join(t.part.select("p_partkey", "p_name", "p_type"), "p_partkey")
             .select("n_lines", F.explode(bag).alias("ingredient")))
    out = items.groupBy("ingredient").agg(F.sum("n_lines").alias("total_quantity_used"))
    return sort_like_sql(out, ("total_quantity_used", "desc"))


def counted_list_q(spark: SparkSession, d: str) -> DataFrame:
    """Per order: ``status: 2xECONOMY, PROMO`` from the part types of its lines."""
    t = Tables(spark, d)
    lines = t.lineitem.select("l_orderkey", F.col("l_partkey").alias("p_partkey")) \
        .join(t.part.select("p_partkey", "p_type"), "p_partkey")
    lists = counted_list(lines, ["l_orderkey"], "p_type", "items")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    return lists.join(orders, "l_orderkey").select(
        "l_orderkey", F.concat("o_orderstatus", F.lit(": "), "items").alias("ingredient"))


def optional_label(spark: SparkSession, d: str) -> DataFrame:
    """Per order: ``status - Returned a, b - Open c`` (fragments only when present)."""
    t = Tables(spark, d)
    # a line is in a list once or not at all: one collect per order
    named = t.lineitem.select(
        "l_orderkey", F.col("l_partkey").alias("p_partkey"), (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        (F.col("l_linestatus") == "O").cast("int").alias("open")).join(t.part.select("p_partkey", "p_name"), "p_partkey")
    lists = filtered_lists(named, ["l_orderkey"], "p_name",
                           {"returned": F.coalesce("returned", F.lit(0)), "open": F.coalesce("open", F.lit(0))},
                           counted=True)
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    out = lists.join(orders, "l_orderkey").select(
        "l_orderkey",
        F.concat("o_orderstatus", optional_fragment(" - Returned ", "returned"),
                 optional_fragment(" - Open ", "open")).alias("order_item"))
    return sort_like_sql(out, "l_orderkey")


def standard_list(spark: SparkSession, d: str) -> DataFrame:
    """Per brand number (parsed from text), the sorted distinct part types."""
    t = Tables(spark, d)
    pairs = t.part.select(parse_measure("p_brand", dtype="bigint").alias("brand_no"),
                          "p_type").distinct()
    return ordered_list(pairs, ["brand_no"], "p_type", "types")


def cond_counts_q(spark: SparkSession, d: str) -> DataFrame:
    """Per user: number of purchases and of sign-ups (pivot-style counts)."""
    t = Tables(spark, d)
    return cond_counts(t.events, "user_id", {
        "n_purchase": F.col("event_type") == "purchase",
        "n_signup": F.col("event_type") == "signup"})


def unique_vs_all(spark: SparkSession, d: str) -> DataFrame:
    """Lines ordered and unique orders."""
    t = Tables(spark, d)
    return t.lineitem.agg(F.count(F.lit(1)).alias("n_lines"),
                          F.countDistinct("l_orderkey").alias("n_orders"))


def delivered_before_dim(spark: SparkSession, d: str) -> DataFrame:
    """Delivered lines per part, aggregated before the part-name join."""
    t = Tables(spark, d)
    counts = _delivered(t).groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count(F.lit(1)).alias("n_delivered"))
    out = counts.join(t.part.select("p_partkey", "p_name"), "p_partkey")
    return sort_like_sql(out, ("n_delivered", "desc"))


def largest_order(spark: SparkSession, d: str) -> DataFrame:
    """Order(s) with the most delivered lines (dense_rank 1, ties kept)."""
    t = Tables(spark, d)
    per_order = _delivered(t).groupBy("l_orderkey").agg(F.count("l_partkey").alias("n_lines"))
    return top_with_ties(per_order, "n_lines").withColumn("rnk", F.lit(1).cast("bigint"))


def both_changes(spark: SparkSession, d: str) -> DataFrame:
    """Delivered lines carrying both a discount and a tax."""
    t = Tables(spark, d)
    return _delivered(t).where((F.col("l_discount") > 0) & (F.col("l_tax") > 0)) \
        .agg(F.count("l_orderkey").alias("n_lines"))


def volume_by_hour(spark: SparkSession, d: str) -> DataFrame:
    """Events per hour of day."""
    t = Tables(spark, d)
    out = t.events.groupBy(hour_of_day("ts").alias("hour_of_day")).agg(
        F.count("event_id").alias("n_events"))
    return sort_like_sql(out, ("n_events", "desc"))


def volume_by_weekday(spark: SparkSession, d: str) -> DataFrame:
    """Events per weekday name."""
    t = Tables(spark, d)
    out = t.events.groupBy(weekday_name("ts").alias("day_of_week")).agg(
        F.count("event_id").alias("n_events"))
    return sort_like_sql(out, ("n_events", "desc"))


def signups_by_week(spark: SparkSession, d: str) -> DataFrame:
    """Sign-ups per 7-day period counted from 1 January (``'WW'`` weeks)."""
    t = Tables(spark, d)
    out = (t.events.where(F.col("event_type") == "signup")
           .groupBy(week_from_jan1("ts").alias("week_num"))
           .agg(F.count(F.lit(1)).alias("n_signups")))
    return sort_like_sql(out, ("n_signups", "desc"))


def _order_delays(t: Tables) -> DataFrame:
    """Per order: status, line count, first ship time and delay from order time."""
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("pickup"), F.count("l_partkey").alias("n_lines"))
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus",
                             "o_orderdate")
    return per_order.join(orders, "l_orderkey")


def pickup_delay(spark: SparkSession, d: str) -> DataFrame:
    """Average minutes from order to first shipment, per order status.

    Each order's delay is rounded to 2 decimals first (one value per order,
    however many lines it has), then averaged and rounded again.
    """
    t = Tables(spark, d)
    delays = _order_delays(t).select(
        "o_orderstatus", elapsed_minutes("o_orderdate", "pickup", 2).alias("delay_min"))
    out = delays.groupBy("o_orderstatus").agg(
        _exact_avg(F.col("delay_min"), 2).cast("double").alias("avg_pickup_min"))
    return sort_like_sql(out, "avg_pickup_min")


def size_vs_delay_label(spark: SparkSession, d: str) -> DataFrame:
    """Correlation of lines per order with the order's delay, and its label."""
    t = Tables(spark, d)
    per_order = _order_delays(t).select(
        "n_lines", (elapsed_micros("o_orderdate", "pickup") / 1_000_000).alias("delay_s"))
    return correlation_summary(per_order, "n_lines", "delay_s")


def distance_per_customer(spark: SparkSession, d: str) -> DataFrame:
    """Average order value per customer over filled orders that have lines.

    The distinct (order, customer) pairs of the lines are the orders that
    appear in ``lineitem``: a left-semi join, with no per-line rows kept.
    """
    t = Tables(spark, d)
    with_lines = t.orders.where(F.col("o_orderstatus") == "F").join(
        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
    return with_lines.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        _exact_avg(_money("o_totalprice"), 2).cast("double").alias("avg_value"))


def range_of_measure(spark: SparkSession, d: str) -> DataFrame:
    """Largest and smallest delivered line value and their difference."""
    t = Tables(spark, d)
    mm = _delivered(t).agg(F.max(_money("l_extendedprice")).alias("hi"),
                           F.min(_money("l_extendedprice")).alias("lo"))
    return mm.select(F.col("hi").cast("double").alias("longest"),
                     F.col("lo").cast("double").alias("shortest"),
                     (F.col("hi") - F.col("lo")).cast("double").alias("difference"))


def rate_with_avg(spark: SparkSession, d: str) -> DataFrame:
    """Unit price of each delivered line and the supplier's average unit price.

    ``avg(x) over (partition by supplier)`` as a per-supplier aggregate
    joined back to the lines.
    """
    t = Tables(spark, d)
    unit = quotient("l_extendedprice", "l_quantity")
    lines = _delivered(t).select("l_orderkey", "l_linenumber", "l_suppkey", unit.alias("unit"))
    out = with_group_stats(lines, ["l_suppkey"], {"__avg": F.avg("unit")})
    out = out.select("l_orderkey", "l_linenumber", "l_suppkey",
                     F.round("unit", 2).cast("double").alias("unit_price"),
                     F.round("__avg", 2).cast("double").alias("avg_unit_price"))
    return sort_like_sql(out, "l_suppkey", "l_orderkey")


def success_rate_q(spark: SparkSession, d: str) -> DataFrame:
    """Percent of lines not returned, per supplier."""
    t = Tables(spark, d)
    out = success_rate(t.lineitem, "l_suppkey", F.col("l_returnflag") != "R",
                       "success_percentage")
    return sort_like_sql(out, ("success_percentage", "desc"))


# Price per line status for the income jobs.
LINE_PRICES = {"F": 12, "O": 10}


def _income(t: Tables) -> DataFrame:
    lines = _delivered(t).join(t.orders.select(F.col("o_orderkey").alias("l_orderkey")),
                               "l_orderkey", "left_semi")
    return lines.agg(F.sum(price_by(F.col("l_linestatus"), LINE_PRICES, 0)).alias("revenue"))


def fixed_price_income(spark: SparkSession, d: str) -> DataFrame:
    """Income of delivered lines at a fixed price per line status."""
    t = Tables(spark, d)
    return _income(t).select(F.col("revenue").cast("bigint").alias("total_income_usd"))


def net_income(spark: SparkSession, d: str) -> DataFrame:
    """Income minus pay of 0.30 per unit shipped (pay rounded per line)."""
    t = Tables(spark, d)
    pay = _delivered(t).agg(F.sum(pay_per_unit(F.col("l_quantity"), "0.3")).alias("pay"))
    rev = _income(t)
    return with_scalars(rev, pay).select(
        F.col("revenue").cast("double").alias("revenue_usd"),
        F.col("pay").cast("double").alias("total_earning_usd"),
        (F.col("revenue") - F.col("pay")).cast("double").alias("net_income_usd"))


def wide_order(spark: SparkSession, d: str) -> DataFrame:
    """One row per user-day: first/last event, minute field of the span, count."""
    t = Tables(spark, d)
    days = t.events.groupBy("user_id", F.to_date("ts").alias("visit_date")).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.count("event_id").alias("n_events"))
    return days.select("user_id", "visit_date", "first_ts", "last_ts",
                       minute_field("first_ts", "last_ts").alias("span_minute_field"),
                       "n_events")


def rating_contract(spark: SparkSession, d: str) -> DataFrame:
    """Ratings (floor(value / 40) of purchases) checked against the row contract."""
    t = Tables(spark, d)
    ratings = t.events.where(F.col("event_type") == "purchase").select(
        "event_id", "user_id", F.floor(F.col("value") / 40).cast("bigint").alias("rating"))
    rules = not_null("event_id", "user_id", "rating") + [
        check("rating between 0 and 5", F.col("rating").between(0, 5))]
    return contract_summary(ratings, rules)


def rating_append(spark: SparkSession, d: str) -> DataFrame:
    """Valid ratings of purchases, then of views, appended to one table in the
    shared folder and read back: ratings per value."""
    t = Tables(spark, d)
    path = f"{checkpoint_dir(spark).rstrip('/')}/ratings-{uuid.uuid4().hex}"
    ratings = t.events.select("event_type", "event_id", "user_id", F.floor(F.col("value") / 40).cast("bigint").alias("rating"))
    rules = not_null("event_id", "user_id", "rating") + [
        check("rating between 0 and 5", F.col("rating").between(0, 5))]
    for kind in ("purchase", "view"):
        valid, _ = split_valid(ratings.where(F.col("event_type") == kind).drop("event_type"), rules)
        append(valid, path)
    return (spark.read.schema("event_id long, user_id long, rating long").parquet(path)
            .groupBy("rating").agg(F.count(F.lit(1)).alias("n_ratings")))


# ---------------------------------------------------------------- case 3 shapes

JOURNEY_FROM, JOURNEY_TO = "1996-01-01", "1996-01-31"


def journey(spark: SparkSession, d: str) -> DataFrame:
    """Orders with customer names placed between two dates (inclusive)."""
    t = Tables(spark, d)
    o = t.orders.where(F.col("o_orderdate").between(
        F.lit(f"{JOURNEY_FROM} 00:00:00").cast("timestamp_ntz"),
        F.lit(f"{JOURNEY_TO} 00:00:00").cast("timestamp_ntz")))
    out = o.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey") \
        .select("o_custkey", "c_name", "o_orderkey", "o_orderstatus", "o_orderdate")
    return sort_like_sql(out, "o_custkey", "o_orderdate")


def month_starts(spark: SparkSession, d: str) -> DataFrame:
    """Open orders per month (month start as a date)."""
    t = Tables(spark, d)
    out = (t.orders.where(F.col("o_orderstatus") == "O")
           .groupBy(month_start("o_orderdate").alias("month"))
           .agg(F.count("o_orderkey").alias("n_orders")))
    return sort_like_sql(out, "month")


EVENTS_BOUND = "2024-01-15"


def events_after(spark: SparkSession, d: str) -> DataFrame:
    """Events per type strictly after a date."""
    t = Tables(spark, d)
    out = (t.events.where(date_after("ts", EVENTS_BOUND))
           .groupBy("event_type").agg(F.count("event_id").alias("n_events")))
    return sort_like_sql(out, ("n_events", "desc"))


def churn_rate(spark: SparkSession, d: str) -> DataFrame:
    """All users, and the percent who had an error of value above 200."""
    t = Tables(spark, d)
    churned = (F.col("event_type") == "error") & (F.col("value") > 200)
    c = distinct_and_flagged(t.events, "user_id", churned, "n_customers", "n_churned")
    return c.select("n_customers", percent_text("n_churned", "n_customers", 1).alias("churn"))


def _total_users(t: Tables) -> DataFrame:
    return t.events.agg(F.countDistinct("user_id").alias("n_total_customers"))


def straight_after_first(spark: SparkSession, d: str) -> DataFrame:
    """Users whose second distinct event time is an error, count and percent."""
    t = Tables(spark, d)
    second = nth_per(t.events.select("user_id", "ts", "event_type"), "user_id", "ts", 2)
    n = second.agg(F.count_if(F.col("event_type") == "error").alias("churn_after_trial"))
    return with_scalars(_total_users(t), n).select(
        "n_total_customers", "churn_after_trial",
        percent_text("churn_after_trial", "n_total_customers", 0).alias("churn_percentage"))


def next_plan_rank(spark: SparkSession, d: str) -> DataFrame:
    """Type of each user's second event (dense rank 2) with share of all users."""
    t = Tables(spark, d)
    second = nth_per(t.events.select("user_id", "ts", "event_type"), "user_id", "ts", 2)
    counts = second.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_customer_after_first"))
    out = with_scalars(counts, _total_users(t)).select(
        "event_type", "n_customer_after_first",
        exact_ratio("n_customer_after_first", "n_total_customers", 1, 100)
        .cast("double").alias("percentage"))
    return sort_like_sql(out, ("percentage", "desc"))


def next_plan_lead(spark: SparkSession, d: str) -> DataFrame:
    """Next event type after each user's first event, counts and share (lead)."""
    t = Tables(spark, d)
    e = t.events.select("user_id", "ts", "event_id", "event_type")
    firsts = first_row_next(e, "user_id", ["ts", "event_id"], "event_type", "next_type")
    counts = (firsts.where(F.col("next_type").isNotNull())
              .groupBy(F.col("next_type").alias("event_type"))
              .agg(F.count(F.lit(1)).alias("conversion_count")))
    return sort_like_sql(share_of_total(counts, "conversion_count", "percentage"),
                         ("percentage", "desc"))


STATE_DATE = "2024-01-15"


def state_at_date(spark: SparkSession, d: str) -> DataFrame:
    """Each user's latest event type as of a date: users per type and share."""
    t = Tables(spark, d)
    st = state_at(t.events, "user_id", "ts", "event_type", date_at_most("ts", STATE_DATE),
                  tiebreak=["event_id"])
    counts = st.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_customers"))
    return share_of_total(counts, "n_customers", "percentage")


def upgrades_in_year(spark: SparkSession, d: str) -> DataFrame:
    """Customers with a filled order in 1997."""
    t = Tables(spark, d)
    return (t.orders.where(in_year("o_orderdate", 1997) & (F.col("o_orderstatus") == "F"))
            .agg(F.countDistinct("o_custkey").alias("n_customers")))


def _anchor_orders(t: Tables) -> DataFrame:
    """Each customer's first order (earliest date, then lowest key)."""
    o = t.orders.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("odate"),
                        "o_orderstatus")
    first = o.groupBy("o_custkey").agg(F.min(F.struct("odate", "o_orderkey")).alias("__f"))
    return first.select("o_custkey", F.col("__f.odate").alias("anchor_date"),
                        F.col("__f.o_orderkey").alias("anchor_key"))


def _milestone_days(t: Tables) -> DataFrame:
    """Days from each customer's first order to its first later filled order."""
    anchors = _anchor_orders(t)
    filled = t.orders.where(F.col("o_orderstatus") == "F").select(
        "o_custkey", F.to_date("o_orderdate").alias("odate"))
    m = milestone_after_anchor(anchors, filled, "o_custkey", "anchor_date", "odate", "milestone")
    return m.select("o_custkey", days_between("anchor_date", "milestone").alias("days"))


def days_to_milestone_join(spark: SparkSession, d: str) -> DataFrame:
    """Average days from first order to first later filled order (join form)."""
    t = Tables(spark, d)
    return _milestone_days(t).agg(
        _exact_avg(F.col("days").cast("decimal(18,0)"), 2).cast("double").alias("avg_days"))


def days_to_milestone_lead(spark: SparkSession, d: str) -> DataFrame:
    """Same average through ``lead``: keep anchors and later filled orders, then
    read the next date after each anchor row."""
    t = Tables(spark, d)
    anchors = _anchor_orders(t)
    o = t.orders.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("odate"),
                        "o_orderstatus")
    tagged = join_on(o, anchors, ["o_custkey"])
    kept = tagged.where((F.col("o_orderkey") == F.col("anchor_key"))
                        | ((F.col("o_orderstatus") == "F") & (F.col("odate") > F.col("anchor_date"))))
    # the anchor is each customer's first kept row, so only two rows matter
    firsts = first_row_next(kept, "o_custkey", ["odate", "o_orderkey"], "odate", "next_date")
    days = (firsts.where(F.col("next_date").isNotNull())
            .select(F.datediff("next_date", "current").alias("days")))
    return days.agg(_exact_avg(F.col("days").cast("decimal(18,0)"), 2).cast("double")
                    .alias("avg_days"))


def days_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Customers per 30-day period of days to the milestone (0-30, 31-60, ...)."""
    t = Tables(spark, d)
    return (_milestone_days(t).groupBy(day_bucket_label("days", 30).alias("period"))
            .agg(F.count(F.lit(1)).alias("n_customers")))


# ---------------------------------------------------------------- whole-log shapes

def _item_counts(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_partkey").alias("product_id")).agg(F.count(F.lit(1)).alias("n_purchase"))


def global_rank(spark: SparkSession, d: str) -> DataFrame:
    """Rank and dense rank of every product by its number of purchases."""
    t = Tables(spark, d)
    return rank_columns(_item_counts(t), "n_purchase", rank="rnk", dense="dense_rnk", descending=True)


def rank_per_user(spark: SparkSession, d: str) -> DataFrame:
    """Rank and dense rank of every visit day of each user by its events."""
    t = Tables(spark, d)
    days = t.events.groupBy("user_id", F.to_date("ts").alias("visit_date")).agg(F.count(F.lit(1)).alias("n_events"))
    return rank_columns(days, "n_events", "user_id", rank="rnk", dense="dense_rnk", descending=True)


def next_event(spark: SparkSession, d: str) -> DataFrame:
    """Every event with the type of the user's next event."""
    t = Tables(spark, d)
    e = t.events.select("event_id", "user_id", "ts", "event_type")
    return next_value(e, "user_id", ["ts", "event_id"], "event_type", "next_type")


def last_anchor_per_event(spark: SparkSession, d: str) -> DataFrame:
    """Every purchase with the user's last sign-up at or before it (users sign
    up many times)."""
    t = Tables(spark, d)
    buys = t.events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    joins = t.events.where(F.col("event_type") == "signup").select("user_id", F.col("ts").alias("joined"))
    return last_anchor(buys, joins, "user_id", "ts", "joined")


def state_by_day(spark: SparkSession, d: str) -> DataFrame:
    """Users per latest event type at the end of each day of January 2024."""
    t = Tables(spark, d)
    days = [dt.date(2024, 1, k) for k in range(1, 32)]
    return counts_over_time(t.events, "user_id", "ts", "event_type", days, tiebreak=["event_id"], name="n_users")


def parse_measure_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Texts of parts read as measures: readable ones, and unreadable ones by reason."""
    t = Tables(spark, d)
    texts = t.part.select("p_partkey", "p_brand", "p_type", F.concat_ws(".", F.col("p_size").cast("string"), F.col("p_retailprice").cast("string")).alias("code"))
    parsed, rejected = parse_with_rejects(texts, {"brand_number": "p_brand", "type_number": "p_type", "code_number": "code"})
    good = parsed.select(F.lit("read").alias("outcome"), F.explode(F.array("brand_number", "type_number", "code_number")).alias("number")).where("number is not null")
    return (good.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("number").cast("double")).cast("string").alias("least"))
            .unionByName(rejected.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"))))


def append_twice(spark: SparkSession, d: str) -> DataFrame:
    """Ratings of purchases appended twice under one batch id, then those of
    views: ratings per value, each counted once."""
    t = Tables(spark, d)
    path = f"{checkpoint_dir(spark).rstrip('/')}/ratings-{uuid.uuid4().hex}"
    ratings = t.events.select("event_type", "event_id", "user_id", F.floor(F.col("value") / 40).cast("bigint").alias("rating"))
    for kind in ("purchase", "purchase", "view"):
        append_once(ratings.where(F.col("event_type") == kind).drop("event_type"), path, kind)
    return read_committed(spark, path).groupBy("rating").agg(F.count(F.lit(1)).alias("n_ratings"))


def line_id_goes_on(spark: SparkSession, d: str) -> DataFrame:
    """Line ids over two appends: shipped lines first, open ones go on after them."""
    t = Tables(spark, d)
    path = f"{checkpoint_dir(spark).rstrip('/')}/lines-{uuid.uuid4().hex}"
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus"]
    for status in ("F", "O"):
        append_once(lines.where(F.col("l_linestatus") == status), path, status, "line_id", order)
    return read_committed(spark, path)


def catalog_table(spark: SparkSession, d: str) -> DataFrame:
    """Nations per region, read by qualified names from the catalog."""
    t = Tables(spark, d)
    t.nation.createOrReplaceGlobalTempView("casework_nation")
    t.region.createOrReplaceGlobalTempView("casework_region")
    db = spark.conf.get("spark.sql.globalTempDatabase", "global_temp")
    nation, region = (load_table(spark, d, f"{db}.casework_{n}") for n in ("nation", "region"))
    return (nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name")
            .agg(F.count(F.lit(1)).alias("n_nations")))


def month_filter(spark: SparkSession, d: str) -> DataFrame:
    """Points of purchases in any January: month of the date, whatever the year."""
    t = Tables(spark, d)
    lines = t.lineitem.where(F.month("l_shipdate") == 1)
    return lines.groupBy(F.year("l_shipdate").cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("decimal(20,2)")).cast("double").alias("quantity"))


def events_on_dates(spark: SparkSession, d: str) -> DataFrame:
    """Events per type on Mondays, from a layout by date: the filter on the
    dates prunes the events' folders at run time."""
    t = Tables(spark, d)
    path = f"{checkpoint_dir(spark).rstrip('/')}/events-by-date-{uuid.uuid4().hex}"
    write_by_date(t.events.select("event_id", "ts", "user_id", "event_type"), path, "ts", "user_id")
    dates = t.events.select(F.to_date("ts").alias("part_date")).distinct().where(F.dayofweek("part_date") == 2)
    return (on_dates(spark.read.schema("event_id long, ts timestamp_ntz, user_id long, event_type string, part_date date").parquet(path), dates)
            .groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events")))


def scan(spark: SparkSession, d: str) -> DataFrame:
    """Full scan of a dimension table."""
    return Tables(spark, d).region.select("r_regionkey", "r_name")


QUERIES = {
    "spend_per_customer": spend_per_customer,
    "visit_days": visit_days,
    "first_day_items": first_day_items,
    "top_item_overall": top_item_overall,
    "top_item_per_customer": top_item_per_customer,
    "first_after_anchor": first_after_anchor_q,
    "last_before_anchor": last_before_anchor_q,
    "totals_before_anchor": totals_before_anchor,
    "points_rules": points_rules,
    "points_bonus_window": points_bonus_window,
    "member_flag": member_flag_q,
    "member_rank": member_rank,
    "null_tokens": null_tokens_q,
    "parse_measure": parse_measure_q,
    "parse_props": parse_props,
    "line_id": line_id,
    "tagged_changes": tagged_changes,
    "top_change_token": top_change_token,
    "bag_edit_counts": bag_edit_counts,
    "counted_list": counted_list_q,
    "optional_label": optional_label,
    "standard_list": standard_list,
    "cond_counts": cond_counts_q,
    "unique_vs_all": unique_vs_all,
    "delivered_before_dim": delivered_before_dim,
    "largest_order": largest_order,
    "both_changes": both_changes,
    "volume_by_hour": volume_by_hour,
    "volume_by_weekday": volume_by_weekday,
    "signups_by_week": signups_by_week,
    "pickup_delay": pickup_delay,
    "size_vs_delay_label": size_vs_delay_label,
    "distance_per_customer": distance_per_customer,
    "range_of_measure": range_of_measure,
    "rate_with_avg": rate_with_avg,
    "success_rate": success_rate_q,
    "fixed_price_income": fixed_price_income,
    "net_income": net_income,
    "wide_order": wide_order,
    "rating_contract": rating_contract,
    "rating_append": rating_append,
    "journey": journey,
    "month_starts": month_starts,
    "events_after": events_after,
    "churn_rate": churn_rate,
    "straight_after_first": straight_after_first,
    "next_plan_rank": next_plan_rank,
    "next_plan_lead": next_plan_lead,
    "state_at_date": state_at_date,
    "upgrades_in_year": upgrades_in_year,
    "days_to_milestone_join": days_to_milestone_join,
    "days_to_milestone_lead": days_to_milestone_lead,
    "days_buckets": days_buckets,
    "scan": scan,
    "global_rank": global_rank,
    "rank_per_user": rank_per_user,
    "next_event": next_event,
    "last_anchor_per_event": last_anchor_per_event,
    "state_by_day": state_by_day,
    "parse_measure_rejects": parse_measure_rejects,
    "append_twice": append_twice,
    "line_id_goes_on": line_id_goes_on,
    "catalog_table": catalog_table,
    "month_filter": month_filter,
    "events_on_dates": events_on_dates,
}
