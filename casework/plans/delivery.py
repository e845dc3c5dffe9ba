"""Delivery operations case: order lines with packed ingredient edits,
deliveries with unit-suffixed measures, product names, recipes, toppings.

Tables: customer_orders(order_id, customer_id, pizza_id, exclusions, extras,
order_time), runner_orders(order_id, runner_id, pickup_time, distance,
duration, cancellation), runners(runner_id, registration_date),
pizza_names(pizza_id, pizza_name), pizza_recipes(pizza_id, toppings),
pizza_toppings(topping_id, topping_name).

The three cleaned stages (``clean_order_lines``, ``clean_deliveries``,
``ingredient_changes``) are lazy DataFrames; ``casework.sources.materialize``
writes one to the shared checkpoint folder when several jobs reuse it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.functions import (
    MISSING_TOKENS, MISSING_TOKENS_WITH_NAN, elapsed_micros, elapsed_minutes, hour_of_day, minute_field,
    null_tokens, optional_fragment, quotient, tokens, week_from_jan1, weekday_name,
)
from casework.functions.arrays import bag_edit
from casework.operators import (
    cond_counts, correlation_summary, counted_list, dense_ids, filtered_lists, join_back,
    ordered_list, parse_with_rejects, pay_per_unit, price_by, sort_like_sql, split_valid, success_rate,
    tagged_explode_outer,
    top_with_ties, with_group_stats, with_scalars,
)
from casework.operators.contract import check, not_null
from casework.sources.ledger import append_once
from casework.sources.sinks import append

# Product prices used by the income questions.
PRICES = {1: 12, 2: 10}


# ---------------------------------------------------------------- cleaned stages

def clean_lines(customer_orders: DataFrame) -> DataFrame:
    """Order lines with sentinel-free edit lists: a projection of the scan."""
    return customer_orders.select(
        "order_id", "customer_id", "pizza_id",
        null_tokens("exclusions", MISSING_TOKENS_WITH_NAN).alias("exclusions"),
        null_tokens("extras", MISSING_TOKENS_WITH_NAN).alias("extras"),
        "order_time")


def clean_order_lines(customer_orders: DataFrame) -> DataFrame:
    """``clean_lines`` with a dense line id, for the questions that name a line.

    Line ids follow ``order_id``; lines of one order are numbered in the
    order of their remaining columns, so ids are deterministic.
    """
    ided = dense_ids(customer_orders, ["order_id", "customer_id", "pizza_id", "exclusions",
                                       "extras", "order_time"], "order_item_id")
    cleaned = [null_tokens(c, MISSING_TOKENS_WITH_NAN).alias(c) for c in ("exclusions", "extras")]
    return ided.select("order_item_id", "order_id", "customer_id", "pizza_id", *cleaned, "order_time")


def clean_deliveries(runner_orders: DataFrame) -> DataFrame:
    """Deliveries with NULLs for missing values and numeric km / minutes; texts
    that hold no number are in ``clean_deliveries_with_rejects``."""
    return clean_deliveries_with_rejects(runner_orders)[0]


def clean_deliveries_with_rejects(runner_orders: DataFrame, observation=None) -> tuple[DataFrame, DataFrame]:
    """(cleaned deliveries, rejected): rejected holds each row whose distance or
    duration is given but no number, with column, value and reason. With an
    ``Observation``, running the first frame counts ``rows`` and ``rejected``."""
    parsed, rejected = parse_with_rejects(runner_orders, {"distance_km": "distance", "duration_min": "duration"}, MISSING_TOKENS, observation=observation)
    clean = parsed.select(
        "order_id", "runner_id",
        null_tokens("pickup_time", MISSING_TOKENS).alias("pickup_time"),
        "distance_km", "duration_min",
        null_tokens("cancellation", MISSING_TOKENS_WITH_NAN).alias("cancellation"))
    return clean, rejected


def ingredient_changes(lines: DataFrame) -> DataFrame:
    """One row per excluded or extra ingredient; untouched lines once with NULLs."""
    return tagged_explode_outer(
        lines,
        {"exclusion": tokens("exclusions", ",", "int"), "extra": tokens("extras", ",", "int")},
        keep=["order_item_id", "order_id", "customer_id", "pizza_id", "order_time"],
        tag_name="mod_type", value_name="ingredient_id", element_type="int")


def _delivered_lines(lines: DataFrame, deliveries: DataFrame) -> DataFrame:
    ok = deliveries.where(F.col("cancellation").isNull())
    return lines.join(ok.drop("cancellation"), "order_id")


# ---------------------------------------------------------------- A. volumes

def pizzas_ordered(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count(F.lit(1)).alias("n_pizzas_ordered"))


def unique_orders(lines: DataFrame) -> DataFrame:
    return lines.agg(F.countDistinct("order_id").alias("n_unique_orders"))


def delivered_per_runner(deliveries: DataFrame) -> DataFrame:
    out = (deliveries.where(F.col("cancellation").isNull()).groupBy("runner_id")
           .agg(F.count(F.lit(1)).alias("n_orders_delivered")))
    return sort_like_sql(out, ("n_orders_delivered", "desc"))


def delivered_per_product(lines: DataFrame, deliveries: DataFrame, names: DataFrame) -> DataFrame:
    counts = (_delivered_lines(lines, deliveries).groupBy("pizza_id")
              .agg(F.count(F.lit(1)).alias("n_delivery")))
    return sort_like_sql(counts.join(names, "pizza_id").select("pizza_name", "n_delivery"),
                         ("n_delivery", "desc"))


def products_per_customer(lines: DataFrame) -> DataFrame:
    return cond_counts(lines, "customer_id", {"n_meat_lovers_pizzas": F.col("pizza_id") == 1,
                                              "n_veg_pizzas": F.col("pizza_id") == 2})


def largest_delivered_order(lines: DataFrame, deliveries: DataFrame) -> DataFrame:
    per = (_delivered_lines(lines, deliveries).groupBy("order_id")
           .agg(F.count("pizza_id").alias("n_pizzas_delivered")))
    return top_with_ties(per, "n_pizzas_delivered").withColumn("rnk", F.lit(1))


def changed_per_customer(lines: DataFrame, deliveries: DataFrame) -> DataFrame:
    d = _delivered_lines(lines, deliveries)
    unchanged = F.col("exclusions").isNull() & F.col("extras").isNull()
    return d.groupBy("customer_id").agg(
        F.count("pizza_id").alias("n_pizzas_delivered"),
        F.count(F.when(unchanged, F.lit(True))).alias("n_unchanged_pizzas"),
        F.count(F.when(~unchanged, F.lit(True))).alias("n_changed_pizzas"))


def delivered_with_both_changes(lines: DataFrame, deliveries: DataFrame) -> DataFrame:
    d = _delivered_lines(lines, deliveries)
    both = F.col("exclusions").isNotNull() & F.col("extras").isNotNull()
    return d.where(both).agg(F.count("order_id").alias("n_pizzas_with_exclusion_and_extra_delivered"))


def volume_per_hour(lines: DataFrame) -> DataFrame:
    out = lines.groupBy(hour_of_day("order_time").alias("hour_of_day")).agg(
        F.count("order_id").alias("n_pizzas_ordered"))
    return sort_like_sql(out, ("n_pizzas_ordered", "desc"))


def volume_per_weekday(lines: DataFrame) -> DataFrame:
    out = lines.groupBy(weekday_name("order_time").alias("day_of_week")).agg(
        F.count("order_id").alias("n_pizzas_ordered"))
    return sort_like_sql(out, ("n_pizzas_ordered", "desc"))


# ---------------------------------------------------------------- B. runners

def signups_per_week(runners: DataFrame) -> DataFrame:
    out = runners.groupBy(week_from_jan1("registration_date").alias("week_num")).agg(
        F.count(F.lit(1)).alias("n_runners"))
    return sort_like_sql(out, ("n_runners", "desc"))


def _pickup_ts(deliveries: DataFrame) -> DataFrame:
    return deliveries.withColumn("pickup_ts", F.col("pickup_time").cast("timestamp_ntz"))


def avg_pickup_minutes(lines: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Minutes from order to pickup, rounded per order, averaged per runner."""
    d = _delivered_lines(lines, _pickup_ts(deliveries))
    per_order = d.select(
        "order_id", "runner_id",
        F.round(elapsed_micros("order_time", "pickup_ts").cast("decimal(20,0)")
                / F.lit(60_000_000).cast("decimal(20,0)"), 2).alias("pickup_duration_min")
    ).distinct()
    out = per_order.groupBy("runner_id").agg(
        F.round(F.sum("pickup_duration_min") / F.count("pickup_duration_min").cast("decimal(20,0)"), 2)
        .alias("avg_pickup_duration_min"))
    return sort_like_sql(out, "avg_pickup_duration_min")


def size_vs_prep_time(lines: DataFrame, deliveries: DataFrame) -> DataFrame:
    d = _delivered_lines(lines, _pickup_ts(deliveries))
    per = d.groupBy("order_id").agg(
        F.count("pizza_id").alias("n_pizzas"),
        (elapsed_micros(F.max("order_time"), F.max("pickup_ts")) / 1_000_000).alias("prep_s"))
    return correlation_summary(per, "n_pizzas", "prep_s")


def avg_distance_per_customer(lines: DataFrame, deliveries: DataFrame) -> DataFrame:
    orders = lines.select("order_id", "customer_id").distinct()
    d = orders.join(deliveries.where(F.col("cancellation").isNull()), "order_id")
    return d.groupBy("customer_id").agg(
        F.round(F.sum("distance_km") / F.count("distance_km").cast("decimal(20,0)"), 2)
        .alias("avg_distance_km"))


def delivery_time_range(deliveries: DataFrame) -> DataFrame:
    m = deliveries.where(F.col("cancellation").isNull()).agg(
        F.max("duration_min").alias("longest_delivery_time_min"),
        F.min("duration_min").alias("shortest_delivery_time_min"))
    return m.withColumn("difference", F.col("longest_delivery_time_min")
                        - F.col("shortest_delivery_time_min"))


def speed_per_delivery(deliveries: DataFrame) -> DataFrame:
    """km/h per delivery and the runner's average, computed as km * 60 / min."""
    d = deliveries.where(F.col("cancellation").isNull())
    speed = quotient(F.col("distance_km") * 60, "duration_min")
    d = d.withColumn("__speed", speed)
    out = with_group_stats(d, ["runner_id"], {"__avg": F.avg("__speed")})
    out = out.select("runner_id", "order_id", "pickup_time", "distance_km", "duration_min",
                     F.round("__speed", 2).alias("speed_kmh"),
                     F.round("__avg", 2).alias("avg_speed_kmh"))
    return sort_like_sql(out, "runner_id", "pickup_time")


def success_percentage(deliveries: DataFrame) -> DataFrame:
    out = success_rate(deliveries, "runner_id", F.col("cancellation").isNull(),
                       "success_percentage")
    return sort_like_sql(out, ("success_percentage", "desc"))


# ---------------------------------------------------------------- C. ingredients

def _named(df: DataFrame, toppings: DataFrame, id_col: str = "ingredient_id") -> DataFrame:
    t = toppings.withColumnRenamed("topping_id", id_col)
    return df.join(t, id_col)


def standard_ingredients(recipes: DataFrame, names: DataFrame, toppings: DataFrame) -> DataFrame:
    items = recipes.join(names, "pizza_id").select(
        "pizza_name", F.explode(tokens("toppings", ",", "int")).alias("ingredient_id"))
    return ordered_list(_named(items, toppings), ["pizza_name"], "topping_name", "toppings")


def most_common_change(changes: DataFrame, toppings: DataFrame, mod_type: str) -> DataFrame:
    c = changes.where((F.col("mod_type") == mod_type) & F.col("ingredient_id").isNotNull())
    counts = _named(c, toppings).groupBy("topping_name").agg(F.count(F.lit(1)).alias("n_usage"))
    return top_with_ties(counts, "n_usage")


def order_item_labels(lines: DataFrame, changes: DataFrame, toppings: DataFrame,
                      names: DataFrame) -> DataFrame:
    """``Meatlovers - Exclude A, B - Extra C`` per line (lists sorted by name)."""
    named = changes.join(toppings.withColumnRenamed("topping_id", "ingredient_id"),
                         "ingredient_id", "left")
    lists = filtered_lists(named, ["order_item_id"], "topping_name",
                           {"exclusion": F.col("mod_type") == "exclusion",
                            "extra": F.col("mod_type") == "extra"})
    base = lines.select("order_item_id", "pizza_id").join(names, "pizza_id")
    full = join_back(base, lists, ["order_item_id"], how="left")
    out = full.select(
        "order_item_id",
        F.concat("pizza_name", optional_fragment(" - Exclude ", "exclusion"),
                 optional_fragment(" - Extra ", "extra")).alias("order_item"))
    return sort_like_sql(out, "order_item_id")


def _line_ingredients(lines: DataFrame, recipes: DataFrame) -> DataFrame:
    bag = bag_edit(tokens("toppings", ",", "int"), tokens("exclusions", ",", "int"),
                   tokens("extras", ",", "int"), "int")
    return lines.join(recipes, "pizza_id").select(
        *[c for c in ("order_item_id", "order_id", "pizza_id") if c in lines.columns],
        F.explode(bag).alias("ingredient_id"))


def ingredient_lists(lines: DataFrame, recipes: DataFrame, toppings: DataFrame,
                     names: DataFrame) -> DataFrame:
    """``Meatlovers: 2xBacon, Beef, ...`` per line, alphabetical, with counts."""
    items = _named(_line_ingredients(lines, recipes), toppings)
    lists = counted_list(items, ["order_item_id", "pizza_id"], "topping_name", "__list")
    return lists.join(names, "pizza_id").select(
        "order_item_id", F.concat("pizza_name", F.lit(": "), "__list").alias("ingredient"))


def ingredient_use_delivered(lines: DataFrame, deliveries: DataFrame, recipes: DataFrame,
                             toppings: DataFrame) -> DataFrame:
    ok = deliveries.where(F.col("cancellation").isNull()).select("order_id")
    items = _line_ingredients(lines.join(ok, "order_id", "left_semi"), recipes)
    out = (_named(items, toppings).groupBy("topping_name")
           .agg(F.count("ingredient_id").alias("total_quantity_used")))
    return sort_like_sql(out, ("total_quantity_used", "desc"))


# ---------------------------------------------------------------- D. pricing, ratings

def _revenue(lines: DataFrame, deliveries: DataFrame, names: DataFrame) -> DataFrame:
    d = _delivered_lines(lines, deliveries).join(names.select("pizza_id"), "pizza_id", "left_semi")
    return d.agg(F.sum(price_by(F.col("pizza_id"), PRICES, 0)).alias("revenue_usd"))


def income(lines: DataFrame, deliveries: DataFrame, names: DataFrame) -> DataFrame:
    return _revenue(lines, deliveries, names).withColumnRenamed("revenue_usd", "total_income_usd")


def income_with_extras(lines: DataFrame, deliveries: DataFrame, changes: DataFrame,
                       ingredient_ids=(4,), delivered_only: bool = False,
                       surcharge: int = 1) -> DataFrame:
    """Base income of delivered lines (12 / else 10) plus ``surcharge`` per extra.

    As coded, only extras of the listed ingredient(s) are charged and they are
    counted over all lines, delivered or not; ``ingredient_ids=None`` charges
    every extra and ``delivered_only=True`` restricts them to delivered lines.
    """
    base = _delivered_lines(lines, deliveries).agg(
        F.sum(F.when(F.col("pizza_id") == 1, 12).otherwise(10)).alias("base_total"))
    ex = changes.where(F.col("mod_type") == "extra")
    if ingredient_ids is not None:
        ex = ex.where(F.col("ingredient_id").isin(*ingredient_ids))
    if delivered_only:
        ok = deliveries.where(F.col("cancellation").isNull()).select("order_id")
        ex = ex.join(ok, "order_id", "left_semi")
    extra = ex.agg((F.count(F.lit(1)) * surcharge).alias("extra_total"))
    return with_scalars(base, extra).select(
        (F.col("base_total") + F.col("extra_total")).alias("total_revenue_usd"))


def rating_rules(low: int = 0, high: int = 5):
    """The ratings table contract: three NOT NULL columns and a range CHECK
    (as coded 0..5; the question asks for 1..5)."""
    return not_null("order_id", "runner_id", "rating") + [
        check(f"rating between {low} and {high}", F.col("rating").between(low, high))]


def record_ratings(ratings: DataFrame, path: str | None = None,
                   rules=None, batch: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Check ratings (order_id, runner_id, rating) against the row contract and
    append the valid rows to ``path``; returns (valid, rejected). With a
    ``batch`` id the append is safe to run again: a batch that was committed
    is not appended twice, and ``read_committed`` reads the table."""
    valid, rejected = split_valid(ratings, rules if rules is not None else rating_rules())
    if path and batch:
        append_once(valid, path, batch)
    elif path:
        append(valid, path)
    return valid, rejected


def delivered_order_rows(lines: DataFrame, deliveries: DataFrame, ratings: DataFrame) -> DataFrame:
    """One row per delivered, rated order with times, speed and line count."""
    d = _delivered_lines(lines, _pickup_ts(deliveries)).join(
        ratings.select("order_id", "rating"), "order_id")
    d = with_group_stats(d, ["order_id"], {"n_pizzas": F.count("pizza_id")})
    return d.select(
        "order_id", "customer_id", "runner_id", "rating", "order_time", "pickup_time",
        minute_field("order_time", "pickup_ts").alias("order_prep_duration"),
        elapsed_minutes("order_time", "pickup_ts", 2).alias("order_prep_minutes"),
        "duration_min",
        F.round(quotient(F.col("distance_km") * 60, "duration_min"), 2).alias("speed_kmh"),
        "n_pizzas").distinct()


def net_income(lines: DataFrame, deliveries: DataFrame, names: DataFrame,
               rate: str = "0.3") -> DataFrame:
    pay = deliveries.where(F.col("cancellation").isNull()).agg(
        F.sum(pay_per_unit(F.col("distance_km"), rate)).alias("total_earning_usd"))
    rev = _revenue(lines, deliveries, names)
    return with_scalars(rev, pay).select(
        "revenue_usd", "total_earning_usd",
        (F.col("revenue_usd") - F.col("total_earning_usd")).alias("net_income_usd"))

