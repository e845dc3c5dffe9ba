"""Delivery operations case on its literal rows: one assertion per question."""

from decimal import Decimal

import pytest
from conftest import rows
from fixtures import (
    CUSTOMER_ORDERS, PIZZA_NAMES, PIZZA_RECIPES, PIZZA_TOPPINGS, RUNNER_ORDERS, RUNNERS, frame,
)
from pyspark.sql import functions as F

from casework.sources import read_committed
from casework.plans import delivery as q

MEAT_ALL = "Meatlovers: BBQ Sauce, Bacon, Beef, Cheese, Chicken, Mushrooms, Pepperoni, Salami"
VEG_ALL = "Vegetarian: Cheese, Mushrooms, Onions, Peppers, Tomato Sauce, Tomatoes"


@pytest.fixture(scope="module")
def t(spark):
    co = frame(spark, "customer_orders", CUSTOMER_ORDERS)
    ro = frame(spark, "runner_orders", RUNNER_ORDERS)
    lines = q.clean_order_lines(co).cache()
    deliveries = q.clean_deliveries(ro).cache()
    return {
        "lines": lines, "deliveries": deliveries, "changes": q.ingredient_changes(lines),
        "runners": frame(spark, "runners", RUNNERS),
        "names": frame(spark, "pizza_names", PIZZA_NAMES),
        "recipes": frame(spark, "pizza_recipes", PIZZA_RECIPES),
        "toppings": frame(spark, "pizza_toppings", PIZZA_TOPPINGS),
    }


def test_clean_lines(t):
    got = t["lines"].collect()
    assert sorted(r.order_item_id for r in got) == list(range(1, 15))
    # ids follow order_id
    by_id = sorted(got, key=lambda r: r.order_item_id)
    assert [r.order_id for r in by_id] == sorted(r.order_id for r in got)
    assert sum(r.exclusions is None for r in got) == 9
    assert sum(r.extras is None for r in got) == 10


def test_clean_deliveries(t):
    got = {r.order_id: r for r in t["deliveries"].collect()}
    assert sorted(k for k, r in got.items() if r.cancellation is not None) == [6, 9]
    assert [got[i].distance_km for i in range(1, 11)] == [
        Decimal(x) if x else None for x in
        ["20", "20", "13.4", "23.4", "10", None, "25", "23.4", None, "10"]]
    assert [got[i].duration_min for i in range(1, 11)] == [
        Decimal(x) if x else None for x in ["32", "27", "20", "40", "15", None, "25", "15", None, "10"]]
    assert got[6].pickup_time is None and got[1].pickup_time == "2020-01-01 18:15:34"


def test_ingredient_changes(t):
    got = t["changes"].collect()
    assert len(got) == 19
    assert sum(r.mod_type is None for r in got) == 7
    assert sum(r.mod_type == "exclusion" for r in got) == 6
    assert sum(r.mod_type == "extra" for r in got) == 6


def test_volumes(t):
    assert q.pizzas_ordered(t["lines"]).first()[0] == 14
    assert q.unique_orders(t["lines"]).first()[0] == 10
    assert rows(q.delivered_per_runner(t["deliveries"])) == [(1, 4), (2, 3), (3, 1)]
    assert rows(q.delivered_per_product(t["lines"], t["deliveries"], t["names"])) == [
        ("Meatlovers", 9), ("Vegetarian", 3)]
    assert rows(q.products_per_customer(t["lines"])) == [
        (101, 2, 1), (102, 2, 1), (103, 3, 1), (104, 3, 0), (105, 0, 1)]


def test_largest_order(t):
    assert rows(q.largest_delivered_order(t["lines"], t["deliveries"])) == [(4, 3, 1)]


def test_changes_per_customer(t):
    assert rows(q.changed_per_customer(t["lines"], t["deliveries"])) == [
        (101, 2, 2, 0), (102, 3, 3, 0), (103, 3, 0, 3), (104, 3, 1, 2), (105, 1, 0, 1)]
    assert q.delivered_with_both_changes(t["lines"], t["deliveries"]).first()[0] == 1


def test_time_buckets(t):
    assert rows(q.volume_per_hour(t["lines"])) == sorted(
        [(18, 3), (23, 3), (13, 3), (21, 3), (19, 1), (11, 1)], key=repr)
    assert rows(q.volume_per_weekday(t["lines"])) == sorted(
        [("wednesday", 5), ("saturday", 5), ("thursday", 3), ("friday", 1)], key=repr)
    assert rows(q.signups_per_week(t["runners"])) == [("01", 2), ("02", 1), ("03", 1)]


def test_pickup_minutes(t):
    got = rows(q.avg_pickup_minutes(t["lines"], t["deliveries"]))
    assert got == [(1, Decimal("14.33")), (2, Decimal("20.01")), (3, Decimal("10.47"))]


def test_correlation_label(t):
    r = q.size_vs_prep_time(t["lines"], t["deliveries"]).first()
    assert abs(r.correlation - 0.8357) < 1e-4
    assert r.relation == "Yes: Strong positive relationship"


def test_distance_and_durations(t):
    got = rows(q.avg_distance_per_customer(t["lines"], t["deliveries"]))
    assert [(c, float(v)) for c, v in got] == [(101, 20.0), (102, 18.4), (103, 23.4),
                                               (104, 10.0), (105, 25.0)]
    r = q.delivery_time_range(t["deliveries"]).first()
    assert (r[0], r[1], r[2]) == (Decimal("40"), Decimal("10"), Decimal("30"))


def test_speed(t):
    got = rows(q.speed_per_delivery(t["deliveries"]), "runner_id", "speed_kmh", "avg_speed_kmh")
    speeds = sorted((r, float(s), float(a)) for r, s, a in got)
    assert speeds == sorted([(1, 37.5, 45.54), (1, 44.44, 45.54), (1, 40.2, 45.54), (1, 60.0, 45.54),
                             (2, 35.1, 62.9), (2, 60.0, 62.9), (2, 93.6, 62.9), (3, 40.0, 40.0)])


def test_success_percentage(t):
    assert rows(q.success_percentage(t["deliveries"])) == [(1, 100.0), (2, 75.0), (3, 50.0)]


def test_standard_ingredients(t):
    got = dict(rows(q.standard_ingredients(t["recipes"], t["names"], t["toppings"])))
    assert "Meatlovers: " + got["Meatlovers"] == MEAT_ALL
    assert "Vegetarian: " + got["Vegetarian"] == VEG_ALL


def test_most_common_changes(t):
    assert rows(q.most_common_change(t["changes"], t["toppings"], "extra")) == [("Bacon", 4)]
    assert rows(q.most_common_change(t["changes"], t["toppings"], "exclusion")) == [("Cheese", 4)]


def test_order_item_labels(t):
    got = q.order_item_labels(t["lines"], t["changes"], t["toppings"], t["names"])
    labels = sorted(r.order_item for r in got.collect())
    assert labels == sorted(
        ["Meatlovers"] * 5 + ["Vegetarian"] * 2 + ["Meatlovers - Exclude Cheese"] * 2
        + ["Vegetarian - Exclude Cheese", "Meatlovers - Extra Bacon", "Vegetarian - Extra Bacon",
           "Meatlovers - Exclude Cheese - Extra Bacon, Chicken",
           "Meatlovers - Exclude BBQ Sauce, Mushrooms - Extra Bacon, Cheese"])


def test_ingredient_lists(t):
    got = q.ingredient_lists(t["lines"], t["recipes"], t["toppings"], t["names"])
    pairs = rows(got.join(t["lines"].select("order_item_id", "order_id"), "order_item_id"),
                 "order_id", "ingredient")
    expected = [(o, MEAT_ALL) for o in (1, 2, 3, 8, 10)] + [(o, VEG_ALL) for o in (3, 6)] + [
        (4, "Meatlovers: BBQ Sauce, Bacon, Beef, Chicken, Mushrooms, Pepperoni, Salami"),
        (4, "Meatlovers: BBQ Sauce, Bacon, Beef, Chicken, Mushrooms, Pepperoni, Salami"),
        (4, "Vegetarian: Mushrooms, Onions, Peppers, Tomato Sauce, Tomatoes"),
        (5, "Meatlovers: BBQ Sauce, 2xBacon, Beef, Cheese, Chicken, Mushrooms, Pepperoni, Salami"),
        (7, "Vegetarian: Bacon, Cheese, Mushrooms, Onions, Peppers, Tomato Sauce, Tomatoes"),
        (9, "Meatlovers: BBQ Sauce, 2xBacon, Beef, 2xChicken, Mushrooms, Pepperoni, Salami"),
        (10, "Meatlovers: 2xBacon, Beef, 2xCheese, Chicken, Pepperoni, Salami"),
    ]
    assert pairs == sorted(expected, key=repr)


def test_ingredient_use(t):
    got = dict(rows(q.ingredient_use_delivered(t["lines"], t["deliveries"], t["recipes"],
                                               t["toppings"])))
    assert got == {"Bacon": 12, "Mushrooms": 11, "Cheese": 10, "Beef": 9, "Chicken": 9,
                   "Pepperoni": 9, "Salami": 9, "BBQ Sauce": 8, "Onions": 3, "Peppers": 3,
                   "Tomato Sauce": 3, "Tomatoes": 3}


def test_income(t):
    assert q.income(t["lines"], t["deliveries"], t["names"]).first()[0] == 138
    assert q.income_with_extras(t["lines"], t["deliveries"], t["changes"]).first()[0] == 139
    r = q.net_income(t["lines"], t["deliveries"], t["names"]).first()
    assert (r[0], float(r[1]), float(r[2])) == (138, 43.56, 94.44)


def test_ratings_contract_and_append(spark, t, tmp_path):
    delivered = t["deliveries"].where(F.col("cancellation").isNull())
    # ratings -3..6 for orders 1..10: orders 1, 2, 3 (below 0) and 10 (6) break the CHECK
    ratings = delivered.select("order_id", "runner_id",
                               (F.col("order_id") - 4).cast("int").alias("rating"))
    ratings = ratings.unionByName(
        spark.createDataFrame([(11, None, 3)], "order_id int, runner_id int, rating int"))
    valid, rejected = q.record_ratings(ratings, str(tmp_path / "ratings"))
    assert sorted(r.order_id for r in valid.collect()) == [4, 5, 7, 8]
    assert sorted((r.order_id, r.reject_reason) for r in rejected.collect()) == [
        (1, "rating between 0 and 5"), (2, "rating between 0 and 5"),
        (3, "rating between 0 and 5"), (10, "rating between 0 and 5"), (11, "runner_id is null")]
    assert spark.read.parquet(str(tmp_path / "ratings")).count() == 4
    q.record_ratings(ratings, str(tmp_path / "ratings"))          # append, not overwrite
    assert spark.read.parquet(str(tmp_path / "ratings")).count() == 8
    for _ in range(2):                                            # one batch, however often it runs
        q.record_ratings(ratings, str(tmp_path / "safe"), batch="2021-01")
    assert read_committed(spark, str(tmp_path / "safe")).count() == 4


def test_delivered_order_rows(t):
    delivered = t["deliveries"].where(F.col("cancellation").isNull())
    ratings = delivered.select("order_id", "runner_id", F.lit(5).alias("rating"))
    got = q.delivered_order_rows(t["lines"], t["deliveries"], ratings).collect()
    assert len(got) == 8
    assert all(int(r.order_prep_minutes) % 60 == r.order_prep_duration for r in got)
    assert sorted((r.order_id, r.order_prep_duration, r.n_pizzas) for r in got) == [
        (1, 10, 1), (2, 10, 1), (3, 21, 2), (4, 29, 3), (5, 10, 1), (7, 10, 1), (8, 20, 1),
        (10, 15, 2)]
