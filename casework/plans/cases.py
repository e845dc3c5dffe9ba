"""Run the case-study questions over tables stored in a folder.

``run_case(spark, "loyalty", folder)`` loads the case's tables (Parquet,
CSV or JSON, read with their declared schemas) and returns one lazy
DataFrame per question id; with ``out`` every result is also written as
Parquet under ``out/<question id>``.

    python -m casework.plans.cases loyalty /data/loyalty [/data/results]
"""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casework.plans import delivery as dv
from casework.plans import loyalty as ly
from casework.plans import subscriptions as sb
from casework.sources import StageStore, load_table

Question = Callable[[dict[str, DataFrame]], DataFrame]


def _loyalty() -> dict[str, Question]:
    return {
        "Q-C1-1": lambda t: ly.total_spent(t["sales"], t["menu"]),
        "Q-C1-2": lambda t: ly.visit_days(t["sales"]),
        "Q-C1-3": lambda t: ly.first_day_items(t["sales"], t["menu"]),
        "Q-C1-4": lambda t: ly.most_purchased(t["sales"], t["menu"]),
        "Q-C1-5": lambda t: ly.favourite_per_customer(t["sales"], t["menu"]),
        "Q-C1-6": lambda t: ly.first_after_joining(t["sales"], t["menu"], t["members"]),
        "Q-C1-7": lambda t: ly.last_before_joining(t["sales"], t["menu"], t["members"]),
        "Q-C1-8": lambda t: ly.totals_before_joining(t["sales"], t["menu"], t["members"]),
        "Q-C1-9": lambda t: ly.points_per_customer(t["sales"], t["menu"]),
        "Q-C1-10": lambda t: ly.points_with_bonus_week(t["sales"], t["menu"], t["members"]),
        "Q-C1-B1": lambda t: ly.member_table(t["sales"], t["menu"], t["members"]),
        "Q-C1-B2": lambda t: ly.member_ranking(t["sales"], t["menu"], t["members"]),
    }


def _delivery() -> dict[str, Question]:
    def lines(t):
        return dv.clean_lines(t["customer_orders"])

    def numbered(t):
        # built once per run; with a stage store, a later run finds it again
        if "numbered lines" not in t:
            stages = t.get("stages")
            t["numbered lines"] = (stages.get("numbered-lines", t["customer_orders"], dv.clean_order_lines) if stages
                                   else dv.clean_order_lines(t["customer_orders"]))
        return t["numbered lines"]

    def dels(t):
        return dv.clean_deliveries(t["runner_orders"])

    def changes(t):
        return dv.ingredient_changes(numbered(t))

    return {
        "Q-C2-T1": numbered,
        "Q-C2-T2": dels,
        "Q-C2-T2-rejected": lambda t: dv.clean_deliveries_with_rejects(t["runner_orders"])[1],
        "Q-C2-T3": changes,
        "Q-C2-A1": lambda t: dv.pizzas_ordered(lines(t)),
        "Q-C2-A2": lambda t: dv.unique_orders(lines(t)),
        "Q-C2-A3": lambda t: dv.delivered_per_runner(dels(t)),
        "Q-C2-A4": lambda t: dv.delivered_per_product(lines(t), dels(t), t["pizza_names"]),
        "Q-C2-A5": lambda t: dv.products_per_customer(lines(t)),
        "Q-C2-A6": lambda t: dv.largest_delivered_order(lines(t), dels(t)),
        "Q-C2-A7": lambda t: dv.changed_per_customer(lines(t), dels(t)),
        "Q-C2-A8": lambda t: dv.delivered_with_both_changes(lines(t), dels(t)),
        "Q-C2-A9": lambda t: dv.volume_per_hour(lines(t)),
        "Q-C2-A10": lambda t: dv.volume_per_weekday(lines(t)),
        "Q-C2-B1": lambda t: dv.signups_per_week(t["runners"]),
        "Q-C2-B2": lambda t: dv.avg_pickup_minutes(lines(t), dels(t)),
        "Q-C2-B3": lambda t: dv.size_vs_prep_time(lines(t), dels(t)),
        "Q-C2-B4": lambda t: dv.avg_distance_per_customer(lines(t), dels(t)),
        "Q-C2-B5": lambda t: dv.delivery_time_range(dels(t)),
        "Q-C2-B6": lambda t: dv.speed_per_delivery(dels(t)),
        "Q-C2-B7": lambda t: dv.success_percentage(dels(t)),
        "Q-C2-C1": lambda t: dv.standard_ingredients(t["pizza_recipes"], t["pizza_names"],
                                                     t["pizza_toppings"]),
        "Q-C2-C2": lambda t: dv.most_common_change(changes(t), t["pizza_toppings"], "extra"),
        "Q-C2-C3": lambda t: dv.most_common_change(changes(t), t["pizza_toppings"], "exclusion"),
        "Q-C2-C4a": changes,
        "Q-C2-C4": lambda t: dv.order_item_labels(numbered(t), changes(t), t["pizza_toppings"],
                                                  t["pizza_names"]),
        "Q-C2-C5": lambda t: dv.ingredient_lists(numbered(t), t["pizza_recipes"], t["pizza_toppings"],
                                                 t["pizza_names"]),
        "Q-C2-C6": lambda t: dv.ingredient_use_delivered(lines(t), dels(t), t["pizza_recipes"],
                                                         t["pizza_toppings"]),
        "Q-C2-D1": lambda t: dv.income(lines(t), dels(t), t["pizza_names"]),
        "Q-C2-D2": lambda t: dv.income_with_extras(lines(t), dels(t), changes(t)),
        "Q-C2-D5": lambda t: dv.net_income(lines(t), dels(t), t["pizza_names"]),
    }


def _subscriptions() -> dict[str, Question]:
    return {
        "Q-C3-A1": lambda t: sb.journey(t["subscriptions"], t["plans"]),
        "Q-C3-B1": lambda t: sb.customers_ever(t["subscriptions"]),
        "Q-C3-B2": lambda t: sb.trials_per_month(t["subscriptions"]),
        "Q-C3-B3": lambda t: sb.events_after(t["subscriptions"], t["plans"]),
        "Q-C3-B4": lambda t: sb.churn_rate(t["subscriptions"]),
        "Q-C3-B5": lambda t: sb.churn_after_trial(t["subscriptions"]),
        "Q-C3-B6a": lambda t: sb.plan_after_trial_rank(t["subscriptions"], t["plans"]),
        "Q-C3-B6b": lambda t: sb.plan_after_trial_lead(t["subscriptions"], t["plans"]),
        "Q-C3-B7": lambda t: sb.plan_breakdown_at(t["subscriptions"], t["plans"]),
        "Q-C3-B8": lambda t: sb.annual_upgrades(t["subscriptions"]),
        "Q-C3-S": lambda t: sb.list_plans(t["plans"]),
        "Q-C3-B9a": lambda t: sb.days_to_annual_lead(t["subscriptions"]),
        "Q-C3-B9b": lambda t: sb.days_to_annual_join(t["subscriptions"]),
        "Q-C3-B10": lambda t: sb.days_to_annual_buckets(t["subscriptions"]),
    }


CASES: dict[str, tuple[list[str], Callable[[], dict[str, Question]]]] = {
    "loyalty": (["sales", "menu", "members"], _loyalty),
    "delivery": (["runners", "customer_orders", "runner_orders", "pizza_names", "pizza_recipes",
                  "pizza_toppings"], _delivery),
    "subscriptions": (["plans", "subscriptions"], _subscriptions),
}


def _has_table(spark: SparkSession, folder: str, name: str, fmt: str) -> bool:
    """Whether the table's file or folder is there, on whichever file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}.{fmt}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def run_case(spark: SparkSession, case: str, folder: str, out: str | None = None,
             fmt: str = "parquet", stages: StageStore | None = None) -> dict[str, DataFrame]:
    """All questions of ``case`` over the tables in ``folder``.

    With a ``StageStore``, stages that several questions share are written
    there once, found again by a later run over unchanged tables, and removed
    when the store is closed (results that still read them are then void).

    The ratings questions of the delivery case run when the folder also
    holds ``runner_ratings`` (order_id, runner_id, rating): D3 splits it by the
    ratings contract (valid rows, and rejected rows with their reason), D4
    builds the wide row per delivered, validly rated order.
    """
    names, questions = CASES[case]
    tables: dict = {n: load_table(spark, folder, n, fmt=fmt) for n in names}
    if stages:
        tables["stages"] = stages
    results = {qid: q(tables) for qid, q in questions().items()}
    if case == "delivery" and _has_table(spark, folder, "runner_ratings", fmt):
        ratings = load_table(spark, folder, "runner_ratings", fmt=fmt)
        lines = dv.clean_lines(tables["customer_orders"])
        dels = dv.clean_deliveries(tables["runner_orders"])
        valid, rejected = dv.record_ratings(ratings)
        results["Q-C2-D3"] = valid
        results["Q-C2-D3-rejected"] = rejected
        results["Q-C2-D4"] = dv.delivered_order_rows(lines, dels, valid)
    if out:
        for qid, df in results.items():
            df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{qid}")
    return results


if __name__ == "__main__":
    from casework.session import get_spark
    from casework.sources import drop_stages

    if len(sys.argv) < 3 or sys.argv[1] not in CASES:
        sys.exit(f"usage: python -m casework.plans.cases {{{'|'.join(CASES)}}} <folder> [<out>]")
    session = get_spark()
    with StageStore(session, f"case-{sys.argv[1]}") as store:
        for qid, frame in run_case(session, sys.argv[1], sys.argv[2],
                                   sys.argv[3] if len(sys.argv) > 3 else None, stages=store).items():
            print(f"== {qid}")
            frame.show(20, truncate=False)
    drop_stages(session)
