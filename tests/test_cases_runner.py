"""Whole cases run from tables stored in a folder."""

from fixtures import (
    CUSTOMER_ORDERS, MEMBERS, MENU, PIZZA_NAMES, PIZZA_RECIPES, PIZZA_TOPPINGS, PLANS,
    RUNNER_ORDERS, RUNNERS, SALES, SUBSCRIPTIONS_1_13, frame,
)

from casework.plans.cases import CASES, run_case

ROWS = {"sales": SALES, "menu": MENU, "members": MEMBERS, "runners": RUNNERS,
        "customer_orders": CUSTOMER_ORDERS, "runner_orders": RUNNER_ORDERS,
        "pizza_names": PIZZA_NAMES, "pizza_recipes": PIZZA_RECIPES,
        "pizza_toppings": PIZZA_TOPPINGS, "plans": PLANS, "subscriptions": SUBSCRIPTIONS_1_13}


def test_every_case_runs_from_a_folder(spark, tmp_path):
    src, out = tmp_path / "tables", tmp_path / "results"
    for name, data in ROWS.items():
        frame(spark, name, data).write.parquet(str(src / f"{name}.parquet"))
    # ratings for the delivered orders; order 10 breaks the 0..5 rule
    ratings = [(o, r, o % 7 if o != 10 else 9) for o, r in ((1, 1), (2, 1), (3, 1), (4, 2), (5, 3),
                                                             (7, 2), (8, 2), (10, 1))]
    frame(spark, "runner_ratings", ratings).write.parquet(str(src / "runner_ratings.parquet"))
    got = {}
    for case in CASES:
        # writing results is exercised once; the other cases are only evaluated
        res = run_case(spark, case, str(src), str(out / case) if case == "loyalty" else None)
        got.update({k: v.collect() for k, v in res.items()})
    assert len(got) == 12 + 34 + 14
    assert len(got["Q-C2-D3"]) == 7 and [r.order_id for r in got["Q-C2-D3-rejected"]] == [10]
    assert len(got["Q-C2-D4"]) == 7
    assert sorted((r[0], r[1]) for r in got["Q-C1-1"]) == [("A", 76), ("B", 74), ("C", 36)]
    assert got["Q-C2-D1"][0][0] == 138 and got["Q-C2-D2"][0][0] == 139
    assert len(got["Q-C2-T3"]) == 19 and len(got["Q-C3-A1"]) == 20
    assert spark.read.parquet(str(out / "loyalty" / "Q-C1-10")).count() == 2
