"""Loyalty sales case on its literal rows: one assertion per question."""

import datetime as dt

import pytest
from conftest import rows
from fixtures import MEMBERS, MENU, SALES, frame

from casework.plans import loyalty as q

D = dt.date.fromisoformat


@pytest.fixture(scope="module")
def t(spark):
    return {"sales": frame(spark, "sales", SALES), "menu": frame(spark, "menu", MENU),
            "members": frame(spark, "members", MEMBERS)}


def test_total_spent(t):
    assert rows(q.total_spent(t["sales"], t["menu"])) == [("A", 76), ("B", 74), ("C", 36)]


def test_visit_days(t):
    assert rows(q.visit_days(t["sales"])) == [("A", 4), ("B", 6), ("C", 2)]


def test_first_day_items_keeps_duplicates(t):
    got = rows(q.first_day_items(t["sales"], t["menu"]), "customer_id", "product_name")
    assert got == sorted([("A", "sushi"), ("A", "curry"), ("B", "curry"), ("C", "ramen"),
                          ("C", "ramen")], key=repr)


def test_first_day_items_distinct(t):
    got = rows(q.first_day_items(t["sales"], t["menu"], distinct=True), "customer_id", "product_name")
    assert got == [("A", "curry"), ("A", "sushi"), ("B", "curry"), ("C", "ramen")]


def test_points_in_a_range_of_dates(t):
    by_month = rows(q.points_with_bonus_week(t["sales"], t["menu"], t["members"]))
    by_dates = rows(q.points_with_bonus_week(t["sales"], t["menu"], t["members"], dates=("2021-01-01", "2021-01-31")))
    assert by_dates == by_month
    assert q.points_with_bonus_week(t["sales"], t["menu"], t["members"], dates=("2020-01-01", "2020-01-31")).count() == 0


def test_first_event_of_entities_without_an_anchor(t):
    from casework.operators import first_after_anchor
    got = rows(first_after_anchor(t["sales"], t["members"], "customer_id", "order_date", "join_date", how="left"), "customer_id", "product_id")
    inner = rows(first_after_anchor(t["sales"], t["members"], "customer_id", "order_date", "join_date"), "customer_id", "product_id")
    # C never joined: the items of its first day, ramen twice
    assert got == sorted([*inner, ("C", 3), ("C", 3)], key=repr)


def test_most_purchased(t):
    assert rows(q.most_purchased(t["sales"], t["menu"])) == [(3, "ramen", 8)]


def test_favourite_with_ties(t):
    got = rows(q.favourite_per_customer(t["sales"], t["menu"]))
    assert got == sorted([("A", "ramen", 3), ("B", "sushi", 2), ("B", "curry", 2),
                          ("B", "ramen", 2), ("C", "ramen", 3)], key=repr)


def test_first_after_joining(t):
    got = rows(q.first_after_joining(t["sales"], t["menu"], t["members"]))
    assert got == [("A", "curry", D("2021-01-07")), ("B", "sushi", D("2021-01-11"))]


def test_last_before_joining(t):
    got = rows(q.last_before_joining(t["sales"], t["menu"], t["members"]))
    assert got == sorted([("A", "sushi", D("2021-01-01")), ("A", "curry", D("2021-01-01")),
                          ("B", "sushi", D("2021-01-04"))], key=repr)


def test_totals_before_joining(t):
    got = rows(q.totals_before_joining(t["sales"], t["menu"], t["members"]))
    assert got == [("A", 2, 25), ("B", 3, 40)]


def test_points(t):
    got = rows(q.points_per_customer(t["sales"], t["menu"]))
    assert got == [("A", 76, 860), ("B", 74, 940), ("C", 36, 360)]


def test_points_bonus_week_as_coded(t):
    got = rows(q.points_with_bonus_week(t["sales"], t["menu"], t["members"]))
    assert got == [("A", 1270), ("B", 840)]


def test_points_bonus_week_as_asked(t):
    got = rows(q.points_with_bonus_week(t["sales"], t["menu"], t["members"],
                                        inclusive=False, doubled="sushi"))
    assert got == [("A", 1370), ("B", 820)]


def test_member_table(t):
    got = q.member_table(t["sales"], t["menu"], t["members"]).collect()
    assert len(got) == 15
    ys = sorted((r.customer_id, r.order_date) for r in got if r.member == "Y")
    assert ys == [("A", D("2021-01-07")), ("A", D("2021-01-10")), ("A", D("2021-01-11")),
                  ("A", D("2021-01-11")), ("B", D("2021-01-11")), ("B", D("2021-01-16")),
                  ("B", D("2021-02-01"))]
    assert {r.member for r in got if r.customer_id == "C"} == {"N"}


def test_member_ranking(t):
    got = q.member_ranking(t["sales"], t["menu"], t["members"]).collect()
    assert len(got) == 15
    ranked = sorted((r.customer_id, r.order_date, r.ranking) for r in got if r.ranking is not None)
    assert ranked == [("A", D("2021-01-07"), 1), ("A", D("2021-01-10"), 2), ("A", D("2021-01-11"), 3),
                      ("A", D("2021-01-11"), 3), ("B", D("2021-01-11"), 1), ("B", D("2021-01-16"), 2),
                      ("B", D("2021-02-01"), 3)]
    assert all(r.ranking is None for r in got if r.member == "N")


def test_points_sorted_desc(t):
    got = [r.customer_id for r in q.points_per_customer(t["sales"], t["menu"]).collect()]
    assert got == ["B", "A", "C"]
