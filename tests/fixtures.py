"""Case-study fixture rows as Spark DataFrames.

Fixed values: the literal rows of the three case studies, transcribed in
their natural order (the subscription case only for customers 1-13).
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from casework.sources.tables import CASE_SCHEMAS

D = dt.date.fromisoformat


def T(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


SALES = [
    ("A", D("2021-01-01"), 1), ("A", D("2021-01-01"), 2), ("A", D("2021-01-07"), 2),
    ("A", D("2021-01-10"), 3), ("A", D("2021-01-11"), 3), ("A", D("2021-01-11"), 3),
    ("B", D("2021-01-01"), 2), ("B", D("2021-01-02"), 2), ("B", D("2021-01-04"), 1),
    ("B", D("2021-01-11"), 1), ("B", D("2021-01-16"), 3), ("B", D("2021-02-01"), 3),
    ("C", D("2021-01-01"), 3), ("C", D("2021-01-01"), 3), ("C", D("2021-01-07"), 3),
]
MENU = [(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)]
MEMBERS = [("A", D("2021-01-07")), ("B", D("2021-01-09"))]

RUNNERS = [(1, D("2021-01-01")), (2, D("2021-01-03")), (3, D("2021-01-08")), (4, D("2021-01-15"))]
CUSTOMER_ORDERS = [
    (1, 101, 1, "", "", T("2020-01-01 18:05:02")),
    (2, 101, 1, "", "", T("2020-01-01 19:00:52")),
    (3, 102, 1, "", "", T("2020-01-02 23:51:23")),
    (3, 102, 2, "", None, T("2020-01-02 23:51:23")),
    (4, 103, 1, "4", "", T("2020-01-04 13:23:46")),
    (4, 103, 1, "4", "", T("2020-01-04 13:23:46")),
    (4, 103, 2, "4", "", T("2020-01-04 13:23:46")),
    (5, 104, 1, "null", "1", T("2020-01-08 21:00:29")),
    (6, 101, 2, "null", "null", T("2020-01-08 21:03:13")),
    (7, 105, 2, "null", "1", T("2020-01-08 21:20:29")),
    (8, 102, 1, "null", "null", T("2020-01-09 23:54:33")),
    (9, 103, 1, "4", "1, 5", T("2020-01-10 11:22:59")),
    (10, 104, 1, "null", "null", T("2020-01-11 18:34:49")),
    (10, 104, 1, "2, 6", "1, 4", T("2020-01-11 18:34:49")),
]
RUNNER_ORDERS = [
    (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
    (2, 1, "2020-01-01 19:10:54", "20km", "27 minutes", ""),
    (3, 1, "2020-01-03 00:12:37", "13.4km", "20 mins", None),
    (4, 2, "2020-01-04 13:53:03", "23.4", "40", None),
    (5, 3, "2020-01-08 21:10:57", "10", "15", None),
    (6, 3, "null", "null", "null", "Restaurant Cancellation"),
    (7, 2, "2020-01-08 21:30:45", "25km", "25mins", "null"),
    (8, 2, "2020-01-10 00:15:02", "23.4 km", "15 minute", "null"),
    (9, 2, "null", "null", "null", "Customer Cancellation"),
    (10, 1, "2020-01-11 18:50:20", "10km", "10minutes", "null"),
]
PIZZA_NAMES = [(1, "Meatlovers"), (2, "Vegetarian")]
PIZZA_RECIPES = [(1, "1, 2, 3, 4, 5, 6, 8, 10"), (2, "4, 6, 7, 9, 11, 12")]
PIZZA_TOPPINGS = [(1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"),
                  (6, "Mushrooms"), (7, "Onions"), (8, "Pepperoni"), (9, "Peppers"),
                  (10, "Salami"), (11, "Tomatoes"), (12, "Tomato Sauce")]

PLANS = [(0, "trial", Decimal("0")), (1, "basic monthly", Decimal("9.90")),
         (2, "pro monthly", Decimal("19.90")), (3, "pro annual", Decimal("199")),
         (4, "churn", None)]
# customers 1-13 of the subscription case
SUBSCRIPTIONS_1_13 = [
    (1, 0, D("2020-08-01")), (1, 1, D("2020-08-08")),
    (2, 0, D("2020-09-20")), (2, 3, D("2020-09-27")),
    (3, 0, D("2020-01-13")), (3, 1, D("2020-01-20")),
    (4, 0, D("2020-01-17")), (4, 1, D("2020-01-24")), (4, 4, D("2020-04-21")),
    (5, 0, D("2020-08-03")), (5, 1, D("2020-08-10")),
    (6, 0, D("2020-12-23")), (6, 1, D("2020-12-30")), (6, 4, D("2021-02-26")),
    (7, 0, D("2020-02-05")), (7, 1, D("2020-02-12")), (7, 2, D("2020-05-22")),
    (8, 0, D("2020-06-11")), (8, 1, D("2020-06-18")), (8, 2, D("2020-08-03")),
    (9, 0, D("2020-12-07")), (9, 3, D("2020-12-14")),
    (10, 0, D("2020-09-19")), (10, 2, D("2020-09-26")),
    (11, 0, D("2020-11-19")), (11, 4, D("2020-11-26")),
    (12, 0, D("2020-09-22")), (12, 1, D("2020-09-29")),
    (13, 0, D("2020-12-15")), (13, 1, D("2020-12-22")), (13, 2, D("2021-03-29")),
]


def frame(spark: SparkSession, name: str, rows) -> DataFrame:
    return spark.createDataFrame(rows, CASE_SCHEMAS[name])
