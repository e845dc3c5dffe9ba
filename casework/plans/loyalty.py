"""Loyalty sales case: sales(customer_id, order_date, product_id),
menu(product_id, product_name, price), members(customer_id, join_date).

Each function is one business question, built from the library operators;
they run unchanged on a table of any size with this schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.operators import (
    dense_rank_column, first_after_anchor, first_per, last_before_anchor,
    member_flag, points, relative_to_anchor, sort_like_sql, top_with_ties, totals_relative,
    within_days_after,
)


def _priced(sales: DataFrame, menu: DataFrame) -> DataFrame:
    return sales.join(menu, "product_id")


def total_spent(sales: DataFrame, menu: DataFrame) -> DataFrame:
    return (_priced(sales, menu).groupBy(F.col("customer_id").alias("customer"))
            .agg(F.sum("price").alias("total")))


def visit_days(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_id").agg(F.countDistinct("order_date").alias("n_visited"))


def first_day_items(sales: DataFrame, menu: DataFrame, distinct: bool = False) -> DataFrame:
    """Items on each customer's first visit day; duplicates kept (no DISTINCT)
    unless ``distinct``."""
    out = (first_per(sales, "customer_id", "order_date").join(menu, "product_id")
           .select("customer_id", "product_id", "product_name"))
    return out.distinct() if distinct else out


def most_purchased(sales: DataFrame, menu: DataFrame) -> DataFrame:
    counts = sales.groupBy("product_id").agg(F.count(F.lit(1)).alias("n_purchase"))
    return (top_with_ties(counts, "n_purchase").join(menu, "product_id")
            .select("product_id", "product_name", "n_purchase"))


def favourite_per_customer(sales: DataFrame, menu: DataFrame) -> DataFrame:
    counts = sales.groupBy("customer_id", "product_id").agg(F.count(F.lit(1)).alias("n_sale"))
    return (top_with_ties(counts, "n_sale", by="customer_id").join(menu, "product_id")
            .select("customer_id", "product_name", "n_sale"))


def first_after_joining(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    return (first_after_anchor(_priced(sales, menu), members, "customer_id", "order_date", "join_date")
            .select("customer_id", "product_name", "order_date"))


def last_before_joining(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    return (last_before_anchor(_priced(sales, menu), members, "customer_id", "order_date", "join_date")
            .select("customer_id", "product_name", "order_date"))


def totals_before_joining(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    return totals_relative(_priced(sales, menu), members, "customer_id", "order_date",
                           F.col("price"), "join_date", "before",
                           "total_items", "total_amount_spent")


def points_per_customer(sales: DataFrame, menu: DataFrame, doubled: str = "sushi") -> DataFrame:
    """10 points per $1, the ``doubled`` product earns twice."""
    pts = points(F.col("price"), 10, [(F.col("product_name") == doubled, 2)])
    out = (_priced(sales, menu).groupBy("customer_id")
           .agg(F.sum("price").alias("total_spent"), F.sum(pts).alias("points_earned")))
    return sort_like_sql(out, ("points_earned", "desc"))


def points_with_bonus_week(sales: DataFrame, menu: DataFrame, members: DataFrame,
                           month: int = 1, bonus_days: int = 7, inclusive: bool = True,
                           doubled: str | None = None,
                           dates: tuple[str, str] | None = None) -> DataFrame:
    """Members' points in ``month``: everything doubles from the join date for
    ``bonus_days`` more days (as coded: days 0..7, i.e. 8 days). Outside the
    window only ``doubled`` (if given) earns double; by default nothing does.
    ``dates`` (first, last day) takes the place of the month of any year.
    """
    rel = relative_to_anchor(_priced(sales, menu), members, "customer_id", "order_date",
                             "join_date", "any")
    rules = [(within_days_after(F.col("order_date"), F.col("join_date"), bonus_days, inclusive), 2)]
    if doubled:
        rules.append((F.col("product_name") == doubled, 2))
    pts = points(F.col("price"), 10, rules)
    during = (F.month("order_date") == month) if dates is None else F.col("order_date").between(
        *[F.lit(d).cast("date") for d in dates])
    out = (rel.where(during).groupBy("customer_id")
           .agg(F.sum(pts).alias("points_earned")))
    return sort_like_sql(out, ("points_earned", "desc"))


def member_table(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    flagged = member_flag(sales, members, "customer_id", "order_date", "join_date")
    out = flagged.join(menu, "product_id").select(
        "customer_id", "order_date", "product_name", "price", "member")
    return sort_like_sql(out, "customer_id", "order_date", ("price", "desc"))


def member_ranking(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    t = member_table(sales, menu, members)
    out = dense_rank_column(t, ["customer_id", "member"], "order_date", "ranking",
                            where=F.col("member") == "Y")
    return sort_like_sql(out, "customer_id", "order_date", ("price", "desc"))

