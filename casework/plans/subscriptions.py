"""Subscription lifecycle case: subscriptions(customer_id, plan_id, start_date)
and plans(plan_id, plan_name, price).

Plan 0 is the trial, 3 the annual plan, 4 churn (fixed ids of the case).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.functions import day_bucket_label, exact_ratio, month_start, percent_text
from casework.operators import (
    distinct_and_flagged, milestone_after_anchor, next_value, nth_per, share_of_total,
    sort_like_sql, state_at, with_scalars,
)

# Plan ids with a role in the questions.
TRIAL, ANNUAL, CHURN = 0, 3, 4


def _d(s: str) -> _dt.date:
    return _dt.date.fromisoformat(s)


def journey(subs: DataFrame, plans: DataFrame, first_id: int = 1, last_id: int = 8) -> DataFrame:
    """Plan history of a key range of customers, with plan names."""
    out = (subs.where(F.col("customer_id").between(first_id, last_id)).join(plans, "plan_id")
           .select("customer_id", "plan_name", "start_date"))
    return sort_like_sql(out, "customer_id", "start_date")


def customers_ever(subs: DataFrame) -> DataFrame:
    return subs.agg(F.countDistinct("customer_id").alias("n_customers"))


def trials_per_month(subs: DataFrame) -> DataFrame:
    out = (subs.where(F.col("plan_id") == TRIAL)
           .groupBy(month_start("start_date").alias("month"))
           .agg(F.count("plan_id").alias("n_trial_plans")))
    return sort_like_sql(out, "month")


def events_after(subs: DataFrame, plans: DataFrame, bound: str = "2021-01-01",
                 inclusive: bool = False) -> DataFrame:
    """Plan changes strictly after ``bound`` (as coded), per plan name."""
    b = F.lit(_d(bound))
    cond = F.col("start_date") >= b if inclusive else F.col("start_date") > b
    out = (subs.where(cond).join(plans, "plan_id").groupBy("plan_name")
           .agg(F.count("plan_id").alias("n_events")))
    return sort_like_sql(out, ("n_events", "desc"))


def churn_rate(subs: DataFrame) -> DataFrame:
    c = distinct_and_flagged(subs, "customer_id", F.col("plan_id") == CHURN,
                             "n_customers", "__churned")
    return c.select("n_customers", percent_text("__churned", "n_customers", 1).alias("churn"))


def churn_after_trial(subs: DataFrame) -> DataFrame:
    """Customers whose second plan (by date) is churn, count and whole percent."""
    second = nth_per(subs, "customer_id", "start_date", 2)
    n = second.agg(F.count_if(F.col("plan_id") == CHURN).alias("churn_after_trial"))
    tot = subs.agg(F.countDistinct("customer_id").alias("n_total_customers"))
    return with_scalars(tot, n).select(
        "n_total_customers", "churn_after_trial",
        percent_text("churn_after_trial", "n_total_customers", 0).alias("churn_percentage"))


def plan_after_trial_rank(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """Second plan per customer (dense rank 2): count and percent of all customers."""
    second = nth_per(subs, "customer_id", "start_date", 2).join(plans, "plan_id")
    counts = second.groupBy("plan_id", "plan_name").agg(
        F.count(F.lit(1)).alias("n_customer_after_trial"))
    tot = subs.agg(F.countDistinct("customer_id").alias("__n"))
    out = with_scalars(counts, tot).select(
        "plan_id", "plan_name", "n_customer_after_trial",
        exact_ratio("n_customer_after_trial", "__n", 1, 100).alias("percentage"))
    return sort_like_sql(out, ("percentage", "desc"))


def plan_after_trial_lead(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """Next plan after each trial row (``lead``), counts and share of the total."""
    nxt = next_value(subs, "customer_id", ["start_date", "plan_id"], "plan_id", "next_plan_id")
    conv = nxt.where((F.col("plan_id") == TRIAL) & F.col("next_plan_id").isNotNull())
    counts = (conv.join(plans.withColumnRenamed("plan_id", "next_plan_id"), "next_plan_id")
              .groupBy("next_plan_id", "plan_name")
              .agg(F.count(F.lit(1)).alias("conversion_count")))
    return sort_like_sql(share_of_total(counts, "conversion_count", "percentage"),
                         ("percentage", "desc"))


def plan_breakdown_at(subs: DataFrame, plans: DataFrame, at: str = "2020-12-31") -> DataFrame:
    """Customers per current plan at a date, and share."""
    st = state_at(subs, "customer_id", "start_date", "plan_id",
                  F.col("start_date") <= F.lit(_d(at)), tiebreak=["plan_id"])
    counts = (st.join(plans, "plan_id").groupBy("plan_id", "plan_name")
              .agg(F.count(F.lit(1)).alias("n_customers")))
    return share_of_total(counts, "n_customers", "percentage")


def annual_upgrades(subs: DataFrame, year: int = 2020) -> DataFrame:
    lo, hi = _dt.date(year, 1, 1), _dt.date(year + 1, 1, 1)
    return (subs.where((F.col("plan_id") == ANNUAL) & (F.col("start_date") >= F.lit(lo))
                       & (F.col("start_date") < F.lit(hi)))
            .agg(F.countDistinct("customer_id").alias("n_customers")))


def days_to_annual_lead(subs: DataFrame) -> DataFrame:
    """Average days trial -> annual via ``lead`` over trial and annual rows only."""
    kept = subs.where(F.col("plan_id").isin(TRIAL, ANNUAL))
    nxt = next_value(kept, "customer_id", ["start_date", "plan_id"], "start_date", "annual_start")
    days = nxt.where(F.col("annual_start").isNotNull()).select(
        F.datediff("annual_start", "start_date").cast("decimal(18,0)").alias("d"))
    return days.agg(F.round(F.sum("d") / F.count("d").cast("decimal(20,0)"), 2)
                    .alias("avg_num_of_days_till_annual_sub"))


def _trial_to_annual_days(subs: DataFrame) -> DataFrame:
    trial = subs.where(F.col("plan_id") == TRIAL).groupBy("customer_id").agg(
        F.min("start_date").alias("trial_date"))
    annual = subs.where(F.col("plan_id") == ANNUAL).select("customer_id", "start_date")
    m = milestone_after_anchor(trial, annual, "customer_id", "trial_date", "start_date", "annual_date")
    return m.select("customer_id", F.datediff("annual_date", "trial_date").alias("days"))


def days_to_annual_join(subs: DataFrame) -> DataFrame:
    """Same average, pairing each customer's trial with its first later annual row."""
    d = _trial_to_annual_days(subs).select(F.col("days").cast("decimal(18,0)").alias("d"))
    return d.agg(F.round(F.sum("d") / F.count("d").cast("decimal(20,0)"), 2)
                 .alias("avg_day_till_annual_sub"))


def days_to_annual_buckets(subs: DataFrame, width: int = 30) -> DataFrame:
    """Customers per ``width``-day period of trial -> annual days (0-30, 31-60, ...)."""
    return (_trial_to_annual_days(subs).groupBy(day_bucket_label("days", width).alias("period"))
            .agg(F.count(F.lit(1)).alias("n_customers")))


def list_plans(plans: DataFrame) -> DataFrame:
    return plans.select("*")

