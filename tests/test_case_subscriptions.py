"""Subscription lifecycle case: customers 1-13 of the literal rows (expected
values by hand) and a generated table checked against brute-force Python."""

import datetime as dt
import random
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import rows
from fixtures import PLANS, SUBSCRIPTIONS_1_13, frame

from casework.plans import subscriptions as q

D = dt.date.fromisoformat
NAMES = {0: "trial", 1: "basic monthly", 2: "pro monthly", 3: "pro annual", 4: "churn"}


@pytest.fixture(scope="module")
def small(spark):
    return frame(spark, "subscriptions", SUBSCRIPTIONS_1_13), frame(spark, "plans", PLANS)


def test_journey(small):
    subs, plans = small
    got = q.journey(subs, plans).collect()
    assert len(got) == 20
    assert {r.customer_id for r in got} == set(range(1, 9))


def test_counts_and_months(small):
    subs, plans = small
    assert q.customers_ever(subs).first()[0] == 13
    got = {r.month.month: r.n_trial_plans for r in q.trials_per_month(subs).collect()}
    assert got == {1: 2, 2: 1, 6: 1, 8: 2, 9: 3, 11: 1, 12: 3}
    assert rows(q.events_after(subs, plans)) == [("churn", 1), ("pro monthly", 1)]


def test_churn(small):
    subs, _ = small
    assert tuple(q.churn_rate(subs).first()) == (13, "23.1%")
    assert tuple(q.churn_after_trial(subs).first()) == (13, 1, "8%")


def test_plan_after_trial_both_forms(small):
    subs, plans = small
    by_rank = rows(q.plan_after_trial_rank(subs, plans), "plan_name", "n_customer_after_trial",
                   "percentage")
    assert by_rank == [("basic monthly", 9, Decimal("69.2")), ("churn", 1, Decimal("7.7")),
                       ("pro annual", 2, Decimal("15.4")), ("pro monthly", 1, Decimal("7.7"))]
    by_lead = rows(q.plan_after_trial_lead(subs, plans), "plan_name", "conversion_count",
                   "percentage")
    # unrounded, as coded
    assert by_lead == [("basic monthly", 9, 900 / 13), ("churn", 1, 100 / 13),
                       ("pro annual", 2, 200 / 13), ("pro monthly", 1, 100 / 13)]


def test_breakdown_at_year_end(small):
    subs, plans = small
    got = rows(q.plan_breakdown_at(subs, plans), "plan_name", "n_customers")
    assert got == [("basic monthly", 6), ("churn", 2), ("pro annual", 2), ("pro monthly", 3)]


def test_annual(small):
    subs, _ = small
    assert q.annual_upgrades(subs).first()[0] == 2
    assert q.days_to_annual_lead(subs).first()[0] == Decimal("7.00")
    assert q.days_to_annual_join(subs).first()[0] == Decimal("7.00")
    assert rows(q.days_to_annual_buckets(subs)) == [("0-30", 2)]


# ------------------------------------------------------------ generated table

def _generate(n_customers=400, seed=7):
    """Trial first, then up to three plan changes on later days, at most one
    annual plan, churn ends the path (the properties of the literal table)."""
    rnd = random.Random(seed)
    out = []
    for c in range(1, n_customers + 1):
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(366))
        out.append((c, 0, day))
        plan, day = 0, day + dt.timedelta(days=7)
        while True:
            options = {0: [1, 2, 3, 4], 1: [2, 3, 4, None], 2: [3, 4, None], 3: [4, None]}[plan]
            nxt = rnd.choice(options)
            if nxt is None:
                break
            out.append((c, nxt, day))
            if nxt == 4:
                break
            plan, day = nxt, day + dt.timedelta(days=rnd.randrange(1, 200))
    return out


def _r(x, places):
    return Decimal(x).quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


@pytest.fixture(scope="module")
def gen(spark):
    data = _generate()
    return data, frame(spark, "subscriptions", data), frame(spark, "plans", PLANS)


def test_generated_against_python(gen):
    data, subs, plans = gen
    by_c = {}
    for c, p, d in sorted(data, key=lambda r: (r[0], r[2])):
        by_c.setdefault(c, []).append((d, p))
    n = len(by_c)
    churned = sum(any(p == 4 for _, p in v) for v in by_c.values())
    assert q.churn_rate(subs).first().churn == f"{_r(Decimal(100 * churned) / n, 1)}%"
    second = Counter(v[1][1] for v in by_c.values() if len(v) > 1)
    got = {r.plan_id: r.n_customer_after_trial for r in q.plan_after_trial_rank(subs, plans).collect()}
    assert got == dict(second)
    lead = {r.next_plan_id: r.conversion_count for r in q.plan_after_trial_lead(subs, plans).collect()}
    assert lead == dict(second)
    cut = D("2020-12-31")
    state = Counter([p for d, p in v if d <= cut][-1] for v in by_c.values() if v[0][0] <= cut)
    got = {r.plan_id: r.n_customers for r in q.plan_breakdown_at(subs, plans).collect()}
    assert got == dict(state)
    days = [next(d for d, p in v if p == 3) - v[0][0] for v in by_c.values() if any(p == 3 for _, p in v)]
    days = [x.days for x in days]
    want = _r(Decimal(sum(days)) / len(days), 2)
    assert q.days_to_annual_join(subs).first()[0] == want
    assert q.days_to_annual_lead(subs).first()[0] == want
    buckets = Counter(("0" if max(1, -(-d // 30)) == 1 else str((max(1, -(-d // 30)) - 1) * 30 + 1))
                      + "-" + str(max(1, -(-d // 30)) * 30) for d in days)
    assert dict(rows(q.days_to_annual_buckets(subs))) == dict(buckets)
    assert q.annual_upgrades(subs).first()[0] == len(
        {c for c, p, d in data if p == 3 and d.year == 2020})
