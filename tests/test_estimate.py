"""Month-end estimate: golden cases, closed form vs definition, properties."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tillroll.operators import estimate as E


def _series(spark, rows, market="m"):
    return spark.createDataFrame([(market, d, None if a is None else float(a)) for d, a in rows],
                                 "market string, date date, amount double")


def _days(start, end, amount=100.0):
    d, out = start, []
    while d <= end:
        out.append((d, amount))
        d += dt.timedelta(days=1)
    return out


def _avg(spark, values, cutoff=dt.date(2025, 3, 29)):
    """Weekday average of one weekday whose newest-first amounts are ``values``."""
    days = [(cutoff - dt.timedelta(days=7 * (i + 1)), v) for i, v in enumerate(values)]
    day = E.daily_cents(_series(spark, days))
    prof = E.weekday_average(E.recent_weekdays(day, cutoff)).collect()
    return prof[0]["avg_amount"] if prof else 0.0


@pytest.mark.parametrize("values,expected", [
    ([100, 200, 300, 400], 250.00),                       # G1
    ([100, 200, 300, 400, 500], 300.00),                  # G2
    ([100, 200, 300, 400, 500, 600], 350.00),             # G3
    ([100, 200, 300, 400, 500, 600, 700], 406.25),        # G4 (p4 = 575)
    ([100, 200, 300], 0.00),                              # G5
    ([100] * 9, 106.25),                                  # flat series, 5 values over 4
])
def test_weekday_average_golden(spark, values, expected):
    assert _avg(spark, values) == expected


def test_month_end_mid_month_g6(spark):
    tx = _series(spark, _days(dt.date(2025, 2, 1), dt.date(2025, 3, 28)))
    r = E.estimate(tx, "2025-03-29").collect()[0]
    assert r["report_date"] == dt.date(2025, 3, 28)
    assert (r["actual_sales"], r["estimated_sales"], r["total_estimation"]) == (2800.0, 318.75, 3118.75)


def test_month_end_on_first_g7(spark):
    tx = _series(spark, _days(dt.date(2025, 2, 1), dt.date(2025, 3, 31)))
    r = E.estimate(tx, "2025-04-01").collect()[0]
    assert r["report_date"] == dt.date(2025, 3, 31)
    assert (r["actual_sales"], r["estimated_sales"], r["total_estimation"]) == (3100.0, 0.0, 3100.0)


def _definition(values):
    """p1..p4 exactly as defined (floats), mean, rounded half-even to cents."""
    r = values
    n = len(r)
    if n < 4:
        return 0
    pts = [sum(r[0:4]) / 4]
    if n >= 5:
        pts.append((r[1] + r[2] + r[3] + r[4]) / 4)
    if n >= 6:
        pts.append((r[2] + r[3] + r[4] + r[5]) / 4)
    if n >= 7:
        pts.append((r[3] + r[4] + r[5] + r[6] + r[0]) / 4)
    from fractions import Fraction
    exact = sum(Fraction(p).limit_denominator(10**6) for p in pts) / len(pts)
    return round(exact)           # Python rounds a Fraction half to even


def test_closed_form_matches_definition(spark):
    rng = random.Random(7)
    rows = []
    expected = {}
    cutoff = dt.date(2025, 3, 29)
    for k in range(60):
        n = k % 11
        cents = [rng.randint(-5000, 900000) for _ in range(n)]
        expected[f"m{k}"] = _definition(cents)
        for i, c in enumerate(cents):
            rows.append((f"m{k}", cutoff - dt.timedelta(days=7 * (i + 1)), c / 100.0))
    df = spark.createDataFrame(rows, "market string, date date, amount double")
    prof = {r["market"]: r["avg_cents"] for r in
            E.weekday_average(E.recent_weekdays(E.daily_cents(df), cutoff)).collect()}
    for m, want in expected.items():
        assert prof.get(m, 0) == want, m


def test_bias_corrected_divides_p4_by_five(spark):
    cutoff = dt.date(2025, 3, 29)
    days = [(cutoff - dt.timedelta(days=7 * (i + 1)), 100.0) for i in range(7)]
    day = E.daily_cents(_series(spark, days))
    prof = E.weekday_average(E.recent_weekdays(day, cutoff), bias_corrected=True).collect()
    assert prof[0]["avg_amount"] == 100.0


def test_market_without_rows_in_month_keeps_a_row(spark):
    a = _days(dt.date(2025, 3, 1), dt.date(2025, 3, 20))
    tx = _series(spark, a, "a").unionByName(_series(spark, [(None, 5.0)], "b")).unionByName(
        _series(spark, [(dt.date(2025, 5, 1), 7.0)], "c"))
    out = {r["market"]: r for r in E.estimate(tx, "2025-03-15").collect()}
    assert set(out) == {"a", "b", "c"}
    assert out["b"]["actual_sales"] == 0.0 and out["c"]["total_estimation"] == 0.0


def test_total_is_actual_plus_estimate(spark):
    tx = _series(spark, [(dt.date(2025, 1, 1) + dt.timedelta(days=i), 10.01 * (i % 13)) for i in range(120)])
    for r in E.estimate(tx, "2025-04-10").collect():
        assert round(r["actual_sales"] + r["estimated_sales"], 2) == r["total_estimation"]


def test_no_type_filter_refunds_count(spark):
    tx = _series(spark, [(dt.date(2025, 3, 2), 50.0), (dt.date(2025, 3, 2), -20.0)])
    assert E.mtd_actual(tx, "2025-03-10").collect()[0]["actual_sales"] == 30.0


def test_estimate_plan_shuffles_day_totals_once(spark):
    from tillroll.plans.bindings import orders_tx
    from conftest import SF_SMALL
    df = E.estimate(orders_tx(spark, SF_SMALL), "1998-06-16")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # partial agg over transactions, then one exchange of day totals by market
    assert plan.count("Exchange hashpartitioning") == 2, plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
