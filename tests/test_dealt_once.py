"""Breaches and their second formulation shuffle the holdings of a day once, and only what is above a limit after that."""

from collections import Counter

from holdfast.operators import valuation
from holdfast.plans import controls as control_plans
from holdfast.plans import valuation as valuation_plans
from holdfast.sources import market


def test_both_formulations_sum_where_the_holdings_lie(spark, folder):
    compared = control_plans.reconcile_breaches(spark, folder)
    plan = compared._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not [line for line in plan if "Expand" in line]
    # By portfolio: the deal of each formulation, and the keys that are compared; before, sums and totals of each too
    shuffles = [line for line in plan if "Exchange hashpartitioning(portfolio_id" in line]
    assert len([line for line in shuffles if "limit_id" not in line]) == len([line for line in shuffles if "REPARTITION" in line]) == 2
    counts = compared.first()
    rows = valuation_plans.breaches(spark, folder).select("portfolio_id", "as_of_date", "scope_type", "scope_value", "limit_id")
    assert (counts.in_both, counts.only_left, counts.only_right) == (rows.distinct().count(), 0, 0)


SCOPED = [
    ("P1", "2024-01-31", "SECTOR", "A", 50.0), ("P1", "2024-01-31", "SECTOR", "B", 30.0), ("P2", "2024-01-31", "SECTOR", "A", 20.0),
    ("P2", "2024-01-31", "ISSUER", "A", 90.0), ("ALL", "2024-01-31", "SECTOR", "A", 60.0), (None, "2024-01-31", "SECTOR", "A", 70.0),
    ("P3", None, "SECTOR", "C", 10.0), ("P3", "2024-01-31", "SECTOR", None, 99.0), ("P1", "2024-01-31", "SECTOR", "A", 50.0),
]
LIMITS = [
    ("L1", "sector", "A", "ALL", 40.0), ("L2", "SECTOR", "A", None, 55.0), ("L3", "SECTOR", "A", "P2", 10.0), ("L4", "SECTOR", "B", "P1", 30.0),
    ("L5", "ISSUER", "A", "P1", 5.0), ("L6", "SECTOR", "C", "ALL", None), ("L7", "SECTOR", "C", "P3", 5.0), ("L8", "REGION", "A", "ALL", 1.0),
    ("L9", "SECTOR", None, "ALL", 1.0),
]


def test_only_exposures_above_a_limit_of_their_scope_meet_the_limits_of_portfolios(spark):
    scoped = spark.createDataFrame(SCOPED, "portfolio_id string, as_of_date string, scope_type string, scope_value string, exposure_pct double")
    limits = spark.createDataFrame(LIMITS, "limit_id string, scope_type string, scope_value string, portfolio_id string, max_pct double")
    found = valuation.limit_breach(scoped, limits)
    want = Counter(
        (p, scope, value, limit)
        for p, _, scope, value, pct in SCOPED for limit, s, v, of, most in LIMITS
        for key in (p, "ALL")
        if scope == s.upper() and value is not None and value == v and key is not None and key == (of or "ALL") and most is not None and pct > most
    )
    assert Counter((r.portfolio_id, r.scope_type, r.scope_value, r.limit_id) for r in found.collect()) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    generate = next(line for line in plan.splitlines() if "Generate explode" in line)
    assert "_least" in generate


def test_second_formulation_of_given_shares(spark):
    shares = spark.createDataFrame([r[:5] for r in SCOPED], "portfolio_id string, as_of_date string, scope_type string, scope_value string, pct double")
    limits = spark.createDataFrame(LIMITS, "limit_id string, scope_type string, scope_value string, portfolio_id string, max_pct double")
    keys = ["portfolio_id", "as_of_date", "scope_type", "scope_value", "limit_id"]
    found = spark.sql(control_plans._RECOMPUTE, shares=shares, limits=limits)
    first = valuation.limit_breach(shares.withColumnRenamed("pct", "exposure_pct"), limits).select(*keys)
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in first.collect()}


def test_the_dealt_fact_is_the_fact(spark, folder):
    dealt = market.named(valuation_plans.dealt_fact(spark, folder))
    whole = valuation_plans.fact(spark, folder).select(*dealt.columns)
    assert dealt.exceptAll(whole).isEmpty() and whole.exceptAll(dealt).isEmpty()
