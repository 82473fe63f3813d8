"""Golden numbers of a small hand-made market: values, shares, breaches, P&L, quarantine."""

import pytest
from pyspark.sql import functions as F

from holdfast.operators import quality, valuation

DAY, BEFORE = "2026-05-29", "2026-05-28"

# Asset, issuer, sector and base price of the sample market
ASSETS = [
    ("AE_ENBD", "ISS_ENBD", "Banking", 22.0),
    ("AE_FAB", "ISS_FAB", "Banking", 13.5),
    ("AE_ADCB", "ISS_ADCB", "Banking", 9.0),
    ("AE_DIB_SUK", "ISS_DIB", "Banking", 100.0),
    ("AE_ADNOCGAS", "ISS_ADNOC", "Energy", 3.4),
    ("AE_EAND", "ISS_EAND", "Telecom", 17.0),
    ("AE_EMAAR", "ISS_EMAAR", "RealEstate", 8.2),
    ("AE_ALDAR", "ISS_ALDAR", "RealEstate", 6.5),
    ("US_AAPL", "ISS_AAPL", "Technology", 190.0),
    ("US_MSFT", "ISS_MSFT", "Technology", 420.0),
]
# Quantities held on both days
HELD = {
    "GULF_EQ": {"AE_ENBD": 100000, "AE_FAB": 80000, "AE_ADCB": 60000, "AE_DIB_SUK": 5000,
                "AE_ADNOCGAS": 40000, "AE_EMAAR": 30000, "AE_ALDAR": 20000},
    "GLOBAL_BAL": {"US_AAPL": 5000, "US_MSFT": 4000, "AE_ENBD": 10000, "AE_ADNOCGAS": 8000,
                   "AE_EAND": 15000},
    "INCOME_FI": {"AE_DIB_SUK": 50000, "AE_ENBD": 5000},
}
LIMITS = [
    ("LIM_001", "SECTOR", "Banking", "GULF_EQ", 20.0),
    ("LIM_002", "SECTOR", "Technology", "GLOBAL_BAL", 40.0),
    ("LIM_003", "ISSUER", "ISS_ENBD", "ALL", 25.0),
    ("LIM_004", "COUNTERPARTY", "CP_005", "ALL", 15.0),
    ("LIM_005", "SECTOR", "Banking", "ALL", 35.0),
]


@pytest.fixture(scope="module")
def sample(spark):
    assets = spark.createDataFrame(
        [(a, i, s) for a, i, s, _ in ASSETS], "investment_asset_id string, issuer_id string, sector string"
    )
    # The price grows by 0.2% of the base per day; the sixth day carries the base itself
    prices = spark.createDataFrame(
        [(day, a, round(base * (1 + 0.002 * step), 4))
         for day, step in ((BEFORE, 5), (DAY, 6)) for a, _, _, base in ASSETS],
        "price_date string, investment_asset_id string, close_price double",
    )
    holdings = spark.createDataFrame(
        [(p, day, a, float(q)) for day in (BEFORE, DAY) for p, h in HELD.items() for a, q in h.items()],
        "portfolio_id string, as_of_date string, investment_asset_id string, quantity double",
    )
    limits = spark.createDataFrame(
        LIMITS, "limit_id string, scope_type string, scope_value string, portfolio_id string, max_pct double"
    )
    return holdings, prices, assets, limits


def _today(df):
    return df.filter(F.col("as_of_date") == DAY)


def test_portfolio_values(sample):
    holdings, prices, assets, _ = sample
    fact = valuation.daily_holding(holdings, prices, assets)
    got = {r.portfolio_id: float(r.total_market_value)
           for r in _today(valuation.portfolio_value(fact)).collect()}
    assert got == {"GULF_EQ": 4889984.0, "GLOBAL_BAL": 3169786.4, "INCOME_FI": 5171320.0}


def test_sector_shares(sample):
    holdings, prices, assets, _ = sample
    shares = valuation.exposure(valuation.daily_holding(holdings, prices, assets))
    got = {(r.portfolio_id, r.sector): r.exposure_pct for r in _today(shares).collect()}
    assert got == {
        ("GULF_EQ", "Banking"): 89.404, ("GULF_EQ", "RealEstate"): 7.7815,
        ("GULF_EQ", "Energy"): 2.8146, ("GLOBAL_BAL", "Technology"): 83.9665,
        ("GLOBAL_BAL", "Telecom"): 8.1412, ("GLOBAL_BAL", "Banking"): 7.0238,
        ("GLOBAL_BAL", "Energy"): 0.8684, ("INCOME_FI", "Banking"): 100.0,
    }


def test_breaches_of_both_scopes(sample):
    holdings, prices, assets, limits = sample
    scoped = valuation.exposure_by_scope(valuation.daily_holding(holdings, prices, assets))
    got = {(r.portfolio_id, r.limit_id): r.breach_by_pct
           for r in _today(valuation.limit_breach(scoped, limits)).collect()}
    assert got == {
        ("GULF_EQ", "LIM_001"): 69.404, ("GULF_EQ", "LIM_005"): 54.404,
        ("GULF_EQ", "LIM_003"): 20.5298, ("GLOBAL_BAL", "LIM_002"): 43.9665,
        ("INCOME_FI", "LIM_005"): 65.0,
    }
    assert [tuple(r) for r in valuation.unmeasured_limits(limits).collect()] == [("COUNTERPARTY", 1)]


def test_limit_for_all_may_be_null_or_lower_case(sample, spark):
    holdings, prices, assets, _ = sample
    limits = spark.createDataFrame(
        [("L", "sector", "Banking", None, 35.0)],
        "limit_id string, scope_type string, scope_value string, portfolio_id string, max_pct double",
    )
    scoped = valuation.exposure_by_scope(valuation.daily_holding(holdings, prices, assets))
    got = {r.portfolio_id for r in _today(valuation.limit_breach(scoped, limits)).collect()}
    assert got == {"GULF_EQ", "INCOME_FI"}


def test_daily_pnl(sample):
    holdings, prices, _, _ = sample
    got = {r.portfolio_id: float(r.daily_pnl)
           for r in valuation.daily_pnl(holdings, prices).collect() if r.as_of_date == DAY}
    assert got == {"GULF_EQ": 9664.0, "GLOBAL_BAL": 6264.4, "INCOME_FI": 10220.0}


def test_asset_landed_twice_does_not_double_holdings(sample):
    holdings, prices, assets, _ = sample
    once = valuation.daily_holding(holdings, prices, assets).count()
    assert valuation.daily_holding(holdings, prices, assets.union(assets)).count() == once


def test_zero_total_has_no_share(spark):
    fact = spark.createDataFrame(
        [("P", DAY, "A", "S", "I", 0.0)],
        "portfolio_id string, as_of_date string, investment_asset_id string, sector string, "
        "issuer_id string, market_value double",
    )
    assert valuation.exposure(fact).count() == 0
    assert valuation.exposure_by_scope(fact).count() == 0


def test_gates(sample):
    holdings, prices, assets, _ = sample
    fact = valuation.daily_holding(holdings, prices, assets)
    shares = valuation.exposure(fact)
    valuation.enforce_gates(valuation.gate_counts(holdings, prices, fact, shares))
    few = prices.filter("investment_asset_id <> 'AE_FAB'")
    with pytest.raises(valuation.ValuationError, match="holdings_without_price: 2"):
        valuation.enforce_gates(valuation.gate_counts(holdings, few, fact, shares))


def test_transactions_of_the_sample(sample, spark):
    """17 ids of 18 rows; three of them break a rule: 17.6471%."""
    _, _, assets, _ = sample
    rows = [(f"T{i:04d}", p, a, "BUY", float(q), 1.0, i)
            for i, (p, a, q) in enumerate(
                ((p, a, q) for p, h in HELD.items() for a, q in h.items()), start=1)]
    rows += [("T9001", "GULF_EQ", "XX_UNKNOWN", "BUY", 1000.0, 5.0, 1),
             ("T9002", "NO_SUCH_PF", "AE_ENBD", "BUY", 1000.0, 22.0, 1),
             ("T0001", "GULF_EQ", "AE_ENBD", "BUY", 100000.0, 22.0, 1),
             ("T9003", "INCOME_FI", "AE_DIB_SUK", "SELL", -500.0, 100.0, 1)]
    landed = spark.createDataFrame(
        rows, "transaction_id string, portfolio_id string, investment_asset_id string, "
        "transaction_type string, quantity double, price double, _ingest_ts int")
    portfolios = spark.createDataFrame([(p,) for p in HELD], "portfolio_id string")
    conformed = quality.conform(landed, portfolios, assets).cache()
    assert {r.transaction_id: r.dq_reason for r in conformed.filter("dq_reason IS NOT NULL").collect()} == {
        "T9001": "bad_asset", "T9002": "bad_portfolio", "T9003": "bad_quantity"}
    rate = quality.quarantine_rate(conformed, F.lit("run")).first()
    assert (rate.valid_rows, rate.quarantined_rows, rate.rate_pct) == (14, 3, 17.6471)
    assert conformed.filter("transaction_id = 'T0001'").first().price == 22.0
