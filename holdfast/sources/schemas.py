"""Feed contracts: column types, file format and folder of each of the 14 feeds."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "double": DoubleType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "boolean": BooleanType(),
}


def struct_of(columns: str) -> StructType:
    """``"a string, b double"`` as a schema, without a running session."""
    pairs = [column.split() for column in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind], True) for name, kind in pairs])


# Feed columns, in file order
SCHEMAS: dict[str, StructType] = {
    name: struct_of(columns)
    for name, columns in {
        "portfolio_master": "portfolio_id string, portfolio_name string, manager string, "
        "mandate string, base_currency string",
        "investment_asset_master": "investment_asset_id string, name string, asset_type string, "
        "isin string, ticker string, internal_investment_code string, issuer_id string, "
        "sector string, country string, currency string",
        "issuer_master": "issuer_id string, issuer_name string, country string, "
        "credit_rating string",
        "counterparty_master": "counterparty_id string, name string, type string, "
        "risk_category string, country string",
        "investment_limits": "limit_id string, scope_type string, scope_value string, "
        "portfolio_id string, max_pct double",
        "benchmark_or_target_allocation": "benchmark_id string, sector string, "
        "target_weight_pct double",
        "currency_rates": "rate_date string, currency string, rate_to_base double",
        "investment_transactions": "transaction_id string, transaction_date string, "
        "portfolio_id string, investment_asset_id string, transaction_type string, "
        "quantity double, price double, counterparty_id string",
        "cashflows": "cashflow_id string, portfolio_id string, cashflow_date string, "
        "type string, amount double, currency string",
        "corporate_actions": "action_id string, investment_asset_id string, "
        "action_type string, ex_date string, value double",
        "listed_market_prices": "price_date string, investment_asset_id string, "
        "close_price double",
        "investment_holdings_snapshot": "portfolio_id string, as_of_date string, "
        "investment_asset_id string, quantity double",
        "private_valuation_snapshot": "investment_asset_id string, valuation_date string, "
        "fair_value double, currency string",
        "fund_nav_snapshot": "investment_asset_id string, nav_date string, "
        "nav_per_unit double, currency string",
    }.items()
}

_JSON_FEEDS = frozenset({"investment_transactions", "cashflows", "corporate_actions"})
_VALUATION_FEEDS = frozenset(
    {
        "listed_market_prices",
        "investment_holdings_snapshot",
        "private_valuation_snapshot",
        "fund_nav_snapshot",
    }
)

FORMATS = {name: "json" if name in _JSON_FEEDS else "csv" for name in SCHEMAS}
CATEGORY = {
    name: "transaction_data"
    if name in _JSON_FEEDS
    else "valuation_data"
    if name in _VALUATION_FEEDS
    else "reference_data"
    for name in SCHEMAS
}

AUDIT_COLUMNS = ("_ingest_ts", "_source_file", "_batch_id")
RESCUE_COLUMN = "_rescued_data"

# One row per executed check, shared by data-quality and reconciliation controls.
RESULT_SCHEMA = struct_of(
    "check_timestamp timestamp, check_name string, source_table string, business_date date, "
    "pipeline_run_id string, job_run_id string, metric_value double, threshold double, "
    "passed boolean"
)


def missing_columns(actual: list[str], expected: list[str]) -> list[str]:
    """Expected columns that are absent, in expected order."""
    present = set(actual)
    return [name for name in expected if name not in present]


def validate_columns(actual: list[str], expected: list[str]) -> bool:
    missing = missing_columns(actual, expected)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return True
