"""Scaled feeds: entity x calendar grids from deterministic column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Sizes of the presets and first day
START = "2024-06-01"
PRESETS = {
    "dev": dict(assets=300, days=180, portfolios=5, holdings=40, txn_per_day=30,
                currencies=8, private=20, funds=10, months=6),
    "demo": dict(assets=800, days=504, portfolios=10, holdings=40, txn_per_day=100,
                 currencies=10, private=50, funds=30, months=12),
    "realistic": dict(assets=10000, days=730, portfolios=50, holdings=100, txn_per_day=250,
                      currencies=20, private=500, funds=300, months=24),
    "perftest": dict(assets=10000, days=756, portfolios=200, holdings=200, txn_per_day=80000,
                     currencies=20, private=500, funds=300, months=24),
}


def _opened(rows: DataFrame, length: int, step: str) -> DataFrame:
    """Every row once per calendar step."""
    return rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(length - 1))).alias(step))


def _draw(salt: int, *columns: str) -> Column:
    """A number in [0, 1) that depends on the columns and the salt alone."""
    bits = F.pmod(F.xxhash64(*[F.col(c) for c in columns], F.lit(salt)), F.lit(1 << 20))
    return bits / F.lit(float(1 << 20))


def _label(kind: str, number: Column) -> Column:
    return F.format_string(f"{kind}-%07d", number.cast("bigint"))


def _date(step: str, unit: str) -> Column:
    start = F.lit(START).cast("date")
    moved = F.date_add(start, F.col(step)) if unit == "day" else F.add_months(start, F.col(step))
    return moved.cast("string")


def _skewed(salt: int, n: int, *columns: str) -> Column:
    """Index below ``n`` of which the low ones are drawn far more often than the high ones."""
    return F.floor(F.pow(_draw(salt, *columns), 3) * n)


def _level(salt: int, *columns: str) -> Column:
    """A positive level spread over three powers of ten."""
    return F.pow(F.lit(10.0), _draw(salt, *columns) * 3)


def generate_feeds(spark: SparkSession, preset: str = "dev") -> dict[str, DataFrame]:
    """The seven large feeds of a preset, lazily; write them with a sink to use them.

    Values are drawn from hashes of their keys: levels over three powers of ten that drift and
    waver from day to day, a few portfolios and assets with most of the transactions, and about
    one transaction in a thousand with an unknown asset or a negative quantity.
    """
    size = PRESETS[preset]
    entity = lambda n: spark.range(n).withColumnRenamed("id", "e")
    wavering = lambda salt, step: (
        _level(salt, "e") * (1 + F.col(step) * (_draw(salt + 1, "e") - 0.4) / 1000)
        * (0.98 + 0.04 * _draw(salt + 2, "e", step))
    )
    prices = _opened(entity(size["assets"]), size["days"], "t").select(
        _date("t", "day").alias("price_date"), _label("AST", F.col("e")).alias("investment_asset_id"),
        F.round(wavering(10, "t"), 4).alias("close_price"),
    )
    # Slot s of a portfolio holds the asset a fixed stride further: no asset twice in a portfolio
    slots = _opened(entity(size["portfolios"]), size["holdings"], "s").withColumn(
        "a", F.pmod(F.floor(_draw(20, "e") * size["assets"]) + F.col("s"), F.lit(size["assets"]))
    )
    holdings = _opened(slots, size["days"], "t").select(
        _label("PFL", F.col("e")).alias("portfolio_id"), _date("t", "day").alias("as_of_date"),
        _label("AST", F.col("a")).alias("investment_asset_id"),
        F.round(_level(21, "e", "s") * (1 + F.floor(_draw(22, "e", "s", "t") * 3)), 2).alias("quantity"),
    )
    odd = _draw(30, "e")
    transactions = entity(size["txn_per_day"] * size["days"]).select(
        _label("TRX", F.col("e")).alias("transaction_id"),
        F.date_add(F.lit(START).cast("date"), F.floor(_draw(31, "e") * size["days"]).cast("int"))
        .cast("string").alias("transaction_date"),
        _label("PFL", _skewed(32, size["portfolios"], "e")).alias("portfolio_id"),
        F.when(odd < 0.0005, F.lit("AST-UNKNOWN"))
        .otherwise(_label("AST", _skewed(33, size["assets"], "e"))).alias("investment_asset_id"),
        F.when(_draw(34, "e") < 0.55, "BUY").otherwise("SELL").alias("transaction_type"),
        F.round(_level(35, "e") * F.when(odd > 0.9995, -1).otherwise(1), 2).alias("quantity"),
        F.round(_level(36, "e"), 4).alias("price"),
        _label("CPY", _skewed(37, 12, "e")).alias("counterparty_id"),
    )
    cashflows = _opened(entity(size["portfolios"]), size["days"], "t").select(
        _label("CSH", F.col("e") * size["days"] + F.col("t")).alias("cashflow_id"),
        _label("PFL", F.col("e")).alias("portfolio_id"), _date("t", "day").alias("cashflow_date"),
        F.when(_draw(40, "e", "t") < 0.6, "DIVIDEND").when(_draw(41, "e", "t") < 0.5, "FEE")
        .otherwise("DISTRIBUTION").alias("type"),
        F.round(_level(42, "e", "t") * 100, 2).alias("amount"), F.lit("USD").alias("currency"),
    )
    currency_rates = _opened(entity(size["currencies"]), size["days"], "t").select(
        _date("t", "day").alias("rate_date"), _label("CUR", F.col("e")).alias("currency"),
        F.round(wavering(50, "t") / 100, 4).alias("rate_to_base"),
    )
    private = _opened(entity(size["private"]), size["months"], "t").select(
        _label("PRV", F.col("e")).alias("investment_asset_id"), _date("t", "month").alias("valuation_date"),
        F.round(wavering(60, "t") * 1e6, 2).alias("fair_value"), F.lit("USD").alias("currency"),
    )
    navs = _opened(entity(size["funds"]), size["months"], "t").select(
        _label("FND", F.col("e")).alias("investment_asset_id"), _date("t", "month").alias("nav_date"),
        F.round(wavering(70, "t"), 4).alias("nav_per_unit"), F.lit("USD").alias("currency"),
    )
    return {
        "listed_market_prices": prices,
        "investment_holdings_snapshot": holdings,
        "investment_transactions": transactions,
        "cashflows": cashflows,
        "currency_rates": currency_rates,
        "private_valuation_snapshot": private,
        "fund_nav_snapshot": navs,
    }


def entity_calendar_grid(
    activity: DataFrame, entity: str, date_column: str, value: Callable[[Column], Column]
) -> DataFrame:
    """Every month from an entity's first to its last activity, with ``value(step)``.

    The span is one aggregate per entity; the calendar is opened from it row by row.
    """
    month = F.trunc(F.col(date_column).cast("date"), "month")
    span = activity.groupBy(entity).agg(F.min(month).alias("a"), F.max(month).alias("z"))
    steps = F.sequence("a", "z", F.expr("INTERVAL 1 MONTH"))
    return span.select(entity, F.posexplode(steps).alias("step", "grid_month")).withColumn(
        "grid_value", value(F.col("step"))
    )
