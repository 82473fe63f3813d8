"""Holdings to market value, exposure, limit breaches and daily P&L.

All operators keep ``as_of_date`` in their keys, so one plan values a single day (filter the
input, the filter reaches the scan) or the whole history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.exact import FACTOR_TYPE, UNIT_TYPE, money, product, ratio, rounded, unfit_factors
from holdfast.operators.keys import current_master, latest_per_key, latest_value

# Fixed values
ALL_PORTFOLIOS = "ALL"
EXPOSURE_CEILING_PCT = 100.01


class ValuationError(ValueError):
    """An integrity gate on the valued facts failed."""


def holdings_without_price(holdings: DataFrame, prices: DataFrame) -> DataFrame:
    return holdings.join(
        prices.select("investment_asset_id", F.col("price_date").alias("as_of_date")),
        ["investment_asset_id", "as_of_date"],
        "left_anti",
    )


def daily_holding(holdings: DataFrame, prices: DataFrame, assets: DataFrame) -> DataFrame:
    """Priced holdings with sector, issuer and market value; unmatched holdings drop out.

    Masters are landed append-only, so assets and prices are reduced to one row per key before
    the join and cannot multiply holdings. Units keep ten decimals, prices eight, the product all
    eighteen; a holding whose units or price do not fit has no market value, which a gate counts.
    """
    priced = latest_value(prices, ["investment_asset_id", "price_date"], "close_price").withColumnRenamed(
        "price_date", "as_of_date"
    )
    master = current_master(assets, "investment_asset_id").select(
        "investment_asset_id", "sector", "issuer_id"
    )
    return (
        holdings.join(priced, ["investment_asset_id", "as_of_date"])
        .join(master, "investment_asset_id")
        .withColumn("market_value", product(F.col("quantity"), F.col("close_price")))
        .select(
            "portfolio_id", "as_of_date", "investment_asset_id", "quantity", "close_price",
            "sector", "issuer_id", "market_value",
        )
    )


def portfolio_value(fact: DataFrame) -> DataFrame:
    return fact.groupBy("portfolio_id", "as_of_date").agg(
        F.round(F.sum("market_value"), 2).alias("total_market_value")
    )


def portfolio_value_in_base(
    fact: DataFrame, assets: DataFrame, rates: DataFrame
) -> DataFrame:
    """Portfolio value with each holding converted by its currency's rate on the date."""
    currency = current_master(assets, "investment_asset_id").select(
        "investment_asset_id", "currency"
    )
    rate = current_master(rates, "currency", "rate_date").select(
        F.col("rate_date").alias("as_of_date"),
        "currency",
        # Few integer digits, so that the product keeps all its decimals within 38 digits
        F.col("rate_to_base").cast("decimal(15,8)").alias("r"),
    )
    by_currency = (
        fact.join(currency, "investment_asset_id")
        .groupBy("portfolio_id", "as_of_date", "currency")
        .agg(F.sum("market_value").cast("decimal(22,6)").alias("v"))
    )
    return (
        by_currency.join(rate, ["as_of_date", "currency"])
        .groupBy("portfolio_id", "as_of_date")
        .agg(F.round(F.sum((F.col("v") * F.col("r")).cast("decimal(38,14)")), 2).alias("base_value"))
    )


def exposure(fact: DataFrame, key: str = "sector") -> DataFrame:
    """Market value and share per portfolio, date and key.

    The total is a window over the grouped rows, so holdings are aggregated once.
    """
    value = f"{key}_market_value"
    portfolio = Window.partitionBy("portfolio_id", "as_of_date")
    total = F.col("portfolio_total_market_value")
    return (
        fact.groupBy("portfolio_id", "as_of_date", key)
        .agg(F.sum("market_value").alias(value))
        .withColumn("portfolio_total_market_value", F.sum(value).over(portfolio))
        .withColumn("exposure_pct", rounded(ratio(F.col(value), total) * 100, 4))
        .filter(F.col("exposure_pct").isNotNull())
        .select("portfolio_id", key, value, "portfolio_total_market_value", "exposure_pct",
                "as_of_date")
    )


# Scope of a limit -> column of the fact it is measured on
SCOPE_COLUMNS = {"SECTOR": "sector", "ISSUER": "issuer_id"}


def exposure_by_scope(fact: DataFrame) -> DataFrame:
    """Exposure in long form (portfolio, date, scope_type, scope_value, exposure_pct).

    Each holding is offered to every scope in the map task and partially summed there, so the
    large input is shuffled once, as sums.
    """
    value = F.col("scope_market_value")
    total = F.sum("scope_market_value").over(
        Window.partitionBy("portfolio_id", "as_of_date", "scope_type")
    )
    scopes = F.array(
        *[
            F.struct(F.lit(scope).alias("scope_type"), F.col(column).alias("scope_value"))
            for scope, column in SCOPE_COLUMNS.items()
        ]
    )
    return (
        fact.select("portfolio_id", "as_of_date", "market_value", F.explode(scopes).alias("s"))
        .groupBy("portfolio_id", "as_of_date", "s.scope_type", "s.scope_value")
        .agg(F.sum("market_value").alias("scope_market_value"))
        .withColumn("exposure_pct", rounded(ratio(value, total) * 100, 4))
        .filter(F.col("exposure_pct").isNotNull())
        .drop("scope_market_value")
    )


def limit_breach(scoped: DataFrame, limits: DataFrame) -> DataFrame:
    """Exposures strictly above a limit that applies to the portfolio.

    "Own limit or limit for all" is an equality on a portfolio key after each exposure row is
    offered under its own id and under the marker for all: a plain equi-join, whatever the
    number of limits. Scopes that are not measured never match. Exposures meet the least limits of
    their scope first, one row per scope, so that only those above one of them are shuffled where the limits
    of single portfolios are many.
    """
    rules = current_master(limits, "limit_id").select(
        F.upper("scope_type").alias("scope_type"),
        "scope_value",
        F.coalesce("portfolio_id", F.lit(ALL_PORTFOLIOS)).alias("limit_portfolio"),
        "limit_id",
        "max_pct",
    )
    for_all = F.col("limit_portfolio") == ALL_PORTFOLIOS
    least = rules.groupBy("scope_type", "scope_value").agg(
        F.min(F.when(for_all, F.col("max_pct"))).alias("_least"),
        F.min(F.when(~for_all, F.col("max_pct"))).alias("_least_own"),
    )
    above = F.col("exposure_pct") > F.col("_least")
    own = F.col("portfolio_id")
    keys = F.array(
        F.when((F.col("exposure_pct") > F.col("_least_own")) | ((own == ALL_PORTFOLIOS) & above), own),
        F.when(above, F.lit(ALL_PORTFOLIOS)),
    )
    offered = (
        scoped.join(least, ["scope_type", "scope_value"])
        .withColumn("limit_portfolio", F.explode(F.array_compact(keys)))
        .drop("_least", "_least_own")
    )
    return (
        offered.join(rules, ["scope_type", "scope_value", "limit_portfolio"])
        .filter(F.col("exposure_pct") > F.col("max_pct"))
        .select(
            "portfolio_id",
            "scope_type",
            "scope_value",
            "exposure_pct",
            "max_pct",
            F.round(money(F.col("exposure_pct")) - money(F.col("max_pct")), 4)
            .cast("double")
            .alias("breach_by_pct"),
            "limit_id",
            "as_of_date",
        )
    )


def unmeasured_limits(limits: DataFrame) -> DataFrame:
    """Limits whose scope no exposure measures; they are reported, not silently skipped."""
    return (
        limits.filter(~F.upper("scope_type").isin(*SCOPE_COLUMNS))
        .groupBy(F.upper("scope_type").alias("scope_type"))
        .agg(F.count("*").alias("limits"))
    )


def daily_pnl(holdings: DataFrame, prices: DataFrame) -> DataFrame:
    """Mark-to-market P&L per portfolio and date against the previous price date.

    The price calendar holds one row per date, so its ordering window is small whatever the
    number of assets. Each price is offered twice, as the price of its date and as the
    previous price of the next date, which pairs both by one aggregation and no self-join.
    """
    prices = latest_value(prices, ["investment_asset_id", "price_date"], "close_price")
    dates = prices.select("price_date").distinct()
    calendar = dates.withColumn(
        "next_date", F.lead("price_date").over(Window.orderBy("price_date"))
    )
    offered = prices.join(calendar, "price_date").select(
        "investment_asset_id",
        F.explode(
            F.array(
                F.struct(
                    F.col("price_date").alias("as_of_date"),
                    F.col("close_price").try_cast(FACTOR_TYPE).alias("current"),
                    F.lit(None).cast("decimal(18,8)").alias("previous"),
                ),
                F.struct(
                    F.col("next_date").alias("as_of_date"),
                    F.lit(None).cast("decimal(18,8)").alias("current"),
                    F.col("close_price").try_cast(FACTOR_TYPE).alias("previous"),
                ),
            )
        ).alias("p"),
    )
    moves = (
        offered.groupBy("investment_asset_id", F.col("p.as_of_date").alias("as_of_date"))
        .agg(F.max("p.current").alias("current"), F.max("p.previous").alias("previous"))
        .filter(F.col("current").isNotNull() & F.col("previous").isNotNull())
        .select("investment_asset_id", "as_of_date", (F.col("current") - F.col("previous"))
                .cast("decimal(18,8)").alias("move"))
    )
    return (
        holdings.join(moves, ["investment_asset_id", "as_of_date"])
        .groupBy("portfolio_id", "as_of_date")
        .agg(F.round(F.sum(product(F.col("quantity"), F.col("move"))), 4).alias("daily_pnl"))
    )


def latest_valuation(df: DataFrame, date_column: str) -> DataFrame:
    """Newest row per asset; equal dates are told apart by the remaining columns."""
    rest = [c for c in df.columns if c not in ("investment_asset_id", date_column)]
    return latest_per_key(
        df, ["investment_asset_id"], [F.col(date_column).desc(), *[F.col(c).desc() for c in rest]]
    )


def top_holdings(fact: DataFrame, n: int = 15) -> DataFrame:
    return (
        fact.orderBy(
            F.col("market_value").desc(), "portfolio_id", "investment_asset_id", "as_of_date"
        )
        .limit(n)
        .select("portfolio_id", "investment_asset_id", "sector", "as_of_date",
                F.round("market_value", 2).alias("market_value"))
    )


def exposure_listing(exposures: DataFrame) -> DataFrame:
    return exposures.select("portfolio_id", "as_of_date", "sector", "exposure_pct").orderBy(
        "portfolio_id", "as_of_date", F.col("exposure_pct").desc(), "sector"
    )


def breach_listing(breaches: DataFrame) -> DataFrame:
    return breaches.orderBy(F.col("breach_by_pct").desc(), "portfolio_id", "as_of_date", "limit_id")


# ---- gates ------------------------------------------------------------------------


def gate_counts(holdings: DataFrame, prices: DataFrame, fact: DataFrame, exposures: DataFrame):
    """The three integrity counters: unpriced holdings, NULL values, impossible shares."""
    parts: Sequence[tuple[str, DataFrame]] = (
        ("holdings_without_price", holdings_without_price(holdings, prices)),
        ("null_market_value", fact.filter(F.col("market_value").isNull())),
        ("exposure_above_ceiling", exposures.filter(F.col("exposure_pct") > EXPOSURE_CEILING_PCT)),
    )
    counts = [
        df.agg(F.count("*").alias("failing_rows")).select(
            F.lit(name).alias("gate"), "failing_rows", (F.col("failing_rows") == 0).alias("passed")
        )
        for name, df in parts
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def factor_gate(holdings: DataFrame, prices: DataFrame) -> DataFrame:
    """(gate, failing_rows, passed): units and prices that lose decimals in a valuation, or that do not fit at all."""
    counted = unfit_factors(holdings, quantity=UNIT_TYPE).unionByName(unfit_factors(prices, close_price=FACTOR_TYPE))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("failing_rows")) for k in ("cut", "unfit")])
    return counted.select("column", F.explode(kinds).alias("k")).select(
        F.concat_ws("_", "column", "k.kind").alias("gate"), "k.failing_rows", (F.col("k.failing_rows") == 0).alias("passed")
    )


def enforce_gates(counts: DataFrame) -> None:
    failed = counts.filter("NOT passed").collect()
    if failed:
        raise ValuationError("; ".join(f"{r.gate}: {r.failing_rows} row(s)" for r in failed))
