"""Valuation queries: market value, exposure, breaches, P&L and their listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.operators import governance, valuation
from holdfast.plans.registry import query
from holdfast.session import work_dir
from holdfast.sources import market, sinks


def fact_rows(spark, folder, days=None):
    """:func:`fact` by numbers and days."""
    holdings, prices = market.holding_rows(spark, folder), market.price_rows(spark, folder)
    if days is not None:
        holdings, prices = holdings.filter(F.col("as_of_date").between(*days)), prices.filter(F.col("price_date").between(*days))
    return valuation.daily_holding(holdings, prices, market.asset_rows(spark, folder))


def fact(spark, folder, days=None):
    """Valued holdings, of all days or from the first to the last of ``days``; joined by numbers and days, and named afterwards."""
    return market.named(fact_rows(spark, folder, days))


def dealt_fact(spark, folder):
    """What exposures are made of, by numbers and days, the holdings of a portfolio and date in one task.

    One shuffle then serves all sums and totals, of every formulation that starts from this same table. A task
    gets at most a holding per asset for each of its portfolios and dates. The number of tasks is named, as a task
    sums and sorts several times what it reads and Spark would make them larger.
    """
    columns = ["portfolio_id", "as_of_date", "sector", "issuer_id", "market_value"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return fact_rows(spark, folder).select(*columns).repartition(tasks, "portfolio_id", "as_of_date")


def breaches(spark, folder, days=None):
    valued = fact(spark, folder) if days is None else fact(spark, folder, days)
    return valuation.limit_breach(valuation.exposure_by_scope(valued), market.limits(spark, folder))


def newest_breaches(spark, folder):
    """All breaches of the last date that has any.

    A day's breaches depend on that day alone, so days are valued from the newest back, each time eight times as many,
    until one of them has a breach; in the worst case that is every day once.
    """
    held = market.holding_rows(spark, folder).select("as_of_date").distinct().filter("as_of_date IS NOT NULL").collect()
    days, at, width = sorted((r[0] for r in held), reverse=True), 0, 1
    while at < len(days):
        some = days[at : at + width]
        found = sinks.written_once(breaches(spark, folder, (some[-1], some[0])), work_dir(spark, "newest-breaches"))
        newest = found.agg(F.max("as_of_date")).first()[0]
        if newest is not None:
            return found.filter(F.col("as_of_date") == newest)
        at, width = at + width, 8 * width
    return breaches(spark, folder).filter("false")


@query(
    "daily_holding",
    """SELECT portfolio_id, as_of_date, investment_asset_id, quantity, close_price, sector,
              issuer_id, market_value::DOUBLE AS market_value FROM fact""",
)
def daily_holding(spark, folder):
    return fact(spark, folder)


@query(
    "holdings_without_price",
    """SELECT portfolio_id, as_of_date, investment_asset_id, quantity FROM holding h
       WHERE NOT EXISTS (SELECT 1 FROM price p WHERE p.price_date = h.as_of_date
                         AND p.investment_asset_id = h.investment_asset_id)""",
)
def holdings_without_price(spark, folder):
    return valuation.holdings_without_price(
        market.holdings(spark, folder), market.prices(spark, folder)
    )


@query(
    "portfolio_value",
    """SELECT portfolio_id, as_of_date, round(sum(market_value), 2)::DOUBLE AS total_market_value
       FROM fact GROUP BY ALL""",
)
def portfolio_value(spark, folder):
    return valuation.portfolio_value(fact(spark, folder))


@query(
    "portfolio_value_base",
    """WITH by_currency AS (
         SELECT f.portfolio_id, f.as_of_date, a.currency,
                sum(f.market_value)::DECIMAL(28,4) AS v
         FROM fact f JOIN asset a USING (investment_asset_id) GROUP BY ALL)
       SELECT b.portfolio_id, b.as_of_date,
              round(sum((b.v * fx.rate_to_base::DECIMAL(9,4))::DECIMAL(38,8)), 2)::DOUBLE
                  AS base_value
       FROM by_currency b JOIN fx ON fx.rate_date = b.as_of_date AND fx.currency = b.currency
       GROUP BY ALL""",
)
def portfolio_value_base(spark, folder):
    return valuation.portfolio_value_in_base(
        fact(spark, folder), market.assets(spark, folder), market.currency_rates(spark, folder)
    )


@query(
    "sector_exposure",
    """SELECT portfolio_id, sector, sector_market_value::DOUBLE AS sector_market_value,
              portfolio_total_market_value::DOUBLE AS portfolio_total_market_value,
              exposure_pct, as_of_date FROM expo""",
)
def sector_exposure(spark, folder):
    return valuation.exposure(fact(spark, folder), "sector")


@query(
    "issuer_exposure",
    """SELECT portfolio_id, issuer_id, issuer_id_market_value::DOUBLE AS issuer_id_market_value,
              portfolio_total_market_value::DOUBLE AS portfolio_total_market_value,
              exposure_pct, as_of_date FROM issuer_expo""",
)
def issuer_exposure(spark, folder):
    return valuation.exposure(fact(spark, folder), "issuer_id")


@query("limit_breach", "SELECT * FROM breach")
def limit_breach(spark, folder):
    return breaches(spark, folder)


@query(
    "daily_pnl",
    """WITH calendar AS (
         SELECT price_date, lag(price_date) OVER (ORDER BY price_date) AS previous_date
         FROM (SELECT DISTINCT price_date FROM price))
       SELECT h.portfolio_id, h.as_of_date,
              round(sum(h.quantity::DECIMAL(18,4)
                        * (c.close_price::DECIMAL(16,4) - p.close_price::DECIMAL(16,4))), 4)::DOUBLE
                  AS daily_pnl
       FROM holding h
       JOIN price c ON c.investment_asset_id = h.investment_asset_id
                   AND c.price_date = h.as_of_date
       JOIN calendar k ON k.price_date = h.as_of_date
       JOIN price p ON p.investment_asset_id = h.investment_asset_id
                   AND p.price_date = k.previous_date
       GROUP BY ALL""",
)
def daily_pnl(spark, folder):
    return valuation.daily_pnl(market.holdings(spark, folder), market.prices(spark, folder))


@query(
    "latest_private_valuation",
    """SELECT * FROM valuation QUALIFY row_number() OVER (
         PARTITION BY investment_asset_id
         ORDER BY valuation_date DESC, fair_value DESC, currency DESC) = 1""",
)
def latest_private_valuation(spark, folder):
    return valuation.latest_valuation(market.private_valuations(spark, folder), "valuation_date")


@query(
    "latest_fund_nav",
    """SELECT * FROM nav QUALIFY row_number() OVER (
         PARTITION BY investment_asset_id
         ORDER BY nav_date DESC, nav_per_unit DESC, currency DESC) = 1""",
)
def latest_fund_nav(spark, folder):
    return valuation.latest_valuation(market.fund_navs(spark, folder), "nav_date")


@query(
    "exposure_listing",
    """SELECT portfolio_id, as_of_date, sector, exposure_pct FROM expo
       ORDER BY portfolio_id, as_of_date, exposure_pct DESC, sector""",
)
def exposure_listing(spark, folder):
    return valuation.exposure_listing(valuation.exposure(fact(spark, folder)))


@query(
    "breach_listing",
    "SELECT * FROM breach ORDER BY breach_by_pct DESC, portfolio_id, as_of_date, limit_id",
)
def breach_listing(spark, folder):
    return valuation.breach_listing(breaches(spark, folder))


@query(
    "top_holdings",
    """SELECT portfolio_id, investment_asset_id, sector, as_of_date,
              round(market_value, 2)::DOUBLE AS market_value
       FROM fact ORDER BY fact.market_value DESC, portfolio_id, investment_asset_id, as_of_date
       LIMIT 15""",
)
def top_holdings(spark, folder):
    return valuation.top_holdings(fact(spark, folder))


@query(
    "portfolio_breaches",
    """SELECT p.portfolio_id, b.sector, b.exposure_pct, b.max_pct, b.breach_by_pct, b.limit_id,
              b.as_of_date
       FROM portfolio p JOIN (SELECT portfolio_id, scope_value AS sector, exposure_pct, max_pct,
                                     breach_by_pct, limit_id, as_of_date
                              FROM breach WHERE scope_type = 'SECTOR') b USING (portfolio_id)""",
)
def portfolio_breaches(spark, folder):
    governance.register_portfolio_breaches(spark, breaches(spark, folder))
    return governance.for_each_portfolio(
        spark, market.portfolios(spark, folder), governance.BREACHES_FUNCTION
    )


@query(
    "portfolio_exposure",
    """SELECT p.portfolio_id, e.sector, e.exposure_pct, e.as_of_date
       FROM portfolio p JOIN expo e USING (portfolio_id)""",
)
def portfolio_exposure(spark, folder):
    governance.register_sector_exposure(spark, valuation.exposure(fact(spark, folder)))
    return governance.for_each_portfolio(
        spark, market.portfolios(spark, folder), governance.EXPOSURE_FUNCTION
    )


@query(
    "gold_gates",
    """SELECT 'holdings_without_price' AS gate, count(*) AS failing_rows, count(*) = 0 AS passed
       FROM holding h LEFT JOIN price p ON p.price_date = h.as_of_date
            AND p.investment_asset_id = h.investment_asset_id
       WHERE p.investment_asset_id IS NULL
       UNION ALL
       SELECT 'null_market_value', count(*), count(*) = 0 FROM fact WHERE market_value IS NULL
       UNION ALL
       SELECT 'exposure_above_ceiling', count(*), count(*) = 0 FROM expo
       WHERE exposure_pct > 100.01""",
)
def gold_gates(spark, folder):
    valued = fact(spark, folder)
    return valuation.gate_counts(
        market.holdings(spark, folder),
        market.prices(spark, folder),
        valued,
        valuation.exposure(valued),
    )


_ODD_UNITS = "CASE WHEN quantity >= 45 THEN quantity * 1e12 WHEN quantity <= 9 THEN quantity / 7 ELSE quantity END"


@query(
    "factor_gates",
    f"""WITH odd AS (SELECT {_ODD_UNITS} AS q, quantity FROM holding),
        counts AS (
          SELECT 'quantity_cut' AS gate, count(*) FILTER (q < 1e12 AND q::DECIMAL(22,10)::DOUBLE <> q) AS failing_rows
          FROM (SELECT CASE WHEN q < 1e12 THEN q ELSE 0 END AS q FROM odd)
          UNION ALL SELECT 'quantity_unfit', count(*) FILTER (q >= 1e12) FROM odd
          UNION ALL SELECT 'close_price_cut', count(*) FILTER (close_price::DECIMAL(18,8)::DOUBLE <> close_price) FROM price
          UNION ALL SELECT 'close_price_unfit', count(*) FILTER (close_price >= 1e10) FROM price)
        SELECT gate, failing_rows::BIGINT AS failing_rows, failing_rows = 0 AS passed FROM counts""",
)
def factor_gates(spark, folder):
    """Holdings of which some have more decimals than a product keeps and some more units than it takes."""
    odd = market.holdings(spark, folder).withColumn("quantity", F.expr(_ODD_UNITS))
    return valuation.factor_gate(odd, market.prices(spark, folder))


@query(
    "open_breaches",
    """SELECT as_of_date, count(*) AS breach_count FROM breach
       WHERE as_of_date = (SELECT max(as_of_date) FROM breach) GROUP BY as_of_date""",
)
def open_breaches(spark, folder):
    return governance.open_breaches(breaches(spark, folder))


@query(
    "gold_freshness",
    """SELECT max(as_of_date) AS latest_holding_date,
              count(DISTINCT portfolio_id) AS portfolios_loaded FROM fact""",
)
def gold_freshness(spark, folder):
    return fact(spark, folder).agg(
        F.max("as_of_date").alias("latest_holding_date"),
        F.count_distinct("portfolio_id").alias("portfolios_loaded"),
    )
