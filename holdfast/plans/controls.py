"""Control queries: checks in the result-log shape, reconciliations, alerts and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.operators import controls, quality, valuation
from holdfast.plans import quality as quality_plans
from holdfast.plans import valuation as valuation_plans
from holdfast.plans.quality import BUSINESS_DATE, JOB_RUN_ID
from holdfast.plans.registry import query
from holdfast.session import work_dir
from holdfast.sources import market

# Parameters of the registered runs
AS_OF = "2001-11-30 08:00:00"
LOG_AS_OF = "2024-01-31 00:00:00"
LOG_SINCE = "2024-01-01"
DURATION_SECONDS = 42


def _result(name, table, date, metric, threshold="0", passed=None, run="NULL"):
    passed = f"{metric} = 0" if passed is None else passed
    return f"""SELECT '{name}' AS check_name, '{table}' AS source_table,
        {date}::DATE AS business_date, {run}::VARCHAR AS pipeline_run_id,
        '{JOB_RUN_ID}' AS job_run_id, ({metric})::DOUBLE AS metric_value,
        {threshold}::DOUBLE AS threshold, ({passed})::BOOLEAN AS passed"""


_DAY = f"'{BUSINESS_DATE}'"


@query(
    "dq_holdings_without_price",
    _result("holdings_without_price", "bronze.raw_investment_holdings_snapshot", _DAY, "count(*)")
    + """ FROM holding h LEFT JOIN price m ON h.investment_asset_id = m.investment_asset_id
                AND h.as_of_date = m.price_date WHERE m.investment_asset_id IS NULL""",
)
def dq_holdings_without_price(spark, folder):
    return controls.check_holdings_without_price(
        market.holdings(spark, folder), market.prices(spark, folder), BUSINESS_DATE, JOB_RUN_ID
    )


@query(
    "dq_quarantine_latest_run",
    _result("transaction_quarantine_count_latest_run", "silver.quarantine_transaction", _DAY,
            "count(*)", "NULL", "NULL", "max(run_id)")
    + " FROM quarantined WHERE run_id = (SELECT max(run_id) FROM quarantined)",
)
def dq_quarantine_latest_run(spark, folder):
    return controls.check_quarantine_latest_run(
        quality_plans.quarantine_log(spark, folder), BUSINESS_DATE, JOB_RUN_ID
    )


@query(
    "dq_breach_count",
    _result("limit_breach_count", "gold.fact_limit_breach", _DAY, "count(*)", "0", "true")
    + " FROM breach",
)
def dq_breach_count(spark, folder):
    return controls.check_breach_count(
        valuation_plans.breaches(spark, folder), BUSINESS_DATE, JOB_RUN_ID
    )


@query(
    "assets_missing_price",
    _result("assets_missing_latest_price", "bronze.raw_investment_asset_master", "d.price_date",
            "count(*)")
    + """ FROM (SELECT price_date FROM price UNION SELECT as_of_date FROM holding) d
          JOIN asset a ON a.asset_type LIKE 'LISTED%'
          LEFT JOIN price p ON p.price_date = d.price_date
                           AND p.investment_asset_id = a.investment_asset_id
          WHERE p.investment_asset_id IS NULL GROUP BY d.price_date""",
)
def assets_missing_price(spark, folder):
    return controls.check_assets_missing_price(
        market.assets(spark, folder), market.prices(spark, folder), JOB_RUN_ID,
        market.holdings(spark, folder).select(F.col("as_of_date").alias("price_date")),
    )


def _rescuable(spark, folder):
    return {
        "investment_transactions": market.transactions(spark, folder),
        "listed_market_prices": market.prices(spark, folder),
        "investment_holdings_snapshot": market.holdings(spark, folder),
    }


@query(
    "dq_rescued_rows",
    _result("bronze_rescued_rows_count", "bronze.raw_*", _DAY, "count(*)")
    + " FROM txn WHERE _rescued_data IS NOT NULL",
)
def dq_rescued_rows(spark, folder):
    return controls.check_rescued_rows(_rescuable(spark, folder), BUSINESS_DATE, JOB_RUN_ID)


_AGE = f"datediff('second', max(_ingest_ts), TIMESTAMP '{AS_OF}') // 60"


@query(
    "dq_freshness",
    _result("transaction_freshness_minutes", "bronze.raw_investment_transactions", _DAY, _AGE,
            "1440.0", f"{_AGE} <= 1440.0")
    + " FROM txn",
)
def dq_freshness(spark, folder):
    return controls.check_freshness(
        market.transactions(spark, folder), AS_OF, BUSINESS_DATE, JOB_RUN_ID
    )


@query(
    "dq_quarantine_rate",
    _result("transaction_quarantine_rate_pct", "silver.silver_transaction", "month_end", "rate",
            "2.0", "rate <= 2.0", "run_id")
    + """ FROM (SELECT run_id, last_day(max(transaction_date::DATE)) AS month_end,
                       round(CAST(count(dq_reason)::DOUBLE / count(*)::DOUBLE * 100
                                  AS DECIMAL(28,10)), 4)::DOUBLE AS rate
                FROM conformed GROUP BY run_id)""",
)
def dq_quarantine_rate(spark, folder):
    rates = quality.quarantine_rate(
        quality_plans.conformed(spark, folder), quality_plans.run_id()
    ).withColumn(
        "business_date",
        F.last_day(F.to_date(F.substring("pipeline_run_id", 5, 7), "yyyy-MM")),
    )
    return controls.check_quarantine_rate(rates, quality.QUARANTINE_RATE_THRESHOLD, JOB_RUN_ID)


@query(
    "dq_recent",
    f"""SELECT count(*) AS recent_rows, count(*) > 0 AS is_recent FROM reslog
        WHERE check_timestamp >= TIMESTAMP '{LOG_AS_OF}' - INTERVAL 7 DAYS""",
)
def dq_recent(spark, folder):
    return controls.recent_checks(market.result_log(spark, folder), LOG_AS_OF)


@query(
    "feed_readiness",
    f"""WITH r AS (
          SELECT 'prices' AS feed, EXISTS (SELECT 1 FROM price WHERE price_date = {_DAY})
                 AS received
          UNION ALL SELECT 'holdings', EXISTS (SELECT 1 FROM holding WHERE as_of_date = {_DAY})
          UNION ALL SELECT 'fx', EXISTS (SELECT 1 FROM fx WHERE rate_date = {_DAY}))
        SELECT feed, received, (SELECT bool_and(received) FROM r) AS all_feeds_ready FROM r""",
)
def feed_readiness(spark, folder):
    return controls.feed_readiness(
        {
            "prices": (market.prices(spark, folder), "price_date"),
            "holdings": (market.holdings(spark, folder), "as_of_date"),
            "fx": (market.currency_rates(spark, folder), "rate_date"),
        },
        BUSINESS_DATE,
    )


# ---- reconciliations --------------------------------------------------------------


def _balance(landed):
    return (
        _result("bronze_silver_quarantine_balance", "bronze.raw_investment_transactions", "d",
                "abs(coalesce(b, 0) - coalesce(s, 0) - coalesce(q, 0))")
        + f""" FROM (SELECT transaction_date AS d, count(*) AS b FROM ({landed}) GROUP BY 1) b
               FULL JOIN (SELECT transaction_date AS d, count(*) FILTER (dq_reason IS NULL) AS s,
                                 count(*) FILTER (dq_reason IS NOT NULL) AS q
                          FROM conformed GROUP BY 1) c USING (d)"""
    )


@query(
    "recon_balance",
    f"""SELECT 'landed' AS variant, * FROM ({_balance("SELECT * FROM txn")})
        UNION ALL
        SELECT 'deduplicated', * FROM ({_balance("SELECT transaction_id, max(transaction_date) "
                                                 "AS transaction_date FROM txn GROUP BY 1")})""",
)
def recon_balance(spark, folder):
    """Silver and quarantine are tables of one conformed run; the landed rows are read once for both variants."""
    path = work_dir(spark, "recon-conformed")
    quality_plans.conformed(spark, folder).write.parquet(path)
    rows = spark.read.parquet(path)
    return controls.recon_balances(
        market.transactions(spark, folder), quality.silver_rows(rows), quality_plans.quarantine_log(spark, folder, rows), JOB_RUN_ID
    )


def _duplicates(table, view):
    return (
        _result("silver_duplicate_transaction_ids", table, _DAY, "count(*)")
        + f""" FROM (SELECT transaction_id FROM {view} GROUP BY 1 HAVING count(*) > 1)"""
    )


@query(
    "recon_duplicate_keys",
    _duplicates("silver.silver_transaction", "silver")
    + " UNION ALL "
    + _duplicates("bronze.raw_investment_transactions", "txn"),
)
def recon_duplicate_keys(spark, folder):
    silver = quality.silver_rows(quality_plans.conformed(spark, folder))
    return controls.recon_duplicate_keys(
        silver, "transaction_id", "silver.silver_transaction", BUSINESS_DATE, JOB_RUN_ID
    ).unionByName(
        controls.recon_duplicate_keys(
            market.transactions(spark, folder), "transaction_id",
            "bronze.raw_investment_transactions", BUSINESS_DATE, JOB_RUN_ID,
        )
    )


@query(
    "recon_missing_price",
    """WITH missing AS (
         SELECT as_of_date, portfolio_id, investment_asset_id FROM holding
         EXCEPT
         SELECT h.as_of_date, h.portfolio_id, h.investment_asset_id FROM holding h
         JOIN price m ON h.investment_asset_id = m.investment_asset_id
                     AND h.as_of_date = m.price_date) """
    + _result("holdings_missing_price", "bronze.raw_investment_holdings_snapshot", "as_of_date",
              "coalesce(n, 0)")
    + """ FROM (SELECT DISTINCT as_of_date FROM holding)
          LEFT JOIN (SELECT as_of_date, count(*) AS n FROM missing GROUP BY 1)
          USING (as_of_date)""",
)
def recon_missing_price(spark, folder):
    return controls.recon_missing_price(
        market.holdings(spark, folder), market.prices(spark, folder), JOB_RUN_ID
    )


@query(
    "recon_missing_asset",
    _result("holdings_missing_asset_master", "bronze.raw_investment_holdings_snapshot",
            "as_of_date", "count(*) FILTER (a.investment_asset_id IS NULL)")
    + """ FROM holding h LEFT JOIN asset a USING (investment_asset_id) GROUP BY as_of_date""",
)
def recon_missing_asset(spark, folder):
    return controls.recon_missing_asset(
        market.holdings(spark, folder), market.assets(spark, folder), JOB_RUN_ID
    )


@query(
    "recon_exposure_total",
    _result("exposure_totals_not_100pct", "gold.fact_portfolio_exposure", "as_of_date",
            "count(*) FILTER (abs(total_pct - 100) > 0.1)")
    + """ FROM (SELECT portfolio_id, as_of_date, sum(exposure_pct::DECIMAL(18,4)) AS total_pct
                FROM expo GROUP BY ALL) GROUP BY as_of_date""",
)
def recon_exposure_total(spark, folder):
    return controls.recon_exposure_total(
        valuation.exposure(valuation_plans.fact(spark, folder)), JOB_RUN_ID
    )


@query(
    "recon_breach_consistent",
    _result("breach_rows_inconsistent_with_limit", "gold.fact_limit_breach", "as_of_date",
            "count(*) FILTER (NOT (exposure_pct > max_pct))")
    + " FROM breach GROUP BY as_of_date",
)
def recon_breach_consistent(spark, folder):
    return controls.recon_breach_consistent(valuation_plans.breaches(spark, folder), JOB_RUN_ID)


@query(
    "recon_feed_freshness",
    _result("feed_date_freshness",
            "bronze.raw_listed_market_prices,bronze.raw_investment_holdings_snapshot", _DAY,
            f"count(*) FILTER (d IS DISTINCT FROM {_DAY})")
    + """ FROM (SELECT max(price_date) AS d FROM price
                UNION ALL SELECT max(as_of_date) FROM holding)""",
)
def recon_feed_freshness(spark, folder):
    return controls.recon_feed_freshness(
        {
            "prices": (market.prices(spark, folder), "price_date"),
            "holdings": (market.holdings(spark, folder), "as_of_date"),
        },
        BUSINESS_DATE,
        JOB_RUN_ID,
    )


# A second formulation of the breaches, in SQL: one read of the fact, summed by sector and issuer at once, with
# totals as a window over these sums. All of it is worked out where a portfolio's holdings of a date lie; a
# grouping set would shuffle three rows for every holding.
_SHARES = """
    WITH cells AS (
      SELECT portfolio_id, as_of_date, sector, issuer_id, sum(market_value) AS value
      FROM {fact} GROUP BY portfolio_id, as_of_date, sector, issuer_id),
    totaled AS (
      SELECT *, sum(value) OVER (PARTITION BY portfolio_id, as_of_date) AS total FROM cells),
    scoped AS (
      SELECT portfolio_id, as_of_date, total, inline(array(
               named_struct('scope_type', 'SECTOR', 'scope_value', sector, 'value', value),
               named_struct('scope_type', 'ISSUER', 'scope_value', issuer_id, 'value', value)))
      FROM totaled),
    sums AS (
      SELECT portfolio_id, as_of_date, scope_type, scope_value, sum(value) AS value, max(total) AS total
      FROM scoped GROUP BY portfolio_id, as_of_date, scope_type, scope_value)
    SELECT portfolio_id, as_of_date, scope_type, scope_value,
           CAST(round(CAST(CAST(value AS DOUBLE) / CAST(total AS DOUBLE) * 100
               AS DECIMAL(28,10)), 4) AS DOUBLE) AS pct
    FROM sums WHERE total <> 0"""

# Each share looks up the limits for all and its portfolio's own ones instead of being offered
# under two keys. Both lookups are equalities: an OR would pair a share with the scope's limits of
# every portfolio. The first finds the scope's limits for all and the least of the others, and only shares
# above one of them go on to the second.
_RECOMPUTE = """
    WITH rules AS (
      SELECT nullif(portfolio_id, 'ALL') AS own, upper(scope_type) AS scope_type, scope_value,
             collect_set(struct(limit_id, max_pct)) AS found, min(max_pct) AS least
      FROM {limits} GROUP BY 1, 2, 3),
    scopes AS (
      SELECT scope_type, scope_value, min(least) AS least, flatten(collect_list(found) FILTER (WHERE own IS NULL)) AS found
      FROM rules GROUP BY scope_type, scope_value),
    high AS (
      SELECT s.*, a.found AS found
      FROM {shares} s JOIN scopes a ON a.scope_type = s.scope_type AND a.scope_value = s.scope_value
      WHERE s.pct > a.least),
    ruled AS (
      SELECT s.portfolio_id, s.as_of_date, s.scope_type, s.scope_value, s.pct, inline(concat(s.found, coalesce(o.found, array())))
      FROM high s
      LEFT JOIN rules o ON o.own = s.portfolio_id AND o.scope_type = s.scope_type AND o.scope_value = s.scope_value)
    SELECT portfolio_id, as_of_date, scope_type, scope_value, limit_id FROM ruled WHERE pct > max_pct"""


@query(
    "reconcile_breaches",
    """SELECT count(*) AS in_both, 0::BIGINT AS only_left, 0::BIGINT AS only_right FROM
         (SELECT DISTINCT portfolio_id, as_of_date, scope_type, scope_value, limit_id
          FROM breach)""",
)
def reconcile_breaches(spark, folder):
    limits, fact = market.limits(spark, folder), valuation_plans.dealt_fact(spark, folder)
    breaches = valuation.limit_breach(market.named(valuation.exposure_by_scope(fact)), limits)
    shares = market.named(spark.sql(_SHARES, fact=fact))
    recomputed = spark.sql(_RECOMPUTE, shares=shares, limits=limits)
    keys = ["portfolio_id", "as_of_date", "scope_type", "scope_value", "limit_id"]
    return controls.compare_keys(breaches, recomputed, keys)


# ---- result log -------------------------------------------------------------------

_LATEST = """SELECT * FROM reslog QUALIFY row_number() OVER (
               PARTITION BY check_name ORDER BY check_timestamp DESC, job_run_id DESC) = 1"""


@query(
    "latest_check_results",
    f"SELECT check_name, metric_value, threshold, passed FROM ({_LATEST})",
)
def latest_check_results(spark, folder):
    return controls.latest_results(market.result_log(spark, folder)).select(
        "check_name", "metric_value", "threshold", "passed"
    )


@query(
    "alert_states",
    f"""SELECT r.check_name, r.alert_above, l.metric_value,
               CASE WHEN l.metric_value IS NULL THEN 'NO_DATA'
                    WHEN l.metric_value > r.alert_above THEN 'FIRING' ELSE 'OK' END AS state
        FROM (VALUES ('bronze_rescued_rows_count', 0.0::DOUBLE),
                     ('transaction_quarantine_rate_pct', 2.0),
                     ('assets_missing_latest_price', 0.0),
                     ('transaction_freshness_minutes', 1440.0),
                     ('expectation_failed_records', 0.0)) r(check_name, alert_above)
        LEFT JOIN ({_LATEST}) l USING (check_name)""",
)
def alert_states(spark, folder):
    return controls.alert_states(market.result_log(spark, folder))


@query(
    "breach_spike",
    """WITH hist AS (
         SELECT check_name, metric_value AS v, row_number() OVER (
                  PARTITION BY check_name ORDER BY check_timestamp DESC, job_run_id DESC) AS rn
         FROM reslog)
       SELECT check_name, newest_value, history_mean,
              CASE WHEN newest_value > 1.5 * history_mean THEN 1 ELSE 0 END AS spike
       FROM (SELECT check_name, max(v) FILTER (rn = 1) AS newest_value,
                    coalesce(sum(v::DECIMAL(18,4)) FILTER (rn BETWEEN 2 AND 8)::DOUBLE
                             / nullif(count(*) FILTER (rn BETWEEN 2 AND 8), 0), 0)
                        AS history_mean
             FROM hist GROUP BY check_name)""",
)
def breach_spike(spark, folder):
    return controls.breach_spike(market.result_log(spark, folder))


@query(
    "dq_failure_trend",
    f"""SELECT CAST(check_timestamp AS DATE) AS day, count(*) AS failed_checks,
               array_to_string(list_sort(list(DISTINCT check_name)), ',') AS failing_check_names
        FROM reslog WHERE NOT passed AND check_timestamp >= TIMESTAMP '{LOG_SINCE}'
        GROUP BY 1""",
)
def dq_failure_trend(spark, folder):
    return controls.failure_trend(market.result_log(spark, folder), LOG_SINCE)


@query(
    "quarantine_rate_trend",
    """SELECT CAST(check_timestamp AS DATE) AS day, max(metric_value) AS quarantine_rate_pct
       FROM reslog WHERE check_name = 'transaction_quarantine_rate_pct' GROUP BY 1""",
)
def quarantine_rate_trend(spark, folder):
    return controls.quarantine_rate_trend(market.result_log(spark, folder))


@query(
    "pipeline_metrics",
    f"""WITH c AS (SELECT count(*) AS n, count(dq_reason) AS q FROM conformed)
        SELECT 'rows_in' AS metric, n::DOUBLE AS value, 'eod' AS job FROM c
        UNION ALL SELECT 'rows_valid', (n - q)::DOUBLE, 'eod' FROM c
        UNION ALL SELECT 'rows_quarantined', q::DOUBLE, 'eod' FROM c
        UNION ALL SELECT 'quarantine_rate_pct',
               round(CAST(q::DOUBLE / n::DOUBLE * 100 AS DECIMAL(28,10)), 4)::DOUBLE, 'eod' FROM c
        UNION ALL SELECT 'duration_seconds', {DURATION_SECONDS}.0, 'eod'
        UNION ALL SELECT 'breach_count', count(*)::DOUBLE, 'eod' FROM breach
        UNION ALL SELECT 'bronze_rescued_rows', count(_rescued_data)::DOUBLE, 'eod' FROM txn""",
)
def pipeline_metrics(spark, folder):
    return controls.pipeline_metrics(
        quality_plans.conformed(spark, folder),
        valuation_plans.breaches(spark, folder),
        _rescuable(spark, folder),
        DURATION_SECONDS,
        "eod",
    )
