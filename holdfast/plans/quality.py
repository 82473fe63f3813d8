"""Data-quality queries: rules, flags, quarantine, rates and contract violations."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.functions.text import metric_name
from holdfast.operators import contracts, quality
from holdfast.operators.keys import dedupe_latest, fk_check
from holdfast.plans.registry import query
from holdfast.session import work_dir
from holdfast.sources import market, sinks

# Parameters of the registered runs
BUSINESS_DATE = "2001-10-31"
JOB_RUN_ID = "job-1"
CHECK_TIME = "2001-10-31 08:00:00"

_TXN_COLUMNS = (
    "transaction_id, transaction_date, portfolio_id, investment_asset_id, transaction_type, "
    "quantity, price, counterparty_id, _ingest_ts, _source_file, _batch_id, _rescued_data"
)


def run_id():
    """One run per calendar month of the business date."""
    return F.concat(F.lit("run_"), F.substring("transaction_date", 1, 7))


def conformed(spark, folder):
    return quality.conform(
        market.transactions(spark, folder),
        market.portfolios(spark, folder),
        market.assets(spark, folder),
    )


def reasoned(spark, folder):
    return quality.with_reasons(
        market.transactions(spark, folder),
        market.portfolios(spark, folder),
        market.assets(spark, folder),
    )


def quarantine_log(spark, folder, rows=None):
    return quality.quarantine_log(
        conformed(spark, folder) if rows is None else rows,
        "bronze.raw_investment_transactions",
        F.col("transaction_date"),
        run_id(),
        F.lit(JOB_RUN_ID),
        F.lit(CHECK_TIME).cast("timestamp_ntz"),
    )


@query(
    "fk_check",
    """SELECT investment_asset_id AS key_value, count(*) AS rows_using,
              investment_asset_id IN (SELECT investment_asset_id FROM asset) AS is_known
       FROM txn GROUP BY investment_asset_id""",
)
def check_keys(spark, folder):
    return fk_check(
        market.transactions(spark, folder), "investment_asset_id", market.assets(spark, folder)
    )


@query("dedupe_latest", f"SELECT {_TXN_COLUMNS} FROM deduped")
def dedupe(spark, folder):
    return dedupe_latest(market.transactions(spark, folder), ["transaction_id"], "_ingest_ts")


@query(
    "dq_rules",
    """SELECT 'transaction_id_present' AS rule, count(*) AS failed_rows FROM txn
       WHERE transaction_id IS NULL OR transaction_id = ''
       UNION ALL SELECT 'known_portfolio', count(*) FROM txn
       WHERE portfolio_id NOT IN (SELECT portfolio_id FROM portfolio)
       UNION ALL SELECT 'known_asset', count(*) FROM txn
       WHERE investment_asset_id NOT IN (SELECT investment_asset_id FROM asset)
       UNION ALL SELECT 'positive_quantity', count(*) FROM txn
       WHERE quantity IS NULL OR quantity <= 0
       UNION ALL SELECT 'valid_transaction_type', count(*) FROM txn
       WHERE transaction_type IS NULL
          OR transaction_type NOT IN ('BUY', 'SELL', 'ACQUISITION', 'DISPOSAL')""",
)
def dq_rules(spark, folder):
    return quality.rule_failures(
        market.transactions(spark, folder),
        market.portfolios(spark, folder),
        market.assets(spark, folder),
    )


@query("dq_valid", f"SELECT {_TXN_COLUMNS} FROM ruled WHERE len(reasons) = 0")
def dq_valid(spark, folder):
    return quality.valid_rows(reasoned(spark, folder))


@query(
    "dq_quarantined",
    f"""SELECT {_TXN_COLUMNS}, array_to_string(reasons, '; ') AS quarantine_reason
        FROM ruled WHERE len(reasons) > 0""",
)
def dq_quarantined(spark, folder):
    return quality.quarantined_rows(reasoned(spark, folder)).drop("_dq_reasons")


@query(
    "dq_flags",
    """SELECT transaction_id, bad_asset, bad_portfolio, bad_quantity, bad_type, bad_schema,
              dq_reason FROM conformed""",
)
def dq_flags(spark, folder):
    return conformed(spark, folder).select("transaction_id", *quality.FLAG_CODES, "dq_reason")


@query(
    "fail_gate",
    """SELECT 'transaction_id' AS mandatory_key, count(*) AS missing_rows,
              count(*) = 0 AS gate_passed FROM txn
       WHERE transaction_id IS NULL OR transaction_id = ''
       UNION ALL SELECT 'transaction_type', count(*), count(*) = 0 FROM txn
       WHERE transaction_type IS NULL OR transaction_type = ''
       UNION ALL SELECT 'counterparty_id', count(*), count(*) = 0 FROM txn
       WHERE counterparty_id IS NULL OR counterparty_id = ''""",
)
def fail_gate(spark, folder):
    return quality.mandatory_key_counts(
        market.transactions(spark, folder),
        ["transaction_id", "transaction_type", "counterparty_id"],
    )


@query(
    "quarantine",
    f"""SELECT {_TXN_COLUMNS}, dq_reason AS quarantine_reason,
               'bronze.raw_investment_transactions' AS source_table,
               _source_file AS source_file, _ingest_ts AS ingestion_ts,
               transaction_date::DATE AS business_date, run_id AS pipeline_run_id,
               '{JOB_RUN_ID}' AS job_run_id, TIMESTAMP '{CHECK_TIME}' AS check_timestamp,
               transaction_id AS payload_id
        FROM quarantined""",
)
def quarantine(spark, folder):
    """The log as stored: a run's slice is written twice and is there once.

    The rows are judged once and kept for both writes, on the executors' disks where memory ends.
    """
    rows = quarantine_log(spark, folder).persist()
    path = work_dir(spark, "quarantine")
    try:
        sinks.replace_partitions(rows, path, ["pipeline_run_id"])
        sinks.replace_partitions(rows, path, ["pipeline_run_id"])
    finally:
        rows.unpersist()
    stored = spark.read.parquet(path)
    return stored.select(
        *[c for c in rows.columns if c != "raw_payload"],
        F.get_json_object("raw_payload", "$.transaction_id").alias("payload_id"),
    )


@query(
    "quarantine_export",
    f"""SELECT {_TXN_COLUMNS}, array_to_string(reasons, '; ') AS _dq_reasons
        FROM ruled WHERE len(reasons) > 0""",
)
def quarantine_export(spark, folder):
    bad = quality.quarantined_rows(reasoned(spark, folder)).drop("quarantine_reason")
    path = work_dir(spark, "quarantine-export")
    schema = sinks.export_csv(bad, path, "_dq_reasons")
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


@query(
    "quarantine_replay",
    f"""SELECT {_TXN_COLUMNS},
               nullif(concat_ws('; ', CASE WHEN bad_quantity THEN 'bad_quantity' END,
                                CASE WHEN bad_type THEN 'bad_type' END,
                                CASE WHEN bad_schema THEN 'schema_drift' END), '') AS dq_reason
        FROM quarantined""",
)
def quarantine_replay(spark, folder):
    """Replay after the masters were completed: every supplier and every part is known."""
    log = quarantine_log(spark, folder)
    rows = market.transactions(spark, folder)
    all_portfolios = market.portfolio_access(spark, folder)
    all_assets = market.table(spark, folder, "part").select(
        F.concat(F.lit("AS_"), "p_partkey").alias("investment_asset_id")
    )
    return quality.replay(log, rows.schema, all_portfolios, all_assets).drop(*quality.FLAG_CODES)


_RATE = """round(CAST(coalesce(bad::DOUBLE / nullif(bad + good, 0)::DOUBLE * 100, 0)
                     AS DECIMAL(28,10)), 4)::DOUBLE"""


@query(
    "quarantine_rate",
    f"""SELECT pipeline_run_id, good AS valid_rows, bad AS quarantined_rows, {_RATE} AS rate_pct
        FROM (SELECT run_id AS pipeline_run_id, count(*) FILTER (dq_reason IS NULL) AS good,
                     count(*) FILTER (dq_reason IS NOT NULL) AS bad
              FROM conformed GROUP BY run_id)""",
)
def quarantine_rate(spark, folder):
    return quality.quarantine_rate(conformed(spark, folder), run_id())


@query(
    "quarantine_rate_for_run",
    f"""SELECT bad AS quarantined_rows, good AS valid_rows, {_RATE} AS rate_pct
        FROM (SELECT (SELECT count(*) FROM quarantined
                      WHERE run_id = (SELECT max(run_id) FROM quarantined)) AS bad,
                     (SELECT count(*) FROM silver
                      WHERE run_id = (SELECT max(run_id) FROM quarantined)) AS good)""",
)
def quarantine_rate_for_run(spark, folder):
    log = quarantine_log(spark, folder)
    newest = log.agg(F.max("pipeline_run_id").alias("run")).scalar()
    silver = quality.silver_rows(conformed(spark, folder))
    valid = silver.filter(run_id() == newest).agg(F.count("*").alias("n")).scalar()
    return quality.quarantine_rate_for_run(log, valid, newest)


@query(
    "quarantine_reasons",
    """SELECT pipeline_run_id, reason, count(*) AS quarantined_rows
       FROM (SELECT run_id AS pipeline_run_id, unnest(string_split(dq_reason, '; ')) AS reason
             FROM quarantined) GROUP BY ALL""",
)
def quarantine_reasons(spark, folder):
    return quality.quarantine_reasons(quarantine_log(spark, folder))


@query(
    "warn_counts",
    """SELECT count(*) AS total_rows,
              count(*) FILTER (counterparty_id IS NULL) AS missing_counterparty,
              count(*) FILTER (counterparty_id IS NOT NULL AND counterparty_id NOT IN
                               (SELECT counterparty_id FROM counterparty)) AS unknown_counterparty
       FROM silver""",
)
def warn_counts(spark, folder):
    return quality.counterparty_warnings(
        quality.silver_rows(conformed(spark, folder)), market.counterparties(spark, folder)
    )


def feeds(spark, folder):
    return {
        "investment_transactions": market.transactions(spark, folder),
        "listed_market_prices": market.prices(spark, folder),
        "investment_holdings_snapshot": market.holdings(spark, folder),
        "investment_limits": market.limits(spark, folder),
        "investment_asset_master": market.assets(spark, folder),
        "portfolio_master": market.portfolios(spark, folder),
        "counterparty_master": market.counterparties(spark, folder),
        "currency_rates": market.currency_rates(spark, folder),
    }


def _dup(feed, tier, view, keys):
    return (
        f"SELECT '{feed}' AS feed, 'no_duplicate_pk' AS rule_id, '{tier}' AS tier, "
        f"count(*) AS violations FROM (SELECT {keys} FROM {view} GROUP BY {keys} "
        f"HAVING count(*) > 1)"
    )


def _bad(feed, rule, tier, view, condition):
    return f"SELECT '{feed}', '{rule}', '{tier}', count(*) FROM {view} WHERE {condition}"


def _stale(feed, view, column):
    return (
        f"SELECT '{feed}', 'freshness', 'WARN', CASE WHEN max({column}) IS DISTINCT FROM "
        f"'{BUSINESS_DATE}' THEN 1 ELSE 0 END FROM {view}"
    )


_NO_ASSET = "investment_asset_id NOT IN (SELECT investment_asset_id FROM asset)"
_NO_PORTFOLIO = "portfolio_id NOT IN (SELECT portfolio_id FROM portfolio)"
_NO_CODE = "{0} IS NULL OR NOT regexp_matches({0}, '^[A-Z]{{3}}$')"

_CONTRACT_SQL = "\nUNION ALL ".join(
    [
        _dup("investment_transactions", "WARN", "txn", "transaction_id"),
        _bad("investment_transactions", "pk_not_null", "FAIL", "txn", "transaction_id IS NULL"),
        _bad("investment_transactions", "fk_portfolio", "QUARANTINE", "txn", _NO_PORTFOLIO),
        _bad("investment_transactions", "fk_asset", "QUARANTINE", "txn", _NO_ASSET),
        _bad("investment_transactions", "positive_quantity", "QUARANTINE", "txn",
             "quantity IS NULL OR quantity <= 0"),
        _bad("investment_transactions", "valid_type", "QUARANTINE", "txn",
             "transaction_type IS NULL OR transaction_type NOT IN "
             "('BUY', 'SELL', 'ACQUISITION', 'DISPOSAL')"),
        _bad("investment_transactions", "schema_drift", "QUARANTINE", "txn",
             "_rescued_data IS NOT NULL"),
        _bad("investment_transactions", "fk_counterparty", "WARN", "txn",
             "counterparty_id IS NULL OR counterparty_id NOT IN "
             "(SELECT counterparty_id FROM counterparty)"),
        _stale("investment_transactions", "txn", "transaction_date"),
        _dup("listed_market_prices", "WARN", "price", "investment_asset_id, price_date"),
        _bad("listed_market_prices", "pk_not_null", "FAIL", "price",
             "investment_asset_id IS NULL OR price_date IS NULL"),
        _bad("listed_market_prices", "fk_asset", "QUARANTINE", "price", _NO_ASSET),
        _bad("listed_market_prices", "price_non_negative", "QUARANTINE", "price",
             "close_price IS NULL OR close_price < 0"),
        "SELECT 'listed_market_prices', 'schema_drift', 'QUARANTINE', 0",
        _stale("listed_market_prices", "price", "price_date"),
        _dup("investment_holdings_snapshot", "WARN", "holding",
             "portfolio_id, as_of_date, investment_asset_id"),
        _bad("investment_holdings_snapshot", "pk_not_null", "FAIL", "holding",
             "portfolio_id IS NULL OR as_of_date IS NULL OR investment_asset_id IS NULL"),
        _bad("investment_holdings_snapshot", "fk_portfolio", "QUARANTINE", "holding",
             _NO_PORTFOLIO),
        _bad("investment_holdings_snapshot", "fk_asset", "QUARANTINE", "holding", _NO_ASSET),
        _bad("investment_holdings_snapshot", "quantity_present", "QUARANTINE", "holding",
             "quantity IS NULL"),
        "SELECT 'investment_holdings_snapshot', 'schema_drift', 'QUARANTINE', 0",
        _stale("investment_holdings_snapshot", "holding", "as_of_date"),
        _dup("investment_limits", "FAIL", "lim", "limit_id"),
        _bad("investment_limits", "pk_not_null", "FAIL", "lim", "limit_id IS NULL"),
        _bad("investment_limits", "valid_scope_type", "QUARANTINE", "lim",
             "scope_type NOT IN ('SECTOR', 'ISSUER', 'COUNTRY', 'ASSET_TYPE', 'PORTFOLIO')"),
        _bad("investment_limits", "scope_value_present", "QUARANTINE", "lim",
             "scope_value IS NULL"),
        _bad("investment_limits", "pct_in_range", "QUARANTINE", "lim",
             "max_pct IS NULL OR max_pct < 0 OR max_pct > 100"),
        _bad("investment_limits", "fk_portfolio", "QUARANTINE", "lim",
             f"portfolio_id <> 'ALL' AND {_NO_PORTFOLIO}"),
        "SELECT 'investment_limits', 'schema_drift', 'QUARANTINE', 0",
        _dup("investment_asset_master", "FAIL", "asset", "investment_asset_id"),
        _bad("investment_asset_master", "pk_not_null", "FAIL", "asset",
             "investment_asset_id IS NULL"),
        _bad("investment_asset_master", "name_present", "QUARANTINE", "asset", "name IS NULL"),
        _bad("investment_asset_master", "valid_asset_type", "QUARANTINE", "asset",
             "asset_type NOT IN ('EQUITY', 'BOND', 'FUND', 'PRIVATE', 'CASH', 'DERIVATIVE')"),
        _bad("investment_asset_master", "currency_present", "QUARANTINE", "asset",
             _NO_CODE.format("currency")),
        "SELECT 'investment_asset_master', 'schema_drift', 'QUARANTINE', 0",
        _dup("portfolio_master", "FAIL", "portfolio", "portfolio_id"),
        _bad("portfolio_master", "pk_not_null", "FAIL", "portfolio", "portfolio_id IS NULL"),
        _bad("portfolio_master", "name_present", "QUARANTINE", "portfolio",
             "portfolio_name IS NULL"),
        _bad("portfolio_master", "currency_present", "QUARANTINE", "portfolio",
             _NO_CODE.format("base_currency")),
        "SELECT 'portfolio_master', 'schema_drift', 'QUARANTINE', 0",
        _dup("counterparty_master", "FAIL", "counterparty", "counterparty_id"),
        _bad("counterparty_master", "pk_not_null", "FAIL", "counterparty",
             "counterparty_id IS NULL"),
        _bad("counterparty_master", "name_present", "QUARANTINE", "counterparty",
             "name IS NULL"),
        "SELECT 'counterparty_master', 'valid_type', 'WARN', NULL::BIGINT",
        "SELECT 'counterparty_master', 'valid_risk', 'WARN', NULL::BIGINT",
        "SELECT 'counterparty_master', 'schema_drift', 'QUARANTINE', 0",
        _dup("currency_rates", "WARN", "fx", "currency, rate_date"),
        _bad("currency_rates", "pk_not_null", "FAIL", "fx",
             "currency IS NULL OR rate_date IS NULL"),
        _bad("currency_rates", "rate_positive", "QUARANTINE", "fx",
             "rate_to_base IS NULL OR rate_to_base <= 0"),
        _bad("currency_rates", "currency_present", "QUARANTINE", "fx",
             _NO_CODE.format("currency")),
        "SELECT 'currency_rates', 'schema_drift', 'QUARANTINE', 0",
        _stale("currency_rates", "fx", "rate_date"),
    ]
)


@query("contract_violations", _CONTRACT_SQL)
def contract_violations(spark, folder):
    return contracts.contract_violations(feeds(spark, folder), BUSINESS_DATE)


@query(
    "metric_names",
    """SELECT DISTINCT lower(regexp_replace(p_name || ' ' || p_type || '%', '[^\\p{L}\\p{N}_:]',
                                            '_', 'g')) AS metric_name
       FROM part""",
)
def metric_names(spark, folder):
    raw = F.concat("p_name", F.lit(" "), "p_type", F.lit("%"))
    return (
        market.table(spark, folder, "part").select(metric_name(raw).alias("metric_name")).distinct()
    )
