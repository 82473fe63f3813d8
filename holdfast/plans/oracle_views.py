"""SQL text of the domain feeds, for the oracle queries.

Written from the definition of each feed and not from the Spark code, so that a mistake in
either shows as a difference.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "txn": """
        SELECT l_orderkey || '-' || l_linenumber AS transaction_id,
               strftime(l_shipdate, '%Y-%m-%d') AS transaction_date,
               'PF_' || l_suppkey AS portfolio_id,
               'AS_' || l_partkey AS investment_asset_id,
               CASE WHEN l_tax = 0.08 THEN 'WUT' WHEN l_discount = 0.0 THEN NULL
                    WHEN l_returnflag = 'A' THEN 'BUY' WHEN l_returnflag = 'N' THEN 'SELL'
                    WHEN l_linestatus = 'F' THEN 'ACQUISITION' ELSE 'DISPOSAL'
               END AS transaction_type,
               CASE WHEN l_discount <> 0.1 THEN l_quantity - 2 END AS quantity,
               l_extendedprice / l_quantity AS price,
               CASE WHEN l_tax <> 0.0 THEN 'CP_' || l_linenumber END AS counterparty_id,
               l_shipdate AS _ingest_ts,
               'investment_transactions.json' AS _source_file,
               'investment_transactions__' || strftime(l_shipdate, '%Y-%m-%d') AS _batch_id,
               CASE WHEN l_tax = 0.07 AND l_discount = 0.07
                    THEN '{"fee":"' || l_linenumber || '"}' END AS _rescued_data
        FROM lineitem""",
    "portfolio": """
        SELECT 'PF_' || s_suppkey AS portfolio_id, s_name AS portfolio_name,
               'pm' || s_nationkey AS manager,
               CASE WHEN s_nationkey < 8 THEN 'USD' WHEN s_nationkey < 16 THEN 'AED'
                    WHEN s_nationkey < 24 THEN 'EUR' END AS base_currency
        FROM supplier WHERE s_acctbal >= 0""",
    "asset": """
        SELECT 'AS_' || p_partkey AS investment_asset_id, p_name AS name,
               CASE WHEN p_size <= 25 THEN 'LISTED_EQUITY' WHEN p_size <= 35 THEN 'LISTED_BOND'
                    WHEN p_size <= 42 THEN 'FUND' ELSE 'PRIVATE_COMPANY' END AS asset_type,
               p_brand AS issuer_id, p_type AS sector,
               CASE WHEN p_size <= 20 THEN 'AED' ELSE 'USD' END AS currency
        FROM part WHERE p_size < 50""",
    "counterparty": """
        SELECT 'CP_' || n_nationkey AS counterparty_id, n_name AS name
        FROM nation WHERE n_regionkey <> 4""",
    "lim": """
        SELECT DISTINCT 'LIM_S_' || p_type AS limit_id, 'SECTOR' AS scope_type,
               p_type AS scope_value, 'ALL' AS portfolio_id, 40.0::DOUBLE AS max_pct FROM part
        UNION ALL
        SELECT DISTINCT 'LIM_I_' || p_brand, 'ISSUER', p_brand, NULL, 35.0::DOUBLE FROM part
        UNION ALL
        SELECT 'LIM_P_' || s_suppkey, 'sector', 'PROMO', 'PF_' || s_suppkey, 20.0::DOUBLE
        FROM supplier WHERE s_acctbal > 5000
        UNION ALL
        SELECT 'LIM_C_' || n_nationkey, 'COUNTERPARTY', 'CP_' || n_nationkey, 'ALL', 15.0::DOUBLE
        FROM nation""",
    "holding": """
        SELECT 'PF_' || l_suppkey AS portfolio_id,
               strftime(last_day(l_shipdate), '%Y-%m-%d') AS as_of_date,
               'AS_' || l_partkey AS investment_asset_id, sum(l_quantity) AS quantity
        FROM lineitem GROUP BY ALL""",
    "price": """
        SELECT strftime(last_day(l_shipdate), '%Y-%m-%d') AS price_date,
               'AS_' || l_partkey AS investment_asset_id,
               round(CAST(sum(l_extendedprice::DECIMAL(18,2))::DOUBLE / sum(l_quantity)
                          AS DECIMAL(28,10)), 4)::DOUBLE AS close_price
        FROM lineitem WHERE l_tax <> 0.08 GROUP BY ALL""",
    "fx": """
        SELECT DISTINCT strftime(last_day(o_orderdate), '%Y-%m-%d') AS rate_date,
               CASE o_orderstatus WHEN 'F' THEN 'AED' WHEN 'O' THEN 'USD' ELSE 'EUR' END AS currency,
               CASE o_orderstatus WHEN 'F' THEN 0.2723 WHEN 'O' THEN 1.0 ELSE 1.08 END::DOUBLE
                   AS rate_to_base
        FROM orders""",
    "valuation": """
        SELECT 'PE_' || o_custkey AS investment_asset_id,
               strftime(o_orderdate, '%Y-%m-%d') AS valuation_date, o_totalprice AS fair_value,
               CASE WHEN o_orderstatus = 'F' THEN 'AED' ELSE 'USD' END AS currency
        FROM orders""",
    "nav": """
        SELECT 'FUND_' || user_id AS investment_asset_id, strftime(ts, '%Y-%m-%d') AS nav_date,
               value AS nav_per_unit,
               CASE WHEN event_type = 'view' THEN 'AED' ELSE 'USD' END AS currency
        FROM events""",
    "fact": """
        SELECT h.portfolio_id, h.as_of_date, h.investment_asset_id, h.quantity, p.close_price,
               a.sector, a.issuer_id,
               h.quantity::DECIMAL(18,4) * p.close_price::DECIMAL(18,4) AS market_value
        FROM holding h
        JOIN price p ON p.investment_asset_id = h.investment_asset_id
                    AND p.price_date = h.as_of_date
        JOIN asset a ON a.investment_asset_id = h.investment_asset_id""",
    "expo": """
        SELECT s.portfolio_id, s.sector, s.sector_market_value, t.portfolio_total_market_value,
               round(CAST(s.sector_market_value::DOUBLE / t.portfolio_total_market_value::DOUBLE
                          * 100 AS DECIMAL(28,10)), 4)::DOUBLE AS exposure_pct, s.as_of_date
        FROM (SELECT portfolio_id, as_of_date, sector, sum(market_value) AS sector_market_value
              FROM fact GROUP BY ALL) s
        JOIN (SELECT portfolio_id, as_of_date, sum(market_value) AS portfolio_total_market_value
              FROM fact GROUP BY ALL) t USING (portfolio_id, as_of_date)
        WHERE t.portfolio_total_market_value <> 0""",
    "issuer_expo": """
        SELECT s.portfolio_id, s.issuer_id, s.issuer_id_market_value,
               t.portfolio_total_market_value,
               round(CAST(s.issuer_id_market_value::DOUBLE
                          / t.portfolio_total_market_value::DOUBLE * 100
                          AS DECIMAL(28,10)), 4)::DOUBLE AS exposure_pct, s.as_of_date
        FROM (SELECT portfolio_id, as_of_date, issuer_id, sum(market_value)
                     AS issuer_id_market_value FROM fact GROUP BY ALL) s
        JOIN (SELECT portfolio_id, as_of_date, sum(market_value) AS portfolio_total_market_value
              FROM fact GROUP BY ALL) t USING (portfolio_id, as_of_date)
        WHERE t.portfolio_total_market_value <> 0""",
    "breach": """
        SELECT e.portfolio_id, l.scope_type, l.scope_value, e.exposure_pct, l.max_pct,
               (e.exposure_pct::DECIMAL(18,4) - l.max_pct::DECIMAL(18,4))::DOUBLE AS breach_by_pct,
               l.limit_id, e.as_of_date
        FROM (SELECT portfolio_id, as_of_date, 'SECTOR' AS scope_type, sector AS scope_value,
                     exposure_pct FROM expo
              UNION ALL
              SELECT portfolio_id, as_of_date, 'ISSUER', issuer_id, exposure_pct
              FROM issuer_expo) e
        JOIN (SELECT limit_id, upper(scope_type) AS scope_type, scope_value, portfolio_id, max_pct
              FROM lim) l
          ON l.scope_type = e.scope_type AND l.scope_value = e.scope_value
         AND (l.portfolio_id IS NULL OR l.portfolio_id = 'ALL' OR l.portfolio_id = e.portfolio_id)
        WHERE e.exposure_pct > l.max_pct""",
    "deduped": """
        SELECT * FROM txn
        QUALIFY row_number() OVER (
            PARTITION BY transaction_id
            ORDER BY _ingest_ts DESC NULLS LAST, transaction_date DESC NULLS LAST,
                     portfolio_id DESC NULLS LAST, investment_asset_id DESC NULLS LAST,
                     transaction_type DESC NULLS LAST, quantity DESC NULLS LAST,
                     price DESC NULLS LAST, counterparty_id DESC NULLS LAST,
                     _source_file DESC NULLS LAST, _batch_id DESC NULLS LAST,
                     _rescued_data DESC NULLS LAST) = 1""",
    "flagged": """
        SELECT d.*,
               investment_asset_id NOT IN (SELECT investment_asset_id FROM asset) AS bad_asset,
               portfolio_id NOT IN (SELECT portfolio_id FROM portfolio) AS bad_portfolio,
               quantity IS NULL OR quantity <= 0 AS bad_quantity,
               transaction_type IS NULL OR transaction_type NOT IN
                   ('BUY', 'SELL', 'ACQUISITION', 'DISPOSAL') AS bad_type,
               _rescued_data IS NOT NULL AS bad_schema
        FROM deduped d""",
    "conformed": """
        SELECT *, nullif(concat_ws('; ', CASE WHEN bad_asset THEN 'bad_asset' END,
                                   CASE WHEN bad_portfolio THEN 'bad_portfolio' END,
                                   CASE WHEN bad_quantity THEN 'bad_quantity' END,
                                   CASE WHEN bad_type THEN 'bad_type' END,
                                   CASE WHEN bad_schema THEN 'schema_drift' END), '') AS dq_reason,
               'run_' || substr(transaction_date, 1, 7) AS run_id
        FROM flagged""",
    "silver": "SELECT * FROM conformed WHERE dq_reason IS NULL",
    "quarantined": "SELECT * FROM conformed WHERE dq_reason IS NOT NULL",
    "ruled": """
        SELECT t.*, list_filter([
                 CASE WHEN transaction_id IS NULL OR transaction_id = ''
                      THEN 'missing transaction_id' END,
                 CASE WHEN portfolio_id NOT IN (SELECT portfolio_id FROM portfolio)
                      THEN 'unknown portfolio_id=' || portfolio_id END,
                 CASE WHEN investment_asset_id NOT IN (SELECT investment_asset_id FROM asset)
                      THEN 'unknown investment_asset_id=' || investment_asset_id END,
                 CASE WHEN quantity IS NULL THEN 'non-numeric quantity'
                      WHEN quantity <= 0
                      THEN 'non-positive quantity=' || quantity::VARCHAR END,
                 CASE WHEN transaction_type IS NULL THEN 'invalid transaction_type=None'
                      WHEN transaction_type NOT IN ('BUY', 'SELL', 'ACQUISITION', 'DISPOSAL')
                      THEN 'invalid transaction_type=' || transaction_type END],
               lambda x: x IS NOT NULL) AS reasons
        FROM txn t""",
    "reslog": """
        SELECT ts AS check_timestamp,
               CASE event_type WHEN 'error' THEN 'bronze_rescued_rows_count'
                    WHEN 'purchase' THEN 'transaction_quarantine_rate_pct'
                    WHEN 'signup' THEN 'assets_missing_latest_price'
                    WHEN 'click' THEN 'transaction_freshness_minutes'
                    ELSE 'limit_breach_count' END AS check_name,
               'feed_' || user_id AS source_table, CAST(ts AS DATE) AS business_date,
               'job_' || event_id AS job_run_id,
               value AS metric_value, 50.0::DOUBLE AS threshold, value <= 50.0 AS passed
        FROM events""",
    "job_run": """
        SELECT 'ws_1' AS workspace_id, user_id AS job_id, event_id AS run_id,
               CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'TIMED_OUT'
                    ELSE 'SUCCEEDED' END AS result_state,
               ts AS period_start_time,
               CASE WHEN event_type <> 'signup'
                    THEN ts + to_seconds(floor(value)::BIGINT) END AS period_end_time
        FROM events""",
    "job": """
        SELECT 'ws_1' AS workspace_id, c_custkey AS job_id, c_name AS name
        FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING', 'HOUSEHOLD')""",
    "usg": """
        SELECT 'ws_1' AS workspace_id, CAST(l_shipdate AS DATE) AS usage_date,
               l_shipdate AS usage_end_time, 'DBU' AS usage_unit,
               CASE l_returnflag WHEN 'A' THEN 'JOBS_COMPUTE_' WHEN 'N' THEN 'SERVERLESS_SQL_'
                    ELSE 'VECTOR_SEARCH_' END || l_linestatus AS sku_name,
               l_quantity AS usage_quantity,
               CASE WHEN l_tax <> 0.0 THEN l_suppkey END AS job_id,
               CASE WHEN l_returnflag = 'N' THEN 'WH_' || l_linenumber END AS warehouse_id
        FROM lineitem""",
    "listprice": """
        SELECT sku_name, 'DBU' AS usage_unit, make_timestamp(y, 1, 1, 0, 0, 0) AS price_start_time,
               CASE WHEN y < max(y) OVER (PARTITION BY sku_name)
                    THEN make_timestamp(y + 1, 1, 1, 0, 0, 0) END AS price_end_time,
               CAST(0.10 + (y - 1990) / 100.0 AS DECIMAL(18,4)) AS unit_price
        FROM (SELECT DISTINCT sku_name, year(usage_date) AS y FROM usg)""",
    "audit": """
        SELECT CAST(ts AS DATE) AS event_date, ts AS event_time, event_id,
               CASE WHEN event_type = 'click' THEN 'accounts' ELSE 'catalog' END
                   AS service_name,
               CASE event_type WHEN 'click' THEN 'userLogin' WHEN 'signup' THEN 'tokenLogin'
                    WHEN 'purchase' THEN 'updateGrants' WHEN 'error' THEN 'changePermission'
                    ELSE 'getTable' END AS action_name,
               props AS request_params, '10.0.0.' || user_id AS source_ip_address,
               'u' || user_id || '@example.com' AS actor,
               CASE WHEN (props->>'$.k')::INT < 50 THEN 200 ELSE 401 END AS status_code,
               CASE WHEN (props->>'$.k')::INT >= 90 THEN 'locked' END AS error_message
        FROM events""",
    "pm_map": """
        SELECT 'pm' || s_nationkey || '@example.com' AS pm_user,
               'PF_' || s_suppkey AS portfolio_id FROM supplier""",
    "snap1": """
        SELECT 'AS_' || p_partkey AS investment_asset_id, p_name AS name,
               CASE WHEN p_size <= 25 THEN 'LISTED_EQUITY' ELSE 'LISTED_BOND' END AS asset_type,
               p_brand AS issuer_id, p_type AS sector
        FROM part WHERE p_size < 45""",
    "snap2": """
        SELECT 'AS_' || p_partkey AS investment_asset_id, p_name AS name,
               CASE WHEN p_size <= 25 THEN 'LISTED_EQUITY' ELSE 'LISTED_BOND' END AS asset_type,
               p_brand AS issuer_id,
               CASE p_brand WHEN 'Brand#7' THEN p_type || '_NEW' WHEN 'Brand#11' THEN NULL
                    ELSE p_type END AS sector
        FROM part WHERE p_brand <> 'Brand#13'""",
    "snap3": """
        SELECT 'AS_' || p_partkey AS investment_asset_id, p_name AS name,
               CASE WHEN p_size <= 25 THEN 'LISTED_EQUITY' ELSE 'LISTED_BOND' END AS asset_type,
               p_brand AS issuer_id,
               CASE p_brand WHEN 'Brand#7' THEN p_type || '_NEW' ELSE p_type END AS sector
        FROM part WHERE p_brand <> 'Brand#5'""",
    "doc": """
        SELECT source || '/' || doc_id AS doc_name, doc_id, text FROM documents""",
    "chunk": """
        SELECT doc_name || '#' || (row_number() OVER (PARTITION BY doc_name ORDER BY line_no) - 1)
                   AS chunk_id, doc_name, doc_id, chunk_text
        FROM (SELECT doc_name, doc_id, line_no,
                     regexp_replace(line, '^[\\s\\x0B\\x1C-\\x1F\\x{85}\\p{Z}]+|[\\s\\x0B\\x1C-\\x1F\\x{85}\\p{Z}]+$',
                                    '', 'g') AS chunk_text
              FROM (SELECT doc_name, doc_id, unnest(string_split(text, chr(10))) AS line,
                           generate_subscripts(string_split(text, chr(10)), 1) AS line_no
                    FROM doc))
        WHERE chunk_text <> ''""",
    "approved_chunk": """
        SELECT c.* FROM chunk c
        WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
          AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
}

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def _needed(sql: str, found: list[str]) -> list[str]:
    for word in dict.fromkeys(_WORD.findall(sql)):
        if word in VIEWS and word not in found:
            _needed(VIEWS[word], found)
            if word not in found:
                found.append(word)
    return found


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the definitions of the feeds it names."""
    names = _needed(sql, [])
    if not names:
        return sql
    views = ",\n".join(f"{name} AS ({VIEWS[name]}\n)" for name in names)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"
