"""Governance and operations queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.operators import generator, governance, operations, profiling, quality, valuation
from holdfast.plans import quality as quality_plans
from holdfast.plans import valuation as valuation_plans
from holdfast.plans.registry import query
from holdfast.session import work_dir
from holdfast.sources import market

# Parameters of the registered reports; the windows cover the whole tables
PM_USER = "pm3@example.com"
USAGE_SINCE, USAGE_UNTIL = "1995-01-01", "2001-12-31"
LOG_SINCE = "2024-01-01"


@query(
    "row_filter",
    f"""SELECT portfolio_id, sector, exposure_pct, as_of_date FROM expo
        WHERE portfolio_id IN (SELECT portfolio_id FROM pm_map WHERE pm_user = '{PM_USER}')""",
)
def row_filter(spark, folder):
    exposures = valuation.exposure(valuation_plans.fact(spark, folder)).select(
        "portfolio_id", "sector", "exposure_pct", "as_of_date"
    )
    return governance.apply_row_filter(
        exposures, PM_USER, [], market.portfolio_access(spark, folder)
    )


@query(
    "column_mask",
    """SELECT transaction_id, counterparty_id AS seen_by_engineer,
              '***MASKED***' AS seen_by_others FROM silver""",
)
def column_mask(spark, folder):
    silver = quality.silver_rows(quality_plans.conformed(spark, folder)).select(
        "transaction_id",
        F.col("counterparty_id").alias("seen_by_engineer"),
        F.col("counterparty_id").alias("seen_by_others"),
    )
    unmasked = governance.apply_column_mask(silver, "seen_by_engineer", ["engineers"])
    return governance.apply_column_mask(unmasked, "seen_by_others", ["analysts"])


@query(
    "audit_actions",
    f"""SELECT event_time, actor, service_name, action_name, request_params FROM audit
        WHERE event_date >= DATE '{LOG_SINCE}'
          AND (action_name ILIKE '%Grant%' OR action_name ILIKE '%Permission%')
        ORDER BY event_time DESC, event_id DESC LIMIT 200""",
)
def audit_actions(spark, folder):
    return governance.permission_changes(market.audit_log(spark, folder), LOG_SINCE)


@query(
    "failed_logins",
    f"""SELECT event_time, actor, source_ip_address, action_name, status_code, error_message
        FROM audit WHERE event_date >= DATE '{LOG_SINCE}' AND action_name ILIKE '%login%'
          AND (status_code <> 200 OR error_message IS NOT NULL)
        ORDER BY event_time DESC, event_id DESC LIMIT 200""",
)
def failed_logins(spark, folder):
    return governance.failed_logins(market.audit_log(spark, folder), LOG_SINCE)


_NAMED = "LEFT JOIN job j ON t.job_id = j.job_id AND t.workspace_id = j.workspace_id"
_WORKFLOW = "coalesce(j.name, t.job_id::VARCHAR) AS workflow"


@query(
    "job_runs_daily",
    f"""SELECT t.period_start_time::DATE AS run_day, {_WORKFLOW}, count(*) AS total_runs,
               count(*) FILTER (t.result_state IN ('FAILED', 'TIMED_OUT', 'INTERNAL_ERROR'))
                   AS failed_runs
        FROM job_run t {_NAMED} WHERE t.period_start_time >= TIMESTAMP '{LOG_SINCE}'
        GROUP BY 1, 2""",
)
def job_runs_daily(spark, folder):
    return operations.job_runs_daily(
        market.job_runs(spark, folder), market.jobs(spark, folder), LOG_SINCE
    )


@query(
    "job_duration_trend",
    f"""SELECT t.period_start_time::DATE AS run_day, {_WORKFLOW},
               round(CAST(sum(datediff_s)::DOUBLE / count(*)::DOUBLE / 60
                          AS DECIMAL(28,10)), 2)::DOUBLE AS avg_duration_min
        FROM (SELECT *, (epoch_us(period_end_time) - epoch_us(period_start_time)) // 1000000
                     AS datediff_s FROM job_run) t {_NAMED}
        WHERE t.period_end_time IS NOT NULL AND t.period_start_time >= TIMESTAMP '{LOG_SINCE}'
        GROUP BY 1, 2""",
)
def job_duration_trend(spark, folder):
    return operations.job_duration_trend(
        market.job_runs(spark, folder), market.jobs(spark, folder), LOG_SINCE
    )


@query(
    "failed_runs",
    f"""SELECT {_WORKFLOW}, t.job_id, t.run_id, t.result_state, t.period_start_time,
               t.period_end_time
        FROM job_run t {_NAMED}
        WHERE t.result_state IN ('FAILED', 'TIMED_OUT', 'INTERNAL_ERROR')
          AND t.period_start_time >= TIMESTAMP '{LOG_SINCE}'
        ORDER BY t.period_start_time DESC, t.run_id DESC LIMIT 200""",
)
def failed_runs(spark, folder):
    return operations.failed_runs(
        market.job_runs(spark, folder), market.jobs(spark, folder), LOG_SINCE
    )


@query(
    "recent_runs",
    f"""SELECT {_WORKFLOW}, t.job_id, t.run_id, t.result_state, t.period_start_time,
               t.period_end_time
        FROM job_run t {_NAMED}
        ORDER BY t.period_start_time DESC, t.run_id DESC LIMIT 100""",
)
def recent_runs(spark, folder):
    return operations.recent_runs(market.job_runs(spark, folder), market.jobs(spark, folder))


def _usage_sql(keys, condition="true"):
    return f"""SELECT {keys}, round(sum(usage_quantity::DECIMAL(18,4)), 2)::DOUBLE AS dbus
        FROM usg WHERE usage_date >= DATE '{USAGE_SINCE}' AND ({condition}) GROUP BY ALL"""


@query("usage_daily", _usage_sql("usage_date, sku_name"))
def usage_daily(spark, folder):
    return operations.usage_by(
        market.usage(spark, folder), ["usage_date", "sku_name"], USAGE_SINCE
    )


@query("usage_serverless", _usage_sql("usage_date, sku_name", "sku_name ILIKE '%SERVERLESS%'"))
def usage_serverless(spark, folder):
    return operations.usage_by(
        market.usage(spark, folder), ["usage_date", "sku_name"], USAGE_SINCE, ["%SERVERLESS%"]
    )


@query(
    "usage_by_warehouse",
    _usage_sql("usage_date, warehouse_id, sku_name", "sku_name ILIKE '%SQL%'"),
)
def usage_by_warehouse(spark, folder):
    warehouse = F.col("usage_metadata.warehouse_id").alias("warehouse_id")
    return operations.usage_by(
        market.usage(spark, folder), ["usage_date", warehouse, "sku_name"], USAGE_SINCE, ["%SQL%"]
    )


@query(
    "usage_vector_search",
    _usage_sql("usage_date, sku_name", "sku_name ILIKE '%VECTOR%' OR sku_name ILIKE '%SEARCH%'"),
)
def usage_vector_search(spark, folder):
    return operations.usage_by(
        market.usage(spark, folder), ["usage_date", "sku_name"], USAGE_SINCE,
        ["%VECTOR%", "%SEARCH%"],
    )


@query(
    "usage_by_workflow",
    f"""SELECT {_WORKFLOW}, t.sku_name,
               round(sum(t.usage_quantity::DECIMAL(18,4)), 2)::DOUBLE AS total_dbus
        FROM usg t {_NAMED} WHERE t.usage_date >= DATE '{USAGE_SINCE}'
          AND (t.job_id IS NOT NULL OR t.sku_name ILIKE '%JOBS%') GROUP BY 1, 2""",
)
def usage_by_workflow(spark, folder):
    return operations.usage_by_workflow(
        market.usage(spark, folder), market.jobs(spark, folder), USAGE_SINCE
    )


@query(
    "usage_week_change",
    f"""WITH w AS (
          SELECT sku_name,
                 floor((DATE '{USAGE_UNTIL}' - usage_date) / 7)::INT AS weeks_ago,
                 sum(usage_quantity::DECIMAL(18,4)) AS q
          FROM usg WHERE usage_date <= DATE '{USAGE_UNTIL}' GROUP BY ALL)
        SELECT a.sku_name, a.weeks_ago, round(a.q, 2)::DOUBLE AS last_7,
               round(b.q, 2)::DOUBLE AS prev_7,
               round(CAST((a.q - b.q)::DOUBLE / b.q::DOUBLE * 100 AS DECIMAL(28,10)), 1)::DOUBLE
                   AS pct_change
        FROM w a LEFT JOIN w b ON b.sku_name = a.sku_name AND b.weeks_ago = a.weeks_ago + 1
        WHERE a.q > coalesce(b.q, 0) * 1.5""",
)
def usage_week_change(spark, folder):
    return operations.usage_week_change(market.usage(spark, folder), USAGE_UNTIL)


@query(
    "priced_usage",
    f"""WITH priced AS (
          SELECT u.job_id, u.workspace_id, u.usage_quantity::DECIMAL(18,4) * p.unit_price AS cost
          FROM usg u JOIN listprice p
            ON u.sku_name = p.sku_name AND u.usage_unit = p.usage_unit
           AND u.usage_end_time >= p.price_start_time
           AND (p.price_end_time IS NULL OR u.usage_end_time < p.price_end_time)
          WHERE u.usage_date BETWEEN DATE '{USAGE_SINCE}' AND DATE '{USAGE_UNTIL}'
            AND u.job_id IS NOT NULL)
        SELECT {_WORKFLOW}, round(sum(t.cost), 2)::DOUBLE AS cost_usd
        FROM priced t {_NAMED} GROUP BY 1 ORDER BY cost_usd DESC, workflow LIMIT 20""",
)
def priced_usage(spark, folder):
    return operations.top_cost(
        market.usage(spark, folder), market.list_prices(spark, folder), market.jobs(spark, folder),
        USAGE_SINCE, USAGE_UNTIL,
    )


def _profile_number(column, view="fact"):
    value = f"{column}::DECIMAL(18,4)"
    mean = f"sum({value})::DOUBLE / count({column})::DOUBLE"
    wide = f"{column}::DECIMAL(19,4)"
    squares = f"sum({wide} * {wide})::DOUBLE"
    variance = (
        f"({squares} - sum({value})::DOUBLE * sum({value})::DOUBLE / count({column})::DOUBLE)"
        f" / (count({column})::DOUBLE - 1)"
    )
    return f"""SELECT '{column}' AS column_name, count(*) AS row_count,
        count(*) - count({column}) AS null_count, count(DISTINCT {column}) AS distinct_count,
        min({column})::DOUBLE AS min_number, max({column})::DOUBLE AS max_number,
        NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text,
        round(CAST({mean} AS DECIMAL(28,10)), 4)::DOUBLE AS mean,
        round(CAST(sqrt(greatest({variance}, 0)) AS DECIMAL(28,10)), 4)::DOUBLE AS stddev
        FROM {view}"""


def _profile_text(column, view="fact"):
    return f"""SELECT '{column}', count(*), count(*) - count({column}), count(DISTINCT {column}),
        NULL, NULL, min({column}), max({column}), NULL, NULL FROM {view}"""


_FACT_NUMBERS = ("quantity", "close_price")
_FACT_TEXT = ("portfolio_id", "sector", "issuer_id")


@query(
    "profile_table",
    " UNION ALL ".join(
        [_profile_number(c) for c in _FACT_NUMBERS] + [_profile_text(c) for c in _FACT_TEXT]
    ),
)
def profile_table(spark, folder):
    return profiling.profile_table(valuation_plans.fact(spark, folder), _FACT_NUMBERS, _FACT_TEXT)


def _quantile(column):
    return f"""SELECT '{column}' AS column_name, min(v) FILTER (r >= ceil(t * 0.25)) AS p25,
        min(v) FILTER (r >= ceil(t * 0.5)) AS p50, min(v) FILTER (r >= ceil(t * 0.75)) AS p75
        FROM (SELECT v, row_number() OVER (ORDER BY v) AS r, count(*) OVER () AS t
              FROM (SELECT {column}::DOUBLE AS v FROM fact WHERE {column} IS NOT NULL))"""


@query("profile_quantiles", " UNION ALL ".join(_quantile(c) for c in _FACT_NUMBERS))
def profile_quantiles(spark, folder):
    """The numbers of the fact are written once, as the quantiles read them three times."""
    path = work_dir(spark, "profile-quantiles")
    numbers = valuation_plans.fact(spark, folder).select(*_FACT_NUMBERS)
    numbers.write.parquet(path)
    return profiling.exact_quantiles(spark.read.schema(numbers.schema).parquet(path), _FACT_NUMBERS, (0.25, 0.5, 0.75))


def _slice(column):
    value = f"{column}::DECIMAL(18,4)"
    return f"""SELECT as_of_date, '{column}' AS column_name, count(*) AS row_count,
        count(*) - count({column}) AS null_count,
        round(CAST(sum({value})::DOUBLE / count({column})::DOUBLE AS DECIMAL(28,10)), 4)::DOUBLE
            AS mean
        FROM fact GROUP BY as_of_date"""


@query(
    "profile_drift",
    f"""WITH p AS ({_slice("quantity")} UNION ALL {_slice("close_price")})
        SELECT as_of_date, column_name,
               row_count - lag(row_count) OVER w AS row_count_change,
               null_count - lag(null_count) OVER w AS null_count_change,
               round(CAST((mean - lag(mean) OVER w) / lag(mean) OVER w * 100
                          AS DECIMAL(28,10)), 2)::DOUBLE AS mean_change_pct
        FROM p WINDOW w AS (PARTITION BY column_name ORDER BY as_of_date)""",
)
def profile_drift(spark, folder):
    slices = profiling.profile_slices(
        valuation_plans.fact(spark, folder), "as_of_date", _FACT_NUMBERS
    )
    return profiling.profile_drift(slices, "as_of_date")


@query(
    "entity_calendar_grid",
    """WITH span AS (
         SELECT l_partkey AS entity_id, date_trunc('month', min(l_shipdate))::DATE AS a,
                date_trunc('month', max(l_shipdate))::DATE AS z
         FROM lineitem GROUP BY 1),
       grid AS (
         SELECT entity_id, a, unnest(generate_series(a::TIMESTAMP, z::TIMESTAMP,
                                                     INTERVAL 1 MONTH))::DATE AS grid_month
         FROM span)
       SELECT entity_id, datediff('month', a, grid_month)::INT AS step, grid_month,
              (100 + 25 * ((7 * entity_id + datediff('month', a, grid_month)
                            * datediff('month', a, grid_month)) % 12))::DOUBLE AS grid_value
       FROM grid""",
)
def entity_calendar_grid(spark, folder):
    activity = market.table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("entity_id"), "l_shipdate"
    )
    level = lambda step: (
        F.lit(100) + F.lit(25) * ((F.col("entity_id") * 7 + step * step) % 12)
    ).cast("double")
    return generator.entity_calendar_grid(activity, "entity_id", "l_shipdate", level)
