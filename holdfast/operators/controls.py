"""Data-quality checks, reconciliations and alert states over the facts and result logs.

Each check yields rows of one shape: check name, source table, business date, run, metric,
threshold, passed. Checks that belong to a business date are computed for every date in the
input at once; filter the input to get a single day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.exact import ratio
from holdfast.operators.keys import latest_per_key

RESULT_COLUMNS = (
    "check_name", "source_table", "business_date", "pipeline_run_id", "job_run_id",
    "metric_value", "threshold", "passed",
)

# Fixed values
FRESHNESS_LIMIT_MINUTES = 1440.0
EXPOSURE_TOLERANCE = 0.1
SPIKE_FACTOR = 1.5
SPIKE_HISTORY = 7


def result_rows(
    df: DataFrame,
    check_name: str,
    source_table: str,
    business_date: Column,
    threshold: float | None = 0.0,
    passed: Column | None = None,
    pipeline_run_id: Column | None = None,
    job_run_id: str | None = None,
    check_timestamp: Column | None = None,
) -> DataFrame:
    """Result rows from a frame with ``metric``; passes when the metric equals 0 by default."""
    rows = df.select(
        F.lit(check_name).alias("check_name"),
        F.lit(source_table).alias("source_table"),
        business_date.cast("date").alias("business_date"),
        (F.lit(None) if pipeline_run_id is None else pipeline_run_id).cast("string")
        .alias("pipeline_run_id"),
        F.lit(job_run_id).cast("string").alias("job_run_id"),
        F.col("metric").cast("double").alias("metric_value"),
        F.lit(threshold).cast("double").alias("threshold"),
        (F.col("metric") == 0 if passed is None else passed).cast("boolean").alias("passed"),
    )
    if check_timestamp is None:
        return rows
    return rows.select(check_timestamp.alias("check_timestamp"), *RESULT_COLUMNS)


def _holdings_with_price_flag(holdings: DataFrame, prices: DataFrame) -> DataFrame:
    priced = prices.select(
        "investment_asset_id", F.col("price_date").alias("as_of_date"), F.lit(True).alias("_priced")
    ).distinct()
    return holdings.join(priced, ["investment_asset_id", "as_of_date"], "left")


# ---- data-quality checks ----------------------------------------------------------


def check_holdings_without_price(
    holdings: DataFrame, prices: DataFrame, business_date: str, job_run_id: str
) -> DataFrame:
    unpriced = _holdings_with_price_flag(holdings, prices).agg(
        F.count_if(F.col("_priced").isNull()).alias("metric")
    )
    return result_rows(
        unpriced, "holdings_without_price", "bronze.raw_investment_holdings_snapshot",
        F.lit(business_date), job_run_id=job_run_id,
    )


def check_quarantine_latest_run(
    quarantine: DataFrame, business_date: str, job_run_id: str
) -> DataFrame:
    """Quarantined rows of the run with the greatest id. Informational: no threshold."""
    newest = (
        quarantine.groupBy("pipeline_run_id")
        .agg(F.count("*").alias("metric"))
        .orderBy(F.col("pipeline_run_id").desc())
        .limit(1)
    )
    return result_rows(
        newest, "transaction_quarantine_count_latest_run", "silver.quarantine_transaction",
        F.lit(business_date), threshold=None, passed=F.lit(None).cast("boolean"),
        pipeline_run_id=F.col("pipeline_run_id"), job_run_id=job_run_id,
    )


def check_breach_count(breaches: DataFrame, business_date: str, job_run_id: str) -> DataFrame:
    """Number of breaches. A breach is business output, so the check always passes."""
    return result_rows(
        breaches.agg(F.count("*").alias("metric")), "limit_breach_count",
        "gold.fact_limit_breach", F.lit(business_date), passed=F.lit(True), job_run_id=job_run_id,
    )


def check_assets_missing_price(
    assets: DataFrame, prices: DataFrame, job_run_id: str, expected: DataFrame | None = None
) -> DataFrame:
    """Listed assets without a price, per date.

    ``expected`` (price_date) names the dates on which prices are due, such as those of the
    holdings: a date without any price then has a row, with every listed asset missing.
    """
    listed = (
        assets.filter(F.col("asset_type").startswith("LISTED"))
        .select("investment_asset_id")
        .distinct()
    )
    total = listed.agg(F.count("*").alias("n"))
    offered = prices.select("investment_asset_id", "price_date").distinct()
    if expected is not None:
        due = expected.select(F.lit(None).cast("string").alias("investment_asset_id"), "price_date")
        offered = offered.unionByName(due.distinct())
    missing = (
        offered
        .join(listed.withColumn("_listed", F.lit(True)), "investment_asset_id", "left")
        .groupBy("price_date")
        .agg(F.count("_listed").alias("priced"))
        .withColumn("metric", total.scalar() - F.col("priced"))
    )
    return result_rows(
        missing, "assets_missing_latest_price", "bronze.raw_investment_asset_master",
        F.col("price_date"), job_run_id=job_run_id,
    )


def rescued_rows(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Rescued rows per feed; a feed without the rescue column counts 0."""
    parts = []
    for name, df in feeds.items():
        counted = (
            F.count("_rescued_data") if "_rescued_data" in df.columns else F.lit(0).cast("bigint")
        )
        parts.append(
            df.agg(counted.alias("rescued")).select(F.lit(name).alias("feed"), "rescued")
        )
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total


def check_rescued_rows(
    feeds: Mapping[str, DataFrame], business_date: str, job_run_id: str
) -> DataFrame:
    return result_rows(
        rescued_rows(feeds).agg(F.sum("rescued").alias("metric")), "bronze_rescued_rows_count",
        "bronze.raw_*", F.lit(business_date), job_run_id=job_run_id,
    )


def check_freshness(
    transactions: DataFrame, as_of: str, business_date: str, job_run_id: str
) -> DataFrame:
    """Whole minutes from the newest ingest to ``as_of``."""
    newest = transactions.agg(F.max("_ingest_ts").cast("timestamp_ntz").alias("newest"))
    age = newest.withColumn(
        "metric", F.expr(f"timestampdiff(MINUTE, newest, TIMESTAMP_NTZ '{as_of}')")
    )
    return result_rows(
        age, "transaction_freshness_minutes", "bronze.raw_investment_transactions",
        F.lit(business_date), threshold=FRESHNESS_LIMIT_MINUTES,
        passed=F.col("metric") <= FRESHNESS_LIMIT_MINUTES, job_run_id=job_run_id,
    )


def check_quarantine_rate(rates: DataFrame, threshold: float, job_run_id: str) -> DataFrame:
    """One row per run from the per-run rates; the business date is the run's month end."""
    metric = rates.withColumn("metric", F.col("rate_pct"))
    return result_rows(
        metric, "transaction_quarantine_rate_pct", "silver.silver_transaction",
        F.col("business_date"), threshold=threshold, passed=F.col("metric") <= threshold,
        pipeline_run_id=F.col("pipeline_run_id"), job_run_id=job_run_id,
    )


def recent_checks(log: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Check rows not older than ``days`` before ``as_of``, and whether there is any."""
    cutoff = F.expr(f"TIMESTAMP_NTZ '{as_of}' - INTERVAL {int(days)} DAYS")
    return (
        log.filter(F.col("check_timestamp") >= cutoff)
        .agg(F.count("*").alias("recent_rows"))
        .withColumn("is_recent", F.col("recent_rows") > 0)
    )


def feed_readiness(feeds: Mapping[str, tuple[DataFrame, str]], business_date: str) -> DataFrame:
    """Whether each required feed has a row for the date, and whether all have."""
    parts = []
    for name, (df, date_column) in feeds.items():
        found = df.filter(F.col(date_column) == business_date).limit(1)
        parts.append(
            found.agg((F.count("*") > 0).alias("received")).select(
                F.lit(name).alias("feed"), "received"
            )
        )
    ready = parts[0]
    for part in parts[1:]:
        ready = ready.unionByName(part)
    return ready.withColumn(
        "all_feeds_ready", F.bool_and("received").over(Window.partitionBy(F.lit(1)))
    )


# ---- reconciliations --------------------------------------------------------------


def recon_balance(
    bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, job_run_id: str,
    deduplicated: bool = False,
) -> DataFrame:
    """|bronze - (silver + quarantine)| per business date.

    Landed rows include repeated ids; ``deduplicated`` counts distinct ids instead.
    """
    landed = bronze.select("transaction_id", F.col("transaction_date").alias("d"))
    if deduplicated:
        landed = landed.groupBy("transaction_id").agg(F.max("d").alias("d"))
    sides = (
        landed.select(F.col("d").cast("date").alias("d"), F.lit(1).alias("n"))
        .unionByName(silver.select(F.col("transaction_date").cast("date").alias("d"),
                                   F.lit(-1).alias("n")))
        .unionByName(quarantine.select(F.col("business_date").cast("date").alias("d"),
                                       F.lit(-1).alias("n")))
        .groupBy("d")
        .agg(F.abs(F.sum("n")).alias("metric"))
    )
    return result_rows(
        sides, "bronze_silver_quarantine_balance", "bronze.raw_investment_transactions",
        F.col("d"), job_run_id=job_run_id,
    )


def recon_balances(
    bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, job_run_id: str
) -> DataFrame:
    """Both balances of :func:`recon_balance` per business date, with ``variant``, from one pass over the landed rows.

    Landed rows are counted by id and date first; an id counts once, on its last date, in the deduplicated
    variant. What is left to add up with the other two tables is one row per date.
    """
    by_id = bronze.groupBy("transaction_id", F.col("transaction_date").alias("d")).agg(F.count("*").alias("landed"))
    last = F.row_number().over(Window.partitionBy("transaction_id").orderBy(F.col("d").desc_nulls_last())) == 1
    landed = by_id.withColumn("once", last.cast("int")).groupBy(F.col("d").cast("date").alias("d")).agg(
        F.sum("landed").alias("landed"), F.sum("once").alias("once")
    )
    none = F.lit(0).cast("bigint")
    out = [
        df.groupBy(F.col(c).cast("date").alias("d")).agg(F.count("*").alias("out"))
        for df, c in ((silver, "transaction_date"), (quarantine, "business_date"))
    ]
    parts = [landed.withColumn("out", none), *[o.select("d", none.alias("landed"), none.alias("once"), "out") for o in out]]
    sums = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("d").agg(
        *[F.sum(c).alias(c) for c in ("landed", "once", "out")]
    )
    # A date on which an id landed, but not for the last time, has no row in the deduplicated variant by itself
    variants = F.array(
        F.struct(F.lit("landed").alias("variant"), F.abs(F.col("landed") - F.col("out")).alias("metric"), F.lit(True).alias("there")),
        F.struct(F.lit("deduplicated").alias("variant"), F.abs(F.col("once") - F.col("out")).alias("metric"),
                 ((F.col("once") > 0) | (F.col("out") > 0)).alias("there")),
    )
    sides = sums.select("d", F.explode(variants).alias("v")).filter("v.there").select("d", "v.variant", "v.metric")
    rows = result_rows(
        sides, "bronze_silver_quarantine_balance", "bronze.raw_investment_transactions", F.col("d"),
        pipeline_run_id=F.col("variant"), job_run_id=job_run_id,
    )
    return rows.withColumns({"variant": F.col("pipeline_run_id"), "pipeline_run_id": F.lit(None).cast("string")})


def recon_duplicate_keys(
    df: DataFrame, key: str, source_table: str, business_date: str, job_run_id: str
) -> DataFrame:
    repeated = (
        df.groupBy(key)
        .agg(F.count("*").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("metric"))
    )
    return result_rows(
        repeated, "silver_duplicate_transaction_ids", source_table, F.lit(business_date),
        job_run_id=job_run_id,
    )


def recon_missing_price(holdings: DataFrame, prices: DataFrame, job_run_id: str) -> DataFrame:
    """Distinct holdings (portfolio, asset) without a price, per date."""
    distinct = holdings.select("portfolio_id", "investment_asset_id", "as_of_date").distinct()
    missing = (
        _holdings_with_price_flag(distinct, prices)
        .groupBy("as_of_date")
        .agg(F.count_if(F.col("_priced").isNull()).alias("metric"))
    )
    return result_rows(
        missing, "holdings_missing_price", "bronze.raw_investment_holdings_snapshot",
        F.col("as_of_date"), job_run_id=job_run_id,
    )


def recon_missing_asset(holdings: DataFrame, assets: DataFrame, job_run_id: str) -> DataFrame:
    """Holdings whose asset is absent from the master, per date.

    Counted per (date, asset) first: the join then moves counts and not holdings.
    """
    known = assets.select("investment_asset_id").distinct().withColumn("_known", F.lit(True))
    missing = (
        holdings.groupBy("as_of_date", "investment_asset_id")
        .agg(F.count("*").alias("n"))
        .join(known, "investment_asset_id", "left")
        .groupBy("as_of_date")
        .agg(F.sum(F.when(F.col("_known").isNull(), F.col("n")).otherwise(0)).alias("metric"))
    )
    return result_rows(
        missing, "holdings_missing_asset_master", "bronze.raw_investment_holdings_snapshot",
        F.col("as_of_date"), job_run_id=job_run_id,
    )


def recon_exposure_total(exposures: DataFrame, job_run_id: str) -> DataFrame:
    """Portfolios whose shares do not add up to 100, per date."""
    total = F.sum(F.col("exposure_pct").cast("decimal(18,4)"))
    off = (
        exposures.groupBy("portfolio_id", "as_of_date")
        .agg(total.alias("total_pct"))
        .groupBy("as_of_date")
        .agg(F.count_if(F.abs(F.col("total_pct") - 100) > EXPOSURE_TOLERANCE).alias("metric"))
    )
    return result_rows(
        off, "exposure_totals_not_100pct", "gold.fact_portfolio_exposure", F.col("as_of_date"),
        job_run_id=job_run_id,
    )


def recon_breach_consistent(breaches: DataFrame, job_run_id: str) -> DataFrame:
    """Breach rows that do not exceed their limit, per date."""
    wrong = breaches.groupBy("as_of_date").agg(
        F.count_if(~(F.col("exposure_pct") > F.col("max_pct"))).alias("metric")
    )
    return result_rows(
        wrong, "breach_rows_inconsistent_with_limit", "gold.fact_limit_breach",
        F.col("as_of_date"), job_run_id=job_run_id,
    )


def recon_feed_freshness(
    feeds: Mapping[str, tuple[DataFrame, str]], business_date: str, job_run_id: str
) -> DataFrame:
    """Feeds whose newest date is not the business date; a feed without rows is stale."""
    newest = None
    for df, date_column in feeds.values():
        part = df.agg(F.max(date_column).alias("newest"))
        newest = part if newest is None else newest.unionByName(part)
    stale = newest.agg(
        F.count_if(~F.col("newest").eqNullSafe(F.lit(business_date))).alias("metric")
    )
    return result_rows(
        stale, "feed_date_freshness",
        "bronze.raw_listed_market_prices,bronze.raw_investment_holdings_snapshot",
        F.lit(business_date), job_run_id=job_run_id,
    )


def compare_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in both, only left, only right, by key set; equal sets have two zeros."""
    sides = (
        left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r"))
        .unionByName(right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))
        .groupBy(*keys)
        .agg(F.max("l").alias("l"), F.max("r").alias("r"))
    )
    both = (F.col("l") == 1) & (F.col("r") == 1)
    return sides.agg(
        F.count_if(both).alias("in_both"),
        F.count_if(F.col("r") == 0).alias("only_left"),
        F.count_if(F.col("l") == 0).alias("only_right"),
    )


# ---- result log and alerts --------------------------------------------------------

# Alert rules, check name and the value above which it fires
ALERT_RULES = (
    ("bronze_rescued_rows_count", 0.0),
    ("transaction_quarantine_rate_pct", 2.0),
    ("assets_missing_latest_price", 0.0),
    ("transaction_freshness_minutes", 1440.0),
    ("expectation_failed_records", 0.0),
)

_NEWEST_CHECK = ("check_timestamp", "job_run_id")


def latest_results(log: DataFrame, n: int = 1, rank: str | None = None) -> DataFrame:
    """The newest ``n`` results of each check."""
    newest = [F.col(c).desc() for c in _NEWEST_CHECK]
    return latest_per_key(log, ["check_name"], newest, n, rank)


def alert_states(log: DataFrame) -> DataFrame:
    """State of every alert rule on the newest metric: FIRING, OK, or NO_DATA."""
    rules = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("check_name"), F.lit(limit).alias("alert_above"))
                for name, limit in ALERT_RULES
            ]
        )
    )
    spark = log.sparkSession
    table = spark.range(1).select(rules.alias("r")).select("r.check_name", "r.alert_above")
    newest = latest_results(log).select("check_name", "metric_value")
    value = F.col("metric_value")
    return table.join(newest, "check_name", "left").withColumn(
        "state",
        F.when(value.isNull(), "NO_DATA")
        .when(value > F.col("alert_above"), "FIRING")
        .otherwise("OK"),
    )


def breach_spike(log: DataFrame) -> DataFrame:
    """Per check: is the newest value above 1.5 times the mean of the seven before it?

    Only the newest eight results per check leave a task; no history means a mean of 0.
    """
    ranked = latest_results(log, SPIKE_HISTORY + 1, rank="rn").withColumn(
        "v", F.col("metric_value").cast("decimal(18,4)")
    )
    history = F.when(F.col("rn").between(2, SPIKE_HISTORY + 1), F.col("v"))
    mean = F.coalesce(ratio(F.sum(history), F.count(history)), F.lit(0.0))
    return (
        ranked.groupBy("check_name")
        .agg(
            F.max(F.when(F.col("rn") == 1, F.col("metric_value"))).alias("newest_value"),
            mean.alias("history_mean"),
        )
        .withColumn(
            "spike",
            F.when(F.col("newest_value") > SPIKE_FACTOR * F.col("history_mean"), 1).otherwise(0),
        )
    )


def failure_trend(log: DataFrame, since: str) -> DataFrame:
    """Failed checks per day with the names of the failing checks, in order."""
    return (
        log.filter(~F.col("passed"))
        .filter(F.col("check_timestamp") >= F.lit(since).cast("timestamp_ntz"))
        .groupBy(F.to_date("check_timestamp").alias("day"))
        .agg(
            F.count("*").alias("failed_checks"),
            F.array_join(F.array_sort(F.collect_set("check_name")), ",").alias(
                "failing_check_names"
            ),
        )
    )


def quarantine_rate_trend(log: DataFrame) -> DataFrame:
    return (
        log.filter(F.col("check_name") == "transaction_quarantine_rate_pct")
        .groupBy(F.to_date("check_timestamp").alias("day"))
        .agg(F.max("metric_value").alias("quarantine_rate_pct"))
    )


def pipeline_metrics(
    conformed: DataFrame,
    breaches: DataFrame,
    feeds: Mapping[str, DataFrame],
    duration_seconds: int,
    job: str,
) -> DataFrame:
    """Run metrics as (metric, value, job) rows, from one row of counters."""
    bad = F.col("dq_reason").isNotNull()
    rate = F.coalesce(
        F.round((ratio(F.count_if(bad), F.count("*")) * 100).cast("decimal(28,10)"), 4)
        .cast("double"),
        F.lit(0.0),
    )
    names = (
        "rows_in", "rows_valid", "rows_quarantined", "quarantine_rate_pct", "duration_seconds",
        "breach_count", "bronze_rescued_rows",
    )
    breach_count = breaches.agg(F.count("*").alias("n")).scalar()
    rescued = rescued_rows(feeds).agg(F.sum("rescued").alias("n")).scalar()
    one_row = conformed.agg(
        F.count("*").cast("double").alias("rows_in"),
        F.count_if(~bad).cast("double").alias("rows_valid"),
        F.count_if(bad).cast("double").alias("rows_quarantined"),
        rate.alias("quarantine_rate_pct"),
    ).select(
        "*",
        F.lit(float(max(duration_seconds, 0))).alias("duration_seconds"),
        breach_count.cast("double").alias("breach_count"),
        rescued.cast("double").alias("bronze_rescued_rows"),
    )
    return one_row.unpivot([], list(names), "metric", "value").withColumn("job", F.lit(job))


def event_log_failures(event_log: DataFrame) -> DataFrame:
    """Failed records per expectation from progress events that carry JSON details."""
    expectation = F.from_json(
        F.get_json_object("details", "$.flow_progress.data_quality.expectations"),
        "array<struct<name:string,failed_records:bigint>>",
    )
    return (
        event_log.filter(F.col("event_type") == "flow_progress")
        .select(F.explode(expectation).alias("e"))
        .groupBy(F.col("e.name").alias("expectation"))
        .agg(F.sum("e.failed_records").alias("failed_records"))
    )
