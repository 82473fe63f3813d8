"""Tiered data quality for transactions: FAIL stops, QUARANTINE sets aside, WARN counts."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.exact import share_pct
from holdfast.functions.text import is_blank, shown
from holdfast.operators.keys import dedupe_latest, mark_known

# Fixed values
VALID_TRANSACTION_TYPES = ("BUY", "SELL", "ACQUISITION", "DISPOSAL")
MANDATORY_KEYS = ("transaction_id",)
QUARANTINE_RATE_THRESHOLD = 2.0
REASON_SEPARATOR = "; "
LINEAGE_COLUMNS = (
    "quarantine_reason",
    "source_table",
    "source_file",
    "ingestion_ts",
    "business_date",
    "pipeline_run_id",
    "job_run_id",
    "check_timestamp",
    "raw_payload",
)


class MandatoryKeyError(ValueError):
    """A mandatory key is missing: the run must stop."""


class Rule(NamedTuple):
    """A row rule. ``failed`` is never NULL; ``detail`` says what was wrong."""

    name: str
    tier: str
    failed: Column
    detail: Column


def _or_failed(condition: Column) -> Column:
    """A comparison with NULL counts as failed, so no row falls between valid and bad."""
    return F.coalesce(condition, F.lit(True))


def transaction_rules() -> list[Rule]:
    """Rules on one transaction, in reporting order. Needs ``portfolio_known``, ``asset_known``."""
    quantity = F.col("quantity")
    kind = F.col("transaction_type")
    return [
        Rule(
            "transaction_id_present",
            "QUARANTINE",
            is_blank(F.col("transaction_id")),
            F.lit("missing transaction_id"),
        ),
        Rule(
            "known_portfolio",
            "QUARANTINE",
            ~F.col("portfolio_known"),
            F.concat(F.lit("unknown portfolio_id="), shown(F.col("portfolio_id"))),
        ),
        Rule(
            "known_asset",
            "QUARANTINE",
            ~F.col("asset_known"),
            F.concat(F.lit("unknown investment_asset_id="), shown(F.col("investment_asset_id"))),
        ),
        Rule(
            "positive_quantity",
            "QUARANTINE",
            _or_failed(quantity <= 0),
            F.when(quantity.isNull(), "non-numeric quantity").otherwise(
                F.concat(F.lit("non-positive quantity="), quantity.cast("string"))
            ),
        ),
        Rule(
            "valid_transaction_type",
            "QUARANTINE",
            _or_failed(~kind.isin(*VALID_TRANSACTION_TYPES)),
            F.concat(F.lit("invalid transaction_type="), shown(kind)),
        ),
    ]


def with_known_keys(transactions: DataFrame, portfolios: DataFrame, assets: DataFrame) -> DataFrame:
    known = mark_known(
        transactions, "investment_asset_id", assets, "investment_asset_id", "asset_known"
    )
    return mark_known(known, "portfolio_id", portfolios, "portfolio_id", "portfolio_known")


def with_reasons(
    transactions: DataFrame,
    portfolios: DataFrame,
    assets: DataFrame,
    rules: Sequence[Rule] | None = None,
) -> DataFrame:
    """Every row with ``_dq_reasons``, the texts of the rules it breaks (empty when valid)."""
    chosen = transaction_rules() if rules is None else rules
    texts = F.array(*[F.when(rule.failed, rule.detail) for rule in chosen])
    return (
        with_known_keys(transactions, portfolios, assets)
        .withColumn("_dq_reasons", F.filter(texts, lambda text: text.isNotNull()))
        .drop("asset_known", "portfolio_known")
    )


def valid_rows(reasoned: DataFrame) -> DataFrame:
    return reasoned.filter(F.size("_dq_reasons") == 0).drop("_dq_reasons")


def quarantined_rows(reasoned: DataFrame) -> DataFrame:
    """Rows that break a rule, with the reasons joined to one text."""
    return reasoned.filter(F.size("_dq_reasons") > 0).withColumn(
        "quarantine_reason", F.array_join("_dq_reasons", REASON_SEPARATOR)
    )


def rule_failures(transactions: DataFrame, portfolios: DataFrame, assets: DataFrame) -> DataFrame:
    """Failed rows per rule, from one pass over the transactions."""
    rules = transaction_rules()
    counted = with_known_keys(transactions, portfolios, assets).agg(
        *[F.count_if(rule.failed).alias(rule.name) for rule in rules]
    )
    return counted.unpivot([], [r.name for r in rules], "rule", "failed_rows")


def mandatory_key_counts(df: DataFrame, keys: Sequence[str] = MANDATORY_KEYS) -> DataFrame:
    """Rows per mandatory key in which it is NULL or empty."""
    counted = df.agg(*[F.count_if(is_blank(F.col(key))).alias(key) for key in keys])
    return counted.unpivot([], list(keys), "mandatory_key", "missing_rows").withColumn(
        "gate_passed", F.col("missing_rows") == 0
    )


def enforce_mandatory_keys(df: DataFrame, keys: Sequence[str] = MANDATORY_KEYS) -> DataFrame:
    """Return ``df`` unchanged, or raise when a mandatory key is missing anywhere."""
    for row in mandatory_key_counts(df, keys).filter("NOT gate_passed").collect():
        raise MandatoryKeyError(
            f"{row.missing_rows} row(s) missing mandatory key '{row.mandatory_key}'"
        )
    return df


def run_with_policy(
    transactions: DataFrame,
    portfolios: DataFrame,
    assets: DataFrame,
    keys: Sequence[str] = MANDATORY_KEYS,
) -> tuple[DataFrame, DataFrame]:
    """FAIL gate, then the split into valid and quarantined rows."""
    reasoned = with_reasons(enforce_mandatory_keys(transactions, keys), portfolios, assets)
    return valid_rows(reasoned), quarantined_rows(reasoned)


# ---- production flags -------------------------------------------------------------

FLAG_CODES = {
    "bad_asset": "bad_asset",
    "bad_portfolio": "bad_portfolio",
    "bad_quantity": "bad_quantity",
    "bad_type": "bad_type",
    "bad_schema": "schema_drift",
}


def with_flags(transactions: DataFrame, portfolios: DataFrame, assets: DataFrame) -> DataFrame:
    """Five rule flags and the joined reason codes; the reason is NULL on a valid row."""
    drifted = (
        F.col("_rescued_data").isNotNull()
        if "_rescued_data" in transactions.columns
        else F.lit(False)
    )
    flagged = (
        with_known_keys(transactions, portfolios, assets)
        .withColumns(
            {
                "bad_asset": ~F.col("asset_known"),
                "bad_portfolio": ~F.col("portfolio_known"),
                "bad_quantity": _or_failed(F.col("quantity") <= 0),
                "bad_type": _or_failed(~F.col("transaction_type").isin(*VALID_TRANSACTION_TYPES)),
                "bad_schema": drifted,
            }
        )
        .drop("asset_known", "portfolio_known")
    )
    codes = F.concat_ws(
        REASON_SEPARATOR, *[F.when(F.col(flag), code) for flag, code in FLAG_CODES.items()]
    )
    return flagged.withColumn("dq_reason", F.nullif(codes, F.lit("")))


def conform(transactions: DataFrame, portfolios: DataFrame, assets: DataFrame) -> DataFrame:
    """Deduplicated, flagged transactions: the common input of silver and quarantine."""
    return with_flags(
        dedupe_latest(transactions, ["transaction_id"], "_ingest_ts"), portfolios, assets
    )


def silver_rows(conformed: DataFrame) -> DataFrame:
    return conformed.filter(F.col("dq_reason").isNull()).drop("dq_reason", *FLAG_CODES)


def quarantine_log(
    conformed: DataFrame,
    source_table: str,
    business_date: Column,
    pipeline_run_id: Column,
    job_run_id: Column,
    check_timestamp: Column | None = None,
) -> DataFrame:
    """Quarantined rows with lineage and the full row as JSON, ready for replay."""
    payload = [c for c in conformed.columns if c != "dq_reason" and c not in FLAG_CODES]
    names = set(conformed.columns)
    now = F.current_timestamp() if check_timestamp is None else check_timestamp
    return (
        conformed.filter(F.col("dq_reason").isNotNull())
        .withColumns(
            {
                "quarantine_reason": F.col("dq_reason"),
                "source_table": F.lit(source_table),
                "source_file": F.col("_source_file")
                if "_source_file" in names
                else F.lit(None).cast("string"),
                "ingestion_ts": F.col("_ingest_ts") if "_ingest_ts" in names else now,
                "business_date": business_date.cast("date"),
                "pipeline_run_id": pipeline_run_id,
                "job_run_id": job_run_id,
                "check_timestamp": now,
                "raw_payload": F.to_json(F.struct(*payload)),
            }
        )
        .drop("dq_reason", *FLAG_CODES)
    )


def replay(quarantine: DataFrame, schema, portfolios: DataFrame, assets: DataFrame) -> DataFrame:
    """Judge quarantined rows again from their payload, against repaired reference data."""
    rows = quarantine.select(F.from_json("raw_payload", schema).alias("row")).select("row.*")
    return with_flags(rows, portfolios, assets)


# ---- rates and counts -------------------------------------------------------------


def rate_pct(quarantined: Column, valid: Column) -> Column:
    """Quarantined share in percent, 0 when there are no rows."""
    return F.coalesce(share_pct(quarantined, quarantined + valid), F.lit(0.0))


def quarantine_rate(conformed: DataFrame, pipeline_run_id: Column) -> DataFrame:
    """Valid and quarantined rows and the rate, per run, in one aggregate."""
    bad = F.col("dq_reason").isNotNull()
    return (
        conformed.groupBy(pipeline_run_id.alias("pipeline_run_id"))
        .agg(F.count_if(~bad).alias("valid_rows"), F.count_if(bad).alias("quarantined_rows"))
        .withColumn("rate_pct", rate_pct(F.col("quarantined_rows"), F.col("valid_rows")))
    )


def quarantine_rate_for_run(
    quarantine: DataFrame, valid_count: Column, pipeline_run_id: Column
) -> DataFrame:
    """Rate of one run, ignoring the other runs kept in the append-only log."""
    return (
        quarantine.filter(F.col("pipeline_run_id") == pipeline_run_id)
        .agg(F.count("*").alias("quarantined_rows"))
        .withColumn("valid_rows", valid_count)
        .withColumn("rate_pct", rate_pct(F.col("quarantined_rows"), F.col("valid_rows")))
    )


def quarantine_reasons(quarantine: DataFrame) -> DataFrame:
    """Rows per run and single reason code; a row with two reasons counts under both."""
    return (
        quarantine.groupBy("pipeline_run_id", "quarantine_reason")
        .agg(F.count("*").alias("n"))
        .withColumn("reason", F.explode(F.split("quarantine_reason", REASON_SEPARATOR)))
        .groupBy("pipeline_run_id", "reason")
        .agg(F.sum("n").alias("quarantined_rows"))
    )


def counterparty_warnings(transactions: DataFrame, counterparties: DataFrame) -> DataFrame:
    """WARN tier: rows with a missing or unknown counterparty; all rows are kept."""
    used = transactions.groupBy("counterparty_id").agg(F.count("*").alias("n"))
    known = mark_known(used, "counterparty_id", counterparties, "counterparty_id", "known")
    missing = is_blank(F.col("counterparty_id"))
    return known.agg(
        F.sum("n").alias("total_rows"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("missing_counterparty"),
        F.coalesce(F.sum(F.when(~missing & ~F.col("known"), F.col("n"))), F.lit(0)).alias(
            "unknown_counterparty"
        ),
    )
