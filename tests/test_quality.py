"""Rule tiers, reasons, rates, contracts and name cleaning."""

import pytest
from pyspark.sql import functions as F

from holdfast.functions.access import masked
from holdfast.functions.text import metric_name
from holdfast.operators import contracts, quality
from holdfast.sources.schemas import FORMATS, SCHEMAS, missing_columns, validate_columns

COLUMNS = ("transaction_id string, portfolio_id string, investment_asset_id string, "
           "transaction_type string, quantity double")
CLEAN = dict(transaction_id="T1", portfolio_id="GULF_EQ", investment_asset_id="AE_ENBD",
             transaction_type="BUY", quantity=100.0)


@pytest.fixture(scope="module")
def masters(spark):
    return (
        spark.createDataFrame([("GULF_EQ",), ("INCOME_FI",)], "portfolio_id string"),
        spark.createDataFrame([("AE_ENBD",), ("AE_DIB_SUK",)], "investment_asset_id string"),
    )


def _row(spark, **changed):
    row = {**CLEAN, **changed}
    return spark.createDataFrame([tuple(row.values())], COLUMNS)


@pytest.mark.parametrize(
    ("changed", "reason"),
    [
        ({}, None),
        ({"investment_asset_id": "XX"}, "unknown investment_asset_id=XX"),
        ({"investment_asset_id": None}, "unknown investment_asset_id=None"),
        ({"quantity": -5.0}, "non-positive quantity=-5.0"),
        ({"quantity": None}, "non-numeric quantity"),
        ({"transaction_type": "WUT"}, "invalid transaction_type=WUT"),
        ({"transaction_type": None}, "invalid transaction_type=None"),
        ({"portfolio_id": "NO_PF", "quantity": 0.0},
         "unknown portfolio_id=NO_PF; non-positive quantity=0.0"),
    ],
)
def test_policy_splits_with_reasons(spark, masters, changed, reason):
    valid, bad = quality.run_with_policy(_row(spark, **changed), *masters)
    if reason is None:
        assert (valid.count(), bad.count()) == (1, 0)
    else:
        assert valid.count() == 0
        assert [r.quarantine_reason for r in bad.collect()] == [reason]


@pytest.mark.parametrize("key", [None, ""])
def test_missing_mandatory_key_stops_the_run(spark, masters, key):
    with pytest.raises(quality.MandatoryKeyError, match="1 row"):
        quality.run_with_policy(_row(spark, transaction_id=key), *masters)


def test_null_quantity_is_neither_lost_nor_valid(spark, masters):
    flagged = quality.with_flags(_row(spark, quantity=None, transaction_type=None), *masters)
    assert flagged.first().dq_reason == "bad_quantity; bad_type"


def test_rates(spark):
    rate = spark.range(1).select(
        quality.rate_pct(F.lit(2), F.lit(98)).alias("a"),
        quality.rate_pct(F.lit(0), F.lit(0)).alias("b"),
    ).first()
    assert (rate.a, rate.b) == (2.0, 0.0)
    log = spark.createDataFrame([("r1",), ("r1",), ("r2",)], "pipeline_run_id string")
    got = quality.quarantine_rate_for_run(log, F.lit(8), F.lit("r1")).first()
    assert (got.quarantined_rows, got.rate_pct) == (2, 20.0)


def test_valid_and_quarantined_partition_the_input(spark, folder):
    from holdfast.sources import market

    txn = market.transactions(spark, folder)
    masters = market.portfolios(spark, folder), market.assets(spark, folder)
    valid, bad = quality.run_with_policy(txn, *masters)
    assert valid.count() + bad.count() == txn.count()
    conformed = quality.conform(txn, *masters)
    assert conformed.count() == txn.select("transaction_id").distinct().count()


def test_metric_names(spark):
    names = ["Quarantine Rate %", "rows_in", "svc:latency_ms", "RowsValid"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(metric_name(F.col("n"))).collect()] == [
        "quarantine_rate__", "rows_in", "svc:latency_ms", "rowsvalid"]


def test_mask(spark):
    row = spark.range(1).select(
        masked(F.lit("CP"), ["engineers"]).alias("a"), masked(F.lit("CP"), ["x"]).alias("b")
    ).first()
    assert (row.a, row.b) == ("CP", "***MASKED***")


def test_schema_registry():
    assert len(SCHEMAS) == 14
    assert sorted(n for n, f in FORMATS.items() if f == "json") == [
        "cashflows", "corporate_actions", "investment_transactions"]
    assert missing_columns(["a"], ["a", "b", "c"]) == ["b", "c"]
    with pytest.raises(ValueError, match="missing required columns"):
        validate_columns(["a"], ["b"])


def test_accepted_values_can_be_replaced(spark):
    assets = spark.createDataFrame(
        [("A", "n", "LISTED_EQUITY", "USD"), ("B", None, "FUND", "usd"), ("B", "n", None, None)],
        "investment_asset_id string, name string, asset_type string, currency string")
    count = lambda accepted: {
        r.rule_id: r.violations
        for r in contracts.feed_violations(
            "investment_asset_master", assets, {}, "2026-05-29", accepted).collect()}
    default = count(None)
    assert default == {"pk_not_null": 0, "no_duplicate_pk": 1, "name_present": 1,
                       "valid_asset_type": 2, "currency_present": 2, "schema_drift": 0}
    assert count({"asset_type": ["LISTED_EQUITY", "FUND"]})["valid_asset_type"] == 1
