"""Steps whose work must grow no faster than their input."""

import pathlib

from pyspark.sql import functions as F

from holdfast.plans import controls as control_plans
from holdfast.plans import ingest as ingest_plans
from holdfast.plans import quality as quality_plans
from holdfast.plans import serving as serving_plans
from holdfast.plans import valuation as valuation_plans
from holdfast.sources import feeds, market
from holdfast.sources.schemas import SCHEMAS


def _joins(df):
    """The join conditions of the optimized plan, one text each."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if "Join " in line]


def test_second_formulation_of_breaches_pairs_no_share_with_other_portfolios_limits(spark, folder):
    compared = control_plans.reconcile_breaches(spark, folder)
    assert _joins(compared) and not [j for j in _joins(compared) if " OR " in j]
    counts = compared.first()
    assert counts.in_both > 0 and counts.only_left == counts.only_right == 0


def test_a_delivery_of_documents_is_not_written_by_one_task(spark, folder, monkeypatch, tmp_path):
    dealt = ingest_plans.approved(spark, folder).repartition(4)
    monkeypatch.setattr(ingest_plans, "approved", lambda *_: dealt)
    monkeypatch.setattr(ingest_plans, "work_dir", lambda *_: str(tmp_path))
    chunks = ingest_plans.chunk_refresh_stream(spark, folder)
    assert len(list(pathlib.Path(tmp_path, "documents").glob("*.parquet"))) > 3
    # One micro-batch for each delivery
    assert len(list(pathlib.Path(tmp_path, "checkpoint", "commits").glob("[0-9]*"))) == 3
    assert chunks.select("doc_name").distinct().count() == dealt.filter("trim(text) != ''").count()


def test_quantiles_value_the_fact_once(spark, folder, monkeypatch):
    passes = spark.sparkContext.accumulator(0)
    fact = valuation_plans.fact(spark, folder)
    rows = fact.count()

    def counting(batches):
        for batch in batches:
            passes.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(valuation_plans, "fact", lambda *_: fact.mapInArrow(counting, fact.schema))
    quantiles = serving_plans.profile_quantiles(spark, folder)
    assert quantiles.count() == 2
    assert passes.value == rows


def test_holdings_and_prices_meet_by_numbers_not_by_texts_made_for_the_join(spark, folder):
    fact = valuation_plans.fact(spark, folder)
    plan = fact._jdf.queryExecution().optimizedPlan()
    price_join = [line for line in _joins(fact) if "as_of_date" in line or "day" in line]
    assert price_join
    # Ids are put together above the joins only; before, every row's were in the scans, shuffles and sorts
    joined = plan.toString().split("Join ", 1)[1]
    assert "concat(AS_" not in joined and "concat(PF_" not in joined
    assert dict(fact.dtypes)["as_of_date"] == dict(fact.dtypes)["portfolio_id"] == "string"


def test_amounts_added_as_whole_cents_are_the_sum_of_decimals(spark):
    amounts = [1.005, -1.005, 0.015, -0.005, 2.675, 123456789.125, 9e14 + 0.5, 1e15, -7.0, 0.1, None, -12345678901234.56]
    for upto in range(1, len(amounts) + 1):
        df = spark.createDataFrame([(a,) for a in amounts[:upto]], "x double")
        want = df.agg(F.sum(F.col("x").cast("decimal(18,2)")).cast("double")).first()[0]
        assert df.agg(market._exact_sum("x")).first()[0] == want


def test_quarantine_judges_its_rows_once_for_both_writes(spark, folder, monkeypatch):
    passes = spark.sparkContext.accumulator(0)
    log = quality_plans.quarantine_log(spark, folder)
    rows = log.count()

    def counting(batches):
        for batch in batches:
            passes.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(quality_plans, "quarantine_log", lambda *_: log.mapInArrow(counting, log.schema))
    assert quality_plans.quarantine(spark, folder).count() == rows
    assert passes.value == rows


def test_json_lines_that_keep_the_contract_are_not_filtered_field_by_field(spark):
    schema = SCHEMAS["investment_transactions"]
    lines = [
        '{"quantity":"n/a"}', '{"quantity":1,"fee":2}', "[1]", "no", "{}", '{"quantity":1,"quantity":"x"}',
        '{"quantity":null}', '{"fee":null}', None, "", '{"quantity":1,"QUANTITY":2}',
    ]
    read = feeds.rescue_json(spark.createDataFrame([(line,) for line in lines], "value string"), schema)
    assert [r._rescued_data for r in read.collect()] == [
        '{"quantity":"n/a"}', '{"fee":"2"}', "[1]", "no", None, None, None, '{"fee":null}', None, "", '{"QUANTITY":"2"}',
    ]
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert "map_contains_key" in plan or "array_contains(map_keys" in plan
