"""Streams, rescue, retrieval, price validity and the oracle at the smallest scale."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from holdfast.operators import controls, generator, governance, operations, profiling, retrieval
from holdfast.operators import valuation
from holdfast.operators.quality import MandatoryKeyError
from holdfast.sources import feeds
from holdfast.sources.schemas import SCHEMAS
from holdfast.streaming import ingest, routing


def test_rescue_keeps_every_row(spark):
    lines = ['{"transaction_id":"a","quantity":1.5,"fee":{"x":1}}', '{"transaction_id":"b","quantity":"n/a"}',
             '{"transaction_id":"c"}', "not json"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [(r.transaction_id, r.quantity, r._rescued_data)
           for r in feeds.rescue_json(df, SCHEMAS["investment_transactions"]).collect()]
    assert got == [("a", 1.5, '{"fee":"{\\"x\\":1}"}'), ("b", None, '{"quantity":"n/a"}'),
                   ("c", None, None), (None, None, "not json")]


def test_ingest_sees_each_file_once(spark, tmp_path):
    feed = "cashflows"
    rows = spark.createDataFrame([("c1", "p", "2026-05-29", "FEE", 1.0, "USD")], SCHEMAS[feed])
    for expected in (1, 1, 2):
        if expected == 2 or not (tmp_path / "raw").exists():
            rows.write.mode("append").json(f"{tmp_path}/raw/{feed}")
        ingest.ingest_all(spark, f"{tmp_path}/raw", f"{tmp_path}/t", f"{tmp_path}/c", "ts", [feed])
        landed = spark.read.parquet(f"{tmp_path}/t/raw_{feed}")
        assert landed.count() == expected
    assert landed.select("_batch_id").distinct().first()[0] == "cashflows__ts"


def test_stream_without_mandatory_key_stops(spark, tmp_path):
    schema = "transaction_id string, counterparty_id string, _dq_reason string"
    spark.createDataFrame([(None, "c", None)], schema).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    with pytest.raises(Exception, match=MandatoryKeyError.__name__):
        routing.route(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
    assert not (tmp_path / "out").exists()


@pytest.mark.parametrize("block", [2, 4096])
def test_topk_equals_brute_force(spark, folder, block):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    chunks = table.select(F.col("vec_id").alias("chunk_id"), "embedding").repartition(5)
    questions = table.filter("vec_id < 7").select(F.col("vec_id").alias("question_id"), "embedding")
    got = sorted((r.question_id, r["rank"], r.chunk_id)
                 for r in retrieval.vector_topk(questions, chunks, 4, block).collect())
    rows = table.select("vec_id", "embedding").orderBy("vec_id").collect()
    unit = np.array([r.embedding for r in rows], dtype=np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    scores = np.round(unit[:7] @ unit.T, 9)
    want = [(q, i + 1, int(c)) for q in range(7)
            for i, c in enumerate(np.lexsort((np.arange(len(rows)), -scores[q]))[:4])]
    assert got == want


def test_chunks_are_numbered_after_empty_lines_are_dropped(spark):
    docs = spark.createDataFrame([("d", " a \n\n\t\nb \n")], "doc_name string, text string")
    got = sorted(map(tuple, retrieval.chunk_documents(docs).collect()))
    assert got == [("d#0", "d", "a"), ("d#1", "d", "b")]


def test_price_valid_at_usage_time(spark):
    usage = spark.sql("""SELECT 'w' workspace_id, DATE'2024-03-10' usage_date, 'S' sku_name, 'DBU' usage_unit,
        TIMESTAMP_NTZ'2024-03-10 12:00:00' usage_end_time, 2.0D usage_quantity,
        named_struct('job_id', 1L, 'warehouse_id', 'x') usage_metadata""")
    prices = spark.sql("""SELECT 'S' sku_name, 'DBU' usage_unit, p.a price_start_time, p.z price_end_time,
        named_struct('effective_list', named_struct('default', p.v)) pricing FROM VALUES
        (TIMESTAMP_NTZ'2023-01-01', TIMESTAMP_NTZ'2024-03-10 12:00:00', 1.0BD),
        (TIMESTAMP_NTZ'2024-03-10 12:00:00', NULL, 3.0BD) AS p(a, z, v)""")
    got = operations.price_usage(usage, prices, "2024-01-01", "2024-03-31").select("cost").collect()
    assert [float(r.cost) for r in got] == [6.0]
    # Usage of the last day that ends after the report window is priced as well
    late = usage.withColumn("usage_end_time", F.expr("TIMESTAMP_NTZ'2024-04-01 00:00:00'"))
    got = operations.price_usage(late, prices, "2024-03-01", "2024-03-10").select("cost").collect()
    assert [float(r.cost) for r in got] == [6.0]


def test_row_filter_by_group_and_user(spark):
    rows = spark.createDataFrame([("P1",), ("P2",)], "portfolio_id string")
    access = spark.createDataFrame([("u", "P2"), ("u", "P2")], "pm_user string, portfolio_id string")
    see = lambda user, groups: [r[0] for r in governance.apply_row_filter(rows, user, groups, access).collect()]
    assert see("u", []) == ["P2"] and see("v", []) == [] and see("v", ["analysts"]) == ["P1", "P2"]


def test_spike_without_history(spark):
    log = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01' check_timestamp, 'c' check_name, 'j' job_run_id, 1.0D metric_value")
    assert controls.breach_spike(log).first().spike == 1


def test_quantiles_are_within_rank_error(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    row = profiling.profile_quantiles(df, ["v"], (0.25, 0.5, 0.75)).first()
    assert (row.p25, row.p50, row.p75) == (250.0, 500.0, 750.0)


def test_generated_feeds_have_the_preset_sizes(spark):
    made = generator.generate_feeds(spark, "dev")
    assert sum(df.count() for df in made.values()) == 97920
    for name, df in made.items():
        assert df.columns == SCHEMAS[name].names
    fact = valuation.daily_holding(
        made["investment_holdings_snapshot"], made["listed_market_prices"],
        spark.range(300).select(F.format_string("AST-%07d", "id").alias("investment_asset_id"),
                                F.pmod("id", F.lit(7)).cast("string").alias("sector"),
                                F.lit("i").alias("issuer_id")))
    totals = valuation.exposure(fact).groupBy("portfolio_id", "as_of_date").agg(F.sum("exposure_pct").alias("t"))
    assert totals.count() == 900 and totals.filter("abs(t - 100) > 0.1").count() == 0


def test_one_hot_transaction_leaves_each_task_once(spark, folder):
    """The latest-row window keeps one row per key in the map task, before the shuffle."""
    df = entry.queries()["dedupe_latest"](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_breach_join_has_no_nested_loop(spark, folder):
    plan = entry.queries()["limit_breach"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_entry_and_registers(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns[0] == "portfolio_id"
