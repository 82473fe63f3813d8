"""Inputs on which earlier versions lost, doubled or misjudged rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from holdfast.functions.exact import cut_factors
from holdfast.operators import contracts, controls, history, operations, profiling, retrieval, valuation
from holdfast.sources import sinks
from holdfast.streaming import snapshots


def test_usage_that_ends_long_after_the_window_is_priced(spark):
    usage = spark.sql(
        """SELECT 'w' AS workspace_id, DATE '2024-01-31' AS usage_date, e AS usage_end_time, 'h' AS usage_unit,
                  's' AS sku_name, 2.5D AS usage_quantity, named_struct('job_id', 'j') AS usage_metadata
           FROM VALUES (TIMESTAMP '2024-03-15 00:00:00'), (TIMESTAMP '2023-11-02 00:00:00') AS t(e)"""
    )
    prices = spark.sql(
        """SELECT 's' AS sku_name, 'h' AS usage_unit, TIMESTAMP '2023-01-01 00:00:00' AS price_start_time,
                  CAST(NULL AS TIMESTAMP) AS price_end_time,
                  named_struct('effective_list', named_struct('default', 2.0D)) AS pricing"""
    )
    costs = operations.price_usage(usage, prices, "2024-01-01", "2024-01-31").collect()
    assert sorted(float(r.cost) for r in costs) == [5.0, 5.0]


@pytest.fixture
def small(spark):
    holdings = spark.createDataFrame(
        [("P", "2024-01-02", "A", 0.00004), ("P", "2024-01-02", "B", 10.0)],
        "portfolio_id string, as_of_date string, investment_asset_id string, quantity double",
    )
    prices = spark.createDataFrame(
        [("A", "2024-01-02", 50000.0), ("B", "2024-01-02", 0.12345678)],
        "investment_asset_id string, price_date string, close_price double",
    )
    assets = spark.createDataFrame(
        [("A", "S", "I", "USD"), ("B", "S", "I", "USD")],
        "investment_asset_id string, sector string, issuer_id string, currency string",
    )
    return holdings, prices, assets


def test_factors_keep_eight_decimals(small):
    holdings, prices, assets = small
    values = {r.investment_asset_id: float(r.market_value) for r in valuation.daily_holding(holdings, prices, assets).collect()}
    assert values == {"A": 2.0, "B": 1.2345678}
    finer = prices.withColumn("close_price", F.lit("0.1234567891").cast("decimal(20,10)"))
    assert cut_factors(finer, "close_price").first()[0] == 2


def test_masters_landed_twice_change_nothing(spark, small):
    holdings, prices, assets = small
    fact = valuation.daily_holding(holdings, prices.unionByName(prices), assets.unionByName(assets))
    assert fact.count() == 2
    rates = spark.createDataFrame([("USD", "2024-01-02", 3.6725)], "currency string, rate_date string, rate_to_base double")
    once = valuation.portfolio_value_in_base(fact, assets, rates).collect()
    assert valuation.portfolio_value_in_base(fact, assets, rates.unionByName(rates)).collect() == once
    scoped = spark.createDataFrame([("P", "SECTOR", "S", 90.0, "2024-01-02")], "portfolio_id string, scope_type string, scope_value string, exposure_pct double, as_of_date string")
    limits = spark.createDataFrame([("L", "SECTOR", "S", "ALL", 40.0)], "limit_id string, scope_type string, scope_value string, portfolio_id string, max_pct double")
    assert valuation.limit_breach(scoped, limits.unionByName(limits)).count() == 1
    assert valuation.daily_pnl(holdings, prices.unionByName(prices)).count() == 0


def test_day_without_any_price_is_reported(spark):
    assets = spark.createDataFrame([("A", "LISTED_EQUITY"), ("B", "FUND")], "investment_asset_id string, asset_type string")
    prices = spark.createDataFrame([("A", "2024-01-01")], "investment_asset_id string, price_date string")
    due = spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "price_date string")
    rows = controls.check_assets_missing_price(assets, prices, "run", due).collect()
    assert {str(r.business_date): r.metric_value for r in rows} == {"2024-01-01": 0.0, "2024-01-02": 1.0}


def test_rule_on_an_absent_column_is_not_evaluated(spark):
    feed = spark.createDataFrame([("C1", "x")], "counterparty_id string, risk_category string")
    rows = {r.rule_id: r.violations for r in contracts.feed_violations("counterparty_master", feed, {}, "2024-01-01").collect()}
    assert rows["valid_type"] is None and rows["name_present"] is None and rows["pk_not_null"] == 0
    keyless = feed.drop("counterparty_id")
    assert None in [r.violations for r in contracts.feed_violations("counterparty_master", keyless, {}, "2024-01-01").collect()]


def test_rerun_without_bad_rows_clears_its_slice(spark, tmp_path):
    path = str(tmp_path / "quarantine")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "run string, x int")
    sinks.replace_runs(rows, path, "run", ["a", "b"])
    sinks.replace_runs(rows.filter("false"), path, "run", ["a"])
    assert [(r.run, r.x) for r in spark.read.parquet(path).collect()] == [("b", 2)]


def test_compaction_follows_bytes(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "target")
    spark.range(20000).selectExpr("id", "sha2(string(id), 256) AS s").repartition(7).write.parquet(raw)
    stored = sinks.stored_bytes(spark, raw)
    sinks.compact(spark, raw, target, "id", stored // 3)
    files = spark.read.parquet(target).select("_metadata.file_path").distinct().count()
    assert 2 <= files <= 4 and spark.read.parquet(target).count() == 20000


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().size()


def test_scd2_plan_grows_by_one_scan_a_batch(spark, tmp_path):
    base = spark.createDataFrame([(1, "A"), (2, "B")], "id int, rating string")
    path = str(tmp_path / "batch")
    base.write.parquet(path)
    state = history.scd2_initial(spark.read.parquet(path), "2024-01-01")
    for day in range(2, 10):
        batch = spark.read.parquet(path).withColumn("rating", F.concat("rating", F.lit(str(day))))
        state = history.scd2_apply(state, batch.unionByName(batch), ["id"], ["rating"], f"2024-01-{day:02d}")
    assert scans(state) <= 1 + 2 * 8
    assert state.count() == 2 * 9 and state.filter("is_current").count() == 2


def snapshot(folder, name, date, *ids):
    (folder / name).write_text("".join(json.dumps({"d": date, "id": i, "r": r}) + "\n" for i, r in ids))


def test_split_late_and_repeated_snapshots(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    root, checkpoint = str(tmp_path / "state"), str(tmp_path / "checkpoint")

    def drain():
        stream = spark.readStream.schema("d string, id string, r string").option("maxFilesPerTrigger", 1).json(str(source))
        path = snapshots.scd2_stream(stream, "d", ["id"], ["r"], root, checkpoint)
        rows = spark.read.parquet(path).collect()
        return sorted((r.id, r.r, r.effective_from, r.is_current) for r in rows)

    first, third = dt.date(2024, 1, 1), dt.date(2024, 1, 3)
    snapshot(source, "1a.json", "2024-01-01", ("a", "x"))
    snapshot(source, "1b.json", "2024-01-01", ("b", "x"))
    assert drain() == [("a", "x", first, True), ("b", "x", first, True)]
    snapshot(source, "3.json", "2024-01-03", ("a", "z"), ("b", "x"))
    assert drain() == [("a", "x", first, False), ("a", "z", third, True), ("b", "x", first, True)]
    snapshot(source, "2.json", "2024-01-02", ("a", "x"))
    assert [s for s in drain() if s[0] == "b"] == [("b", "x", first, False), ("b", "x", third, True)]
    assert len(drain()) == 4


def test_restart_without_files_names_the_newest_version(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text('{"k": "a", "v": "1"}\n')
    read = lambda: spark.readStream.schema("k string, v string").json(str(source))
    root, checkpoint = str(tmp_path / "state"), str(tmp_path / "checkpoint")
    first = snapshots.upsert_stream(read(), ["k"], root, checkpoint)
    assert snapshots.upsert_stream(read(), ["k"], root, checkpoint) == first
    assert spark.read.parquet(first).count() == 1


def test_vectors_of_several_widths_and_none(spark):
    schema = "chunk_id bigint, embedding array<double>"
    chunks = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, 1.0])], schema)
    questions = spark.createDataFrame([(7, [1.0, 0.1]), (8, [0.0, 2.0, 0.0])], "question_id bigint, embedding array<double>")
    top = retrieval.vector_topk(questions, chunks, 2).collect()
    assert sorted((r.question_id, r["rank"], r.chunk_id) for r in top) == [(7, 1, 1), (7, 2, 5), (8, 1, 2)]
    rejected = {r.reason: r.chunks for r in retrieval.rejected_vectors(chunks).collect()}
    assert rejected == {"null_vector": 1, "no_direction": 1}


def test_prompts_cite_approved_documents_only(spark, folder):
    import __spark_entry__ as entry

    allowed = {
        f"{r.doc_id}" for r in spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1 AND toxic = 0").select("doc_id").collect()
    }
    found = entry.queries()["vector_topk"](spark, folder).collect()
    assert found and {str(r.chunk_id) for r in found} <= allowed
    assert all("POLICY PASSAGES:\n[" in r.prompt for r in entry.queries()["prompt_context"](spark, folder).collect())


def test_exact_quantiles_with_ties_and_nulls(spark):
    rows = [(1.0,), (1.0,), (1.0,), (2.0,), (9.0,), (None,)]
    df = spark.createDataFrame(rows, "v double").withColumn("w", F.lit(None).cast("double"))
    got = {r.column_name: (r.p25, r.p50, r.p75) for r in profiling.exact_quantiles(df, ["v", "w"], (0.25, 0.5, 0.75)).collect()}
    assert got == {"v": (1.0, 1.0, 2.0)}


def test_exact_quantiles_sort_only_values_near_them(spark):
    df = spark.range(200_000).selectExpr("(id * 7919) % 200000 AS v", "cast(id % 3 AS double) AS w")
    assert profiling._around(df, ["v", "w"], (0.25, 0.5, 0.75)).count() < 2000
    got = {r.column_name: (r.p25, r.p50, r.p75) for r in profiling.exact_quantiles(df, ["v", "w"], (0.25, 0.5, 0.75)).collect()}
    assert got == {"v": (49_999.0, 99_999.0, 149_999.0), "w": (0.0, 1.0, 2.0)}
