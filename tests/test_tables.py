"""Appends with schema merge, clustered layout, exact products."""

import datetime as dt
import decimal
import itertools

import pytest
from pyspark.sql import functions as F

from holdfast.functions.exact import product
from holdfast.operators import valuation
from holdfast.sources import tables


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_columns_grow_and_widen(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_merge(spark, spark.createDataFrame([(1, 1, 0.5)], "id int, n int, x float"), path)
    tables.append_merge(spark, spark.createDataFrame([(2**40, "new")], "id bigint, note string"), path)
    tables.append_merge(spark, spark.createDataFrame([(3, 0.25)], "id smallint, x double"), path)
    table = tables.read_merged(spark, path)
    assert table.schema.simpleString() == "struct<id:bigint,n:int,x:double,note:string>"
    assert rows_of(table) == [(1, 1, 0.5, None), (2**40, None, None, "new"), (3, None, 0.25, None)]
    assert tables.logged_schema(spark, path)[0] == 3
    tables.append_merge(spark, spark.createDataFrame([(4,)], "id int"), path)
    assert tables.logged_schema(spark, path)[0] == 3


@pytest.mark.parametrize("columns,match", [("id string", "does not fit"), ("id double", "does not fit"), ("ID bigint", "letter case")])
def test_types_that_do_not_fit_are_refused(spark, tmp_path, columns, match):
    path = str(tmp_path / "t")
    tables.append_merge(spark, spark.createDataFrame([(1,)], "id bigint"), path)
    with pytest.raises(tables.SchemaError, match=match):
        tables.append_merge(spark, spark.createDataFrame([], columns), path)
    assert rows_of(tables.read_merged(spark, path)) == [(1,)]


def test_decimals_widen_in_both_directions(spark, tmp_path):
    path = str(tmp_path / "t")
    one = decimal.Decimal("1.5")
    tables.append_merge(spark, spark.createDataFrame([(one,)], "v decimal(10,2)"), path)
    tables.append_merge(spark, spark.createDataFrame([(one,)], "v decimal(12,3)"), path)
    tables.append_merge(spark, spark.createDataFrame([(one,)], "v decimal(5,1)"), path)
    assert [r.v for r in tables.read_merged(spark, path).collect()] == [one] * 3
    with pytest.raises(tables.SchemaError):
        tables.append_merge(spark, spark.createDataFrame([(one,)], "v decimal(12,8)"), path)


def test_appends_by_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    for i, schema in enumerate(("day string, v int", "day string, v bigint, w int")):
        tables.append_merge(spark, spark.createDataFrame([("2024-01-02", *range(i + 1))], schema), path, ["day"])
    assert rows_of(tables.read_merged(spark, path).select("day", "v", "w")) == [("2024-01-02", 0, 1), ("2024-01-02", 0, None)]


def files_read(df):
    return len(df.inputFiles())


def test_a_slice_reads_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(64 * 64).select(
        F.format_string("P%02d", F.pmod("id", F.lit(64))).alias("p"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") / 64).cast("int")).alias("d"), "id",
    )
    tables.create_clustered(spark, df, path, ["p", "d"], 64)
    both = tables.read_clustered(spark, path, df.schema, p="P07", d=dt.date(2024, 2, 3))
    assert rows_of(both) == rows_of(df.filter("p = 'P07' AND d = '2024-02-03'")) and both.count() == 1
    assert files_read(spark.read.parquet(path)) >= 48
    assert files_read(both) <= 2
    for part, condition in ((dict(p="P07"), "p = 'P07'"), (dict(d=tables.Between("2024-02-03", "2024-02-05")), "d BETWEEN '2024-02-03' AND '2024-02-05'")):
        got = tables.read_clustered(spark, path, df.schema, **part)
        assert rows_of(got) == rows_of(df.filter(condition)) and files_read(got) <= 16
        # The scan has the condition as well
        assert "PushedFilters: [IsNotNull" in got._jdf.queryExecution().executedPlan().toString()
    assert tables.read_clustered(spark, path, df.schema, p="none").count() == 0


def test_clustered_with_nulls_and_without_rows(spark, tmp_path):
    df = spark.createDataFrame([(None, 1), ("a", None), ("b", 2)], "p string, d int")
    tables.create_clustered(spark, df, str(tmp_path / "t"), ["p", "d"], 2)
    assert rows_of(tables.read_clustered(spark, str(tmp_path / "t"), df.schema, p=None)) == [(None, 1)]
    assert rows_of(tables.read_clustered(spark, str(tmp_path / "t"), df.schema, d=2)) == [("b", 2)]
    tables.create_clustered(spark, df.filter("false"), str(tmp_path / "e"), ["p", "d"], 2)
    assert tables.read_clustered(spark, str(tmp_path / "e"), df.schema, p="a").count() == 0


def test_products_are_exact_and_never_abort(spark):
    values = ["0.0000000001", "-0.0000000001", "123456789012.0123456789", "-7.5", "20000000000", "1"]
    prices = ["0.00000001", "9999999999.99999999", "-3.25", "50000"]
    rows = [(q, p) for q, p in itertools.product(values, prices) if abs(decimal.Decimal(q) * decimal.Decimal(p)) < 10**19]
    df = spark.createDataFrame(rows, "q string, p string").select(
        "q", "p", product(F.col("q").cast("decimal(38,18)"), F.col("p").cast("decimal(38,18)")).alias("v")
    )
    with decimal.localcontext(decimal.Context(prec=60)):
        assert all(r.v == decimal.Decimal(r.q) * decimal.Decimal(r.p) for r in df.collect())
    bad = spark.createDataFrame([(1e13, 1.0), (float("nan"), 1.0), (1.0, float("inf")), (None, 1.0), (1e11, 9e9)], "q double, p double")
    assert [r.v for r in bad.select(product(F.col("q"), F.col("p")).alias("v")).collect()] == [None] * 5


def test_many_units_do_not_stop_the_day(spark):
    holdings = spark.createDataFrame([("P", "d", "A", 2e10), ("P", "d", "B", 1e15), ("P", "d", "C", 0.1234567891)], "portfolio_id string, as_of_date string, investment_asset_id string, quantity double")
    prices = spark.createDataFrame([(a, "d", 2.0) for a in "ABC"], "investment_asset_id string, price_date string, close_price double")
    assets = spark.createDataFrame([(a, "S", "I") for a in "ABC"], "investment_asset_id string, sector string, issuer_id string")
    fact = valuation.daily_holding(holdings, prices.unionByName(prices), assets)
    assert {r.investment_asset_id: r.market_value for r in fact.collect()} == {
        "A": decimal.Decimal(4 * 10**10), "B": None, "C": decimal.Decimal("0.2469135782"),
    }
    gates = {r.gate: r.failing_rows for r in valuation.gate_counts(holdings, prices, fact, valuation.exposure(fact)).collect()}
    assert gates["null_market_value"] == 1
    odd = holdings.withColumn("quantity", F.when(F.col("investment_asset_id") == "C", 1 / 7).otherwise(F.col("quantity")))
    assert {r.gate: r.failing_rows for r in valuation.factor_gate(odd, prices).collect()} == {
        "quantity_cut": 1, "quantity_unfit": 1, "close_price_cut": 0, "close_price_unfit": 0,
    }


def test_prices_are_not_sorted(spark, folder):
    import __spark_entry__ as entry

    plan = entry.queries()["daily_holding"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    prices = plan[plan.index("close_price") :]
    assert "WindowGroupLimit [investment_asset_id" not in prices or plan.count("Window ") <= 1
