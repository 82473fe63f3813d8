"""Steps that did the same work many times for a row do it once."""

from pyspark.sql import functions as F

from holdfast.functions import exact
from holdfast.operators import profiling
from holdfast.plans import valuation as valuation_plans
from holdfast.sources import market, tables

FOLDER = "/root/testdata/sf0.001"


def test_a_row_finds_its_range_by_halving_and_not_by_all_edges(spark, monkeypatch, tmp_path):
    rows, columns = market.holdings(spark, FOLDER), ["portfolio_id", "as_of_date"]
    rows = rows.unionByName(rows.limit(2).withColumn("portfolio_id", F.lit(None).cast("string")))
    plans, parquet = [], type(rows.write).parquet
    monkeypatch.setattr(type(rows.write), "parquet", lambda self, path, *a, **k: plans.append(
        self._df._jdf.queryExecution().optimizedPlan().toString()) or parquet(self, path, *a, **k))
    tables.create_clustered(spark, rows, str(tmp_path / "t"), columns, 4)
    # Before, a lambda went over 63 edges for each of the six bits of each column
    assert "_cluster" in plans[0] and "lambda" not in plans[0]
    key = F.lit(0).cast("bigint")
    for place, column in enumerate(columns):
        edges = tables._range_edges(rows, column, tables.CLUSTER_BITS)
        number = sum([F.coalesce((F.col(column) >= e).cast("int"), F.lit(0)) for e in edges], F.lit(0))
        for bit in range(tables.CLUSTER_BITS):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("bigint")
            key = key.bitwiseOR(F.shiftleft(one, bit * 2 + 1 - place))
    found = tables.with_cluster_key(rows, columns)
    assert found.columns == [*rows.columns, "_cluster"]
    assert found.filter(F.col("_cluster") != key).count() == 0 and found.select("_cluster").distinct().count() > 100


def test_slices_are_added_up_before_they_are_opened_by_column(spark):
    rows = [("a", 0.1, 2.0), ("a", 1.00005, None), ("a", 123456789.12345, -3.5), ("b", None, 7.0), ("b", None, 0.00004)]
    df = spark.createDataFrame(rows, "d string, x double, y double")
    profiled = profiling.profile_slices(df, "d", ["x", "y"])
    plan = profiled._jdf.queryExecution().optimizedPlan().toString()
    # Before, each row was opened first and all its numbers were made decimals
    assert plan.index("Generate") < plan.index("Aggregate")
    for r in profiled.collect():
        money = F.col(r.column_name).cast("decimal(18,4)")
        mean = F.round((F.sum(money).cast("double") / F.count(money)).cast("decimal(28,10)"), 4).cast("double")
        want = df.filter(F.col("d") == r.d).agg(F.count("*"), F.count("*") - F.count(money), F.when(F.count(money) > 0, mean)).first()
        assert (r.row_count, r.null_count, r["mean"]) == tuple(want)


def test_values_off_a_tie_round_without_decimals_to_the_same(spark):
    values = [0.5, 2.5, 0.00005, -0.00005, -0.00001, -0.0, 1.00005, 2.675, 0.12344999999999, 0.12345000000001, 0.123449999999999996, 1e7 + 0.00005,
              123456789.12345, 1e12, float("-1e15"), 41.99995, 33.333333333, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 2, 4, 6, 8):
        plain = F.round(F.col("v").cast("decimal(28,10)"), digits).cast("double")
        got = df.select(exact.rounded(F.col("v"), digits).cast("string"), plain.cast("string")).collect()
        assert [r[0] for r in got] == [r[1] for r in got]
    # Before, every value was cast
    assert "rint" in df.select(exact.rounded(F.col("v"), 4))._jdf.queryExecution().optimizedPlan().toString().lower()


def test_days_are_valued_from_the_newest_until_one_has_a_breach(spark, monkeypatch):
    whole, asked = valuation_plans.breaches(spark, FOLDER).localCheckpoint(), []
    held = market.holding_rows(spark, FOLDER).select("as_of_date").distinct().collect()
    days = sorted((str(r[0]) for r in held), reverse=True)
    by_day = valuation_plans.breaches

    def until(last):
        def some(spark, folder, days=None):
            asked.append(days)
            return by_day(spark, folder, days).filter(F.col("as_of_date") <= last)
        return some

    for last in (days[0], days[5], "1900-01-01"):
        asked.clear()
        monkeypatch.setattr(valuation_plans, "breaches", until(last))
        want = whole.filter(F.col("as_of_date") <= last)
        want = want.filter(F.col("as_of_date") == (want.agg(F.max("as_of_date")).first()[0] or ""))
        got = valuation_plans.newest_breaches(spark, FOLDER)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        seen = [d for span in asked if span for d in days if str(span[0]) <= d <= str(span[1])]
        assert seen == days[: len(seen)] and (len(seen) == len(days)) == (last < days[-1])
        assert len(seen) <= 2 * (days.index(last) + 1 if last in days else len(days)) + 14


def test_prompts_value_the_newest_days_only(spark, monkeypatch):
    import __spark_entry__ as entry

    asked, fact = [], valuation_plans.fact
    monkeypatch.setattr(valuation_plans, "fact", lambda *a: asked.append(a[2] if len(a) > 2 else None) or fact(*a))
    prompts = entry.queries()["prompt_context"](spark, FOLDER).collect()
    assert prompts and asked and None not in asked
