"""Rows at spots are up to 64 times as many as Spark takes them for."""

from pyspark.sql import functions as F

from holdfast.llm import simhash


def test_exploded_rows_are_never_broadcast(spark):
    nodes = spark.range(300).select(F.xxhash64("id").alias("print"), F.lit(1).cast("bigint").alias("n")).withColumn("label", F.col("print"))
    for rows in (simhash.halves(nodes), simhash.variants(nodes)):
        steps = [simhash._starred(rows, 3), simhash._torn(rows), simhash._outside(rows)]
        steps += [simhash._crossing(rows, 3, leads) for leads in (True, False)]
        for step in steps:
            plan = step._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Broadcast" not in plan
