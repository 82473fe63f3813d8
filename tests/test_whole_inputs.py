"""Similarity of two tables, balances in one pass, questions that must find nothing, deduplication against all history."""

import json

import numpy as np
from pyspark.sql import functions as F

from holdfast.operators import controls, retrieval
from holdfast.sources import keyed
from holdfast.streaming import routing


def vectors(spark, name, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"{name} bigint, embedding array<double>")


def test_blocks_and_shards_meet_once_with_ties(spark):
    rng = np.random.default_rng(2)
    q, c = rng.integers(-2, 3, (40, 3)) + 0.5, rng.integers(-2, 3, (300, 3)) + 0.5
    got = retrieval.vector_topk(vectors(spark, "question_id", q), vectors(spark, "chunk_id", c), 4, 7, shard_bytes=24 * 50)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    scores = np.round(unit(q) @ unit(c).T, 9)
    want = [(i, n + 1, int(j)) for i in range(40) for n, j in enumerate(np.lexsort((np.arange(300), -scores[i]))[:4])]
    assert sorted((r.question_id, r["rank"], r.chunk_id) for r in got.collect()) == want


def test_plan_is_the_same_for_any_number_of_questions(spark):
    sizes = []
    chunks = vectors(spark, "chunk_id", np.random.default_rng(1).normal(size=(50, 4)))
    for n in (10, 100_000):
        asked = spark.range(n).select(F.col("id").alias("question_id"), F.array(*[F.rand(i) + 0.1 for i in range(4)]).alias("embedding"))
        plan = retrieval.vector_topk(asked, chunks, 2)._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(plan.count("\n"))
        assert "MapInArrow" not in plan
    assert sizes[0] == sizes[1]
    assert retrieval.vector_topk(asked, chunks, 2).groupBy("rank").count().collect()[0]["count"] == 100_000


def test_no_questions_and_no_chunks(spark):
    some = vectors(spark, "chunk_id", np.eye(3))
    none = vectors(spark, "question_id", np.eye(3)).filter("false")
    assert retrieval.vector_topk(none, some).count() == 0
    assert retrieval.vector_topk(vectors(spark, "question_id", np.eye(2)), some).count() == 0


def test_questions_that_must_find_nothing(spark):
    top = spark.createDataFrame([(1, 9, 0.9, 1), (1, 8, 0.2, 2), (2, 9, 0.5, 1), (3, 9, 0.6, 1)], "question_id bigint, chunk_id bigint, score double, rank int")
    golden = spark.createDataFrame([(1, True), (2, True), (3, False), (4, False), (5, True)], "question_id bigint, expected boolean")
    floor = retrieval.score_floor(top, golden)
    assert floor.first().floor == 0.6
    rates = {r.expected: (r.questions, r.found, r.miss_rate, r.false_hit_rate) for r in retrieval.golden_rates(top, golden, floor.scalar()).collect()}
    assert rates == {True: (3, 1, 0.6667, 0.0), False: (2, 0, 0.0, 0.0)}
    assert [(r.question_id, r.chunk_id) for r in retrieval.above_floor(top, floor.scalar()).collect()] == [(1, 9)]
    free = retrieval.score_floor(top, golden.filter("expected"))
    assert retrieval.above_floor(top, free.scalar()).count() == 4


def test_both_balances_read_the_landed_rows_once(spark, tmp_path):
    columns = "transaction_id string, transaction_date string"
    rows = [("a", "2024-01-01"), ("a", "2024-01-02"), ("a", "2024-01-02"), ("b", "2024-01-01"), (None, "2024-01-03"), (None, "2024-01-01"), ("c", None)]
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/bronze")
    bronze = spark.read.parquet(f"{tmp_path}/bronze")
    silver = spark.createDataFrame([("a", "2024-01-02"), ("z", "2024-01-09")], columns)
    bad = spark.createDataFrame([("2024-01-01",)], "business_date string")
    both = controls.recon_balances(bronze, silver, bad, "run")
    assert both._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = sorted((r.variant, str(r.business_date), r.metric_value) for r in both.collect())
    want = [
        (name, str(r.business_date), r.metric_value)
        for name, once in (("landed", False), ("deduplicated", True))
        for r in controls.recon_balance(bronze, silver, bad, "run", deduplicated=once).collect()
    ]
    assert got == sorted(want)


def test_repeats_are_dropped_against_all_history(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "t")
    source.mkdir()

    def drain():
        stream = spark.readStream.schema("k string, v int").option("maxFilesPerTrigger", 1).json(str(source))
        return sorted((tuple(r) for r in routing.dedupe_by_table(stream, "k", root, str(tmp_path / "c"), buckets=4).collect()), key=str)

    put = lambda name, rows: (source / name).write_text("".join(json.dumps({"k": k, "v": v}) + "\n" for k, v in rows))
    put("0.json", [("a", 2), ("a", 1), (None, 5)])
    assert drain() == [("a", 1), (None, 5)]
    put("1.json", [("a", 0), ("b", 7), (None, 6)])
    assert drain() == [("a", 1), ("b", 7), (None, 5)]
    # The batch ran, its commit was lost: the same rows again, neither lost nor doubled
    for name in ("1", ".1.crc"):
        (tmp_path / "c" / "commits" / name).unlink(missing_ok=True)
    assert drain() == [("a", 1), ("b", 7), (None, 5)]
    assert keyed.read(spark, f"{root}/seen").count() == 3
