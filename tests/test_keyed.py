"""Tables merged by key: small writes, whole versions, deletes, new columns."""

import pathlib
import random

import pytest

from holdfast.sources import keyed


def data_files(root):
    return {p for p in pathlib.Path(root, "data").rglob("*.parquet")}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_few_changed_keys_rewrite_their_buckets_only(spark, tmp_path):
    root = str(tmp_path / "t")
    keyed.merge(spark, root, spark.range(20_000).selectExpr("id", "id AS v"), ["id"], buckets=40)
    before = data_files(root)
    old = keyed.read(spark, root)
    batch = spark.range(4).selectExpr("id * 5000 AS id", "-1L AS v")
    version = keyed.merge(spark, root, batch, ["id"])
    assert len(version.parts) == 40 and not any(p.delta for p in version.parts)
    new = data_files(root) - before
    # Four keys: four small deltas and at most four rewritten buckets
    assert len({p.parent for p in new}) <= 8 and before <= data_files(root)
    assert old.filter("v = -1").count() == 0 and old.count() == 20_000
    table = keyed.read(spark, root)
    assert table.count() == 20_000 and table.filter("v = -1").count() == 4
    assert "Window" not in table._jdf.queryExecution().executedPlan().toString()


def test_a_batch_writes_its_own_size(spark, tmp_path):
    root = str(tmp_path / "t")
    keyed.merge(spark, root, spark.range(10_000).selectExpr("id", "id AS v"), ["id"], buckets=8)
    version = keyed.apply(spark, root, spark.range(10).selectExpr("id", "0L AS v"), ["id"])
    assert sum(p.rows for p in version.parts if p.delta) == 10
    assert sum(p.rows for p in version.parts if not p.delta) == 10_000
    assert keyed.read(spark, root).agg({"v": "sum"}).first()[0] == sum(range(10, 10_000))


def test_many_batches_equal_a_dictionary(spark, tmp_path):
    root, rng, want = str(tmp_path / "t"), random.Random(3), {}
    rewritten = 0
    for turn in range(8):
        rows = {rng.choice([None, *range(30)]): rng.randrange(1000) for _ in range(6)}
        gone = {rng.randrange(30) for _ in range(4)}
        for k in gone - set(rows):
            want.pop(k, None)
        want.update(rows)
        version = keyed.apply(
            spark, root, spark.createDataFrame(list(rows.items()), "k int, v int"), ["k"],
            spark.createDataFrame([(k,) for k in gone], "k int"), buckets=4,
        )
        rewritten += any(p.generation % 2 for p in version.parts)
        assert dict(tuple(r) for r in keyed.read(spark, root).collect()) == want
    assert rewritten
    before = keyed.read(spark, root)
    assert keyed.expire(spark, root, keep=1) > 0
    assert rows_of(keyed.read(spark, root)) == rows_of(before)


def test_repeated_batch_and_lost_commit(spark, tmp_path):
    root = str(tmp_path / "t")
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for _ in range(2):
        keyed.apply(spark, root, batch, ["k"], buckets=2)
    assert rows_of(keyed.read(spark, root)) == [(1, "a"), (2, "b")]
    # Data of the next version without its manifest is not seen, and is replaced by the next attempt
    version = keyed._with_delta(spark, root, batch.filter("k = 1").selectExpr("k", "'lost' AS v"), None, ["k"], 2)
    assert rows_of(keyed.read(spark, root)) == [(1, "a"), (2, "b")]
    assert keyed.apply(spark, root, batch.limit(0), ["k"]).number == version.number
    assert rows_of(keyed.read(spark, root)) == [(1, "a"), (2, "b")]


def test_new_columns_and_refused_types(spark, tmp_path):
    root = str(tmp_path / "t")
    keyed.merge(spark, root, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), ["k"], buckets=2)
    keyed.merge(spark, root, spark.createDataFrame([(2, 0.5)], "k int, w double"), ["k"])
    assert rows_of(keyed.read(spark, root).select("k", "v", "w")) == [(1, "a", None), (2, None, 0.5)]
    with pytest.raises(ValueError, match="column v"):
        keyed.merge(spark, root, spark.createDataFrame([(3, 7)], "k int, v int"), ["k"])
    with pytest.raises(ValueError, match="keys"):
        keyed.merge(spark, root, spark.createDataFrame([(3, "x")], "k int, v string"), ["v"])


def test_table_without_rows_and_none(spark, tmp_path):
    root = str(tmp_path / "t")
    assert keyed.current(spark, root) is None
    with pytest.raises(ValueError, match="no keyed table"):
        keyed.read(spark, root)
    keyed.merge(spark, root, spark.createDataFrame([], "k int, v string"), ["k"])
    assert keyed.read(spark, root).count() == 0 and keyed.read(spark, root).columns == ["k", "v"]
