"""What a keyed table shuffles, by the plans that it writes with."""

from pyspark.sql import functions as F

from holdfast.operators.keys import dedupe_latest
from holdfast.sources import keyed


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())

def _writes(monkeypatch):
    """The plans of all rows that are written, in order."""
    plans, write = [], keyed._write

    def noted(spark, version, rows, *rest):
        hints, hint = [], type(rows).hint
        monkeypatch.setattr(type(rows), "hint", lambda self, *a: hints.append(a[0]) or hint(self, *a))
        parts = write(spark, version, rows, *rest)
        monkeypatch.setattr(type(rows), "hint", hint)
        plans.append(hints)
        return parts

    monkeypatch.setattr(keyed, "_write", noted)
    return plans


def test_rows_spread_by_key_are_not_shuffled_again(spark, tmp_path, monkeypatch):
    plans, root = _writes(monkeypatch), str(tmp_path / "t")
    landed = spark.range(3000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    first = dedupe_latest(landed, ["k"], "v")
    keyed.apply(spark, root, first, ["k"], buckets=4, spread=True)
    keyed.merge(spark, root, first.filter("k < 300").withColumn("v", F.lit(-1).cast("bigint")), ["k"])
    # The first load, a batch as it comes, and the buckets rewritten after their merge by key
    assert plans == [[], ["rebalance"], []]
    assert rows_of(keyed.read(spark, root)) == sorted((k, -1 if k < 300 else 2000 + k) for k in range(1000))


def test_deletes_beside_spread_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("v"))
    keyed.apply(spark, root, dedupe_latest(rows, ["k"], "v"), ["k"], buckets=4, spread=True)
    keyed.apply(spark, root, rows.filter("k < 2"), ["k"], rows.filter("k > 9").select("k"), spread=True)
    assert rows_of(keyed.read(spark, root)) == [(k, k) for k in range(10)]
