"""Keyed tables behind streams: refresh on arrival, and history from dated snapshots."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from holdfast.operators import history
from holdfast.sources import keyed
from holdfast.streaming import snapshots


def put(folder, name, rows):
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_refresh_writes_batches_and_deletes_marked_keys(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    root = str(tmp_path / "t")
    read = lambda: spark.readStream.schema("k string, v int, gone boolean").option("maxFilesPerTrigger", 1).json(str(source))
    put(source, "0.json", [{"k": f"k{i}", "v": i} for i in range(400)])
    snapshots.merge_stream(read(), ["k"], root, str(tmp_path / "c"), "gone", buckets=4)
    for turn in range(1, 4):
        put(source, f"{turn}.json", [{"k": f"k{turn}", "v": -turn}, {"k": f"k{10 + turn}", "gone": True}, {"k": f"k{turn}", "v": -100}])
    table = snapshots.merge_stream(read(), ["k"], root, str(tmp_path / "c"), "gone", buckets=4)
    got = {r.k: r.v for r in table.collect()}
    assert len(got) == 397 and [got[f"k{t}"] for t in (1, 2, 3)] == [-1, -2, -3] and not {"k11", "k12", "k13"} & set(got)
    version = keyed.current(spark, root)
    assert sum(p.rows for p in version.parts if p.delta) == 6
    again = snapshots.merge_stream(read(), ["k"], root, str(tmp_path / "c"), "gone", buckets=4)
    assert keyed.current(spark, root).number == version.number and again.count() == 397


def versions(df):
    return sorted((str(r.id), str(r.r), r.effective_from, r.effective_to, r.is_current) for r in df.collect())


def test_late_split_and_repeated_snapshots_give_one_history(spark, tmp_path):
    """Random deliveries against the versions of everything that arrived so far."""
    source = tmp_path / "in"
    source.mkdir()
    rng, landed = random.Random(11), {}
    stream = lambda: spark.readStream.schema("d string, id string, r string").option("maxFilesPerTrigger", 1).json(str(source))
    days = [f"2024-01-{d:02d}" for d in (3, 7, 5, 5, 1, 9, 6)]
    for turn, day in enumerate(days):
        parts = rng.choice((1, 2))
        for part in range(parts):
            rows = [{"d": day, "id": i, "r": rng.choice("xy")} for i in "abcdef" if rng.random() < 0.7]
            if turn == 4:
                rows += [{"d": "2024-01-08", "id": "a", "r": "z"}]
            put(source, f"{turn}-{part}.json", rows)
            # Files are read one a batch in the order they came; the last one counts
            landed.update({(r["d"], r["id"]): r["r"] for r in rows})
            if part + 1 < parts and rng.random() < 0.5:
                snapshots.history_stream(stream(), "d", ["id"], ["r"], str(tmp_path / "t"), str(tmp_path / "c"), buckets=2)
        got = snapshots.history_stream(stream(), "d", ["id"], ["r"], str(tmp_path / "t"), str(tmp_path / "c"), buckets=2)
        whole = spark.createDataFrame([(d, i, r) for (d, i), r in landed.items()], "d string, id string, r string")
        assert versions(got) == versions(history.scd2_from_snapshots(whole, "d", ["id"], ["r"])), (turn, day)
    assert not (tmp_path / "t" / "staged").exists()


def test_new_snapshot_derives_changed_keys_only(spark):
    day = lambda d: F.lit(dt.date(2024, 1, d))
    base = spark.range(1000).selectExpr("id", "id % 3 AS r").withColumn("d", day(1))
    stored = history.scd2_from_snapshots(base, "d", ["id"], ["r"])
    sent = base.withColumn("r", F.when(F.col("id") < 5, 9).otherwise(F.col("r"))).filter("id <> 7").withColumn("d", day(2))
    rows, gone = history.splice_snapshots(stored, base.select("d").distinct(), sent, "d", ["id"], ["r"])
    assert gone.count() == 6 and rows.count() == 5 * 2 + 1
    same, none = history.splice_snapshots(stored, base.select("d").distinct(), base, "d", ["id"], ["r"])
    assert same.count() == 0 and none.count() == 0
