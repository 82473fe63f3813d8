"""SCD2, upsert and slice replacement."""

import datetime as dt

from pyspark.sql import functions as F

from holdfast.operators import history
from holdfast.sources import market, sinks

DAY = "2026-01-01"
HIGH = dt.date(9999, 12, 31)


def _dim(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, rating string")


def _state(df):
    return sorted((r.id, r.rating or "", r.effective_to, r.is_current) for r in df.collect())


def test_insert_change_and_no_change(spark):
    first = history.scd2_initial(_dim(spark, (1, "A")), "2025-01-01")
    assert _state(first) == [(1, "A", HIGH, True)]
    changed = history.scd2_apply(first, _dim(spark, (1, "B")), ["id"], ["rating"], DAY)
    assert _state(changed) == [(1, "A", dt.date(2026, 1, 1), False), (1, "B", HIGH, True)]
    same = history.scd2_apply(first, _dim(spark, (1, "A")), ["id"], ["rating"], DAY)
    assert _state(same) == [(1, "A", HIGH, True)]


def test_null_change_is_seen_and_history_is_carried(spark):
    state = history.scd2_initial(_dim(spark, (1, "A")), "2025-01-01")
    state = history.scd2_apply(state, _dim(spark, (1, None)), ["id"], ["rating"], "2025-06-01")
    state = history.scd2_apply(state, _dim(spark, (1, "C")), ["id"], ["rating"], DAY)
    assert [s[1] for s in _state(state)] == ["", "A", "C"]
    assert state.filter("is_current").count() == 1


def test_absent_key_stays_or_is_closed(spark):
    state = history.scd2_initial(_dim(spark, (1, "A"), (2, "A")), "2025-01-01")
    kept = history.scd2_apply(state, _dim(spark, (2, "A")), ["id"], ["rating"], DAY)
    assert kept.filter("is_current").count() == 2
    closed = history.scd2_apply(state, _dim(spark, (2, "A")), ["id"], ["rating"], DAY, True)
    assert [r.id for r in closed.filter("is_current").collect()] == [2]


def test_snapshot_history_equals_stepwise_application(spark, folder):
    tracked = ["sector", "issuer_id", "asset_type", "name"]
    state, dated = None, None
    for version, date in enumerate(market.SNAPSHOT_DATES, start=1):
        batch = market.asset_snapshot(spark, folder, version)
        rows = batch.withColumn("d", F.lit(date))
        dated = rows if dated is None else dated.unionByName(rows)
        state = (history.scd2_initial(batch, date) if state is None else
                 history.scd2_apply(state, batch, ["investment_asset_id"], tracked, date, True))
    once = history.scd2_from_snapshots(dated, "d", ["investment_asset_id"], tracked)
    assert state.exceptAll(once).count() == 0 and once.exceptAll(state).count() == 0
    assert once.filter("is_current").groupBy("investment_asset_id").count().filter("count > 1").count() == 0


def test_key_that_returns_after_an_absence_gets_a_new_version(spark):
    rows = [("2025-01-01", 1, "A"), ("2025-01-01", 2, "A"), ("2025-02-01", 2, "A"),
            ("2025-03-01", 1, "A"), ("2025-03-01", 2, "A")]
    snaps = spark.createDataFrame(rows, "d string, id int, rating string")
    got = history.scd2_from_snapshots(snaps, "d", ["id"], ["rating"])
    assert _state(got) == [(1, "A", dt.date(2025, 2, 1), False), (1, "A", HIGH, True),
                           (2, "A", HIGH, True)]


def test_upsert_twice_is_upsert_once(spark):
    target, source = _dim(spark, (1, "A"), (2, "A")), _dim(spark, (2, "B"), (3, "B"))
    once = history.upsert(target, source, ["id"])
    twice = history.upsert(once, source, ["id"])
    want = [(1, "A"), (2, "B"), (3, "B")]
    assert sorted(map(tuple, once.collect())) == want == sorted(map(tuple, twice.collect()))


def test_empty_slice_clears_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "d1"), (2, "d2")], "id int, d string")
    sinks.overwrite(rows, path, ["d"])
    sinks.replace_slice(rows.filter("false"), path, "d", "d1", "id")
    assert [tuple(r) for r in spark.read.schema(rows.schema).parquet(path).collect()] == [(2, "d2")]


def test_snapshot_changes(spark):
    old, new = _dim(spark, (1, "A"), (2, "A"), (3, None)), _dim(spark, (2, "B"), (3, None), (4, "A"))
    got = sorted(map(tuple, history.snapshot_changes(old, new, ["id"]).collect()))
    assert got == [(1, "delete"), (2, "update"), (4, "insert")]
