"""Tables kept current by arriving files: SCD2 from snapshots and keyed upserts.

State lives in version folders ``v0, v1, ...`` named by micro-batch, so a batch that is
repeated reads the same old version and writes the same new one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.history import scd2_from_snapshots, splice_snapshots, upsert
from holdfast.operators.keys import latest_per_key
from holdfast.sources import keyed
from holdfast.sources.sinks import remove_folder, table_exists


def newest_version(spark: SparkSession, root: str) -> str | None:
    """The last version folder below ``root``; None when there is none."""
    number = 0
    while table_exists(spark, f"{root}/v{number + 1}"):
        number += 1
    return f"{root}/v{number}" if number else None


def _run(stream: DataFrame, step, root: str, checkpoint: str) -> str | None:
    """Drain the stream through ``step(old or None, batch)``; returns the newest version.

    Without new files that is the version of an earlier run.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        old_path, new_path = f"{root}/v{batch_id}", f"{root}/v{batch_id + 1}"
        old = spark.read.parquet(old_path) if table_exists(spark, old_path) else None
        step(old, batch).write.mode("overwrite").parquet(new_path)

    (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return newest_version(stream.sparkSession, root)


def scd2_stream(
    stream: DataFrame,
    date_column: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    root: str,
    checkpoint: str,
) -> str | None:
    """Versions from arriving full snapshots; a key that a snapshot omits is closed.

    Arriving files are staged per micro-batch, by snapshot date. When the stream is drained,
    all staged dates are versioned in one shuffle, so it does not matter whether a snapshot came
    in several files or triggers, late, or twice (the last batch counts for a key and date).
    """

    def stage(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/staged/_batch={batch_id}")

    (
        stream.writeStream.foreachBatch(stage)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    spark = stream.sparkSession
    if not table_exists(spark, f"{root}/staged"):
        return None
    staged = spark.read.parquet(f"{root}/staged")
    rows = latest_per_key(
        staged, [*keys, date_column], [F.col("_batch").desc(), *[F.col(c).desc() for c in stream.columns if c not in keys]]
    ).select(*stream.columns)
    newest = newest_version(spark, root)
    number = int(newest.rpartition("/v")[2]) if newest else 0
    path = f"{root}/v{number + 1}"
    scd2_from_snapshots(rows, date_column, keys, tracked).write.mode("overwrite").parquet(path)
    return path


def upsert_stream(stream: DataFrame, keys: Sequence[str], root: str, checkpoint: str) -> str | None:
    """Keyed upsert of arriving rows; within a batch one row per key is kept."""

    def step(old: DataFrame | None, batch: DataFrame) -> DataFrame:
        rest = [F.col(c).desc() for c in batch.columns if c not in keys]
        rows = latest_per_key(batch, keys, rest) if rest else batch.distinct()
        return rows if old is None else upsert(old, rows, keys)

    return _run(stream, step, root, checkpoint)


def merge_stream(
    stream: DataFrame,
    keys: Sequence[str],
    root: str,
    checkpoint: str,
    removed: str | None = None,
    buckets: int = keyed.BUCKETS,
    ratio: float = keyed.REWRITE_RATIO,
) -> DataFrame | None:
    """Keyed table (see ``sources.keyed``) kept by arriving rows; returns its rows when the stream is drained.

    A micro-batch is written as a delta of its own size, whatever the table's. Within a batch one row per
    key is kept. Rows whose boolean column ``removed`` is true delete their key. A repeated batch changes nothing.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        columns = [c for c in batch.columns if c != removed]
        rest = [F.col(c).desc() for c in batch.columns if c not in keys]
        rows = latest_per_key(batch, keys, rest) if rest else batch.distinct()
        gone = None
        if removed is not None:
            gone = rows.filter(F.coalesce(F.col(removed), F.lit(False))).select(*keys)
            rows = rows.filter(~F.coalesce(F.col(removed), F.lit(False)))
        keyed.apply(batch.sparkSession, root, rows.select(*columns), keys, gone, buckets, ratio)

    (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    spark = stream.sparkSession
    return keyed.read(spark, root) if keyed.current(spark, root) else None


def history_stream(
    stream: DataFrame,
    date_column: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    root: str,
    checkpoint: str,
    buckets: int = keyed.BUCKETS,
) -> DataFrame | None:
    """Versions from arriving full snapshots, kept in a keyed table; a key that a snapshot omits is closed.

    Same history as :func:`scd2_stream` over everything that ever arrived, but a run reads the rows that
    are new, and of the stored versions those that reach the earliest new date; it writes the versions of
    the keys that change. Files are staged per micro-batch, so it makes no difference how a snapshot is
    split, and removed once their rows are in the table. The calendar of dates is committed last: a run that
    fails before that is repeated with the same outcome. The last batch counts for a key and date.
    """

    def stage(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/staged/_batch={batch_id}")

    (
        stream.writeStream.foreachBatch(stage)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    spark, table, dates = stream.sparkSession, f"{root}/versions", f"{root}/calendar"
    calendar = keyed.read(spark, dates) if keyed.current(spark, dates) else None
    done = -1 if calendar is None else calendar.agg(F.max("_batch")).first()[0]
    if table_exists(spark, f"{root}/staged"):
        staged = spark.read.parquet(f"{root}/staged").filter(F.col("_batch") > done)
        rest = [F.col(c).desc() for c in stream.columns if c not in keys]
        newest = latest_per_key(
            staged.withColumn(date_column, F.col(date_column).cast("date")), [*keys, date_column], [F.col("_batch").desc(), *rest]
        )
        newest.write.mode("overwrite").parquet(f"{root}/arrived")
        arrived = spark.read.parquet(f"{root}/arrived")
        if not arrived.isEmpty():
            _splice(spark, arrived, calendar, date_column, keys, tracked, table, buckets)
            days = arrived.groupBy(date_column).agg(F.max("_batch").cast("bigint").alias("_batch"))
            keyed.merge(spark, dates, days, [date_column], buckets=1)
        remove_folder(spark, f"{root}/staged")
    return keyed.read(spark, table) if keyed.current(spark, table) else None


def _splice(spark, arrived, calendar, date_column, keys, tracked, table, buckets) -> None:
    rows, gone = arrived.drop("_batch"), None
    key = [*keys, "effective_from"]
    if calendar is None:
        rows = scd2_from_snapshots(rows, date_column, keys, tracked)
    else:
        rows, gone = splice_snapshots(keyed.read(spark, table), calendar, rows, date_column, keys, tracked)
    keyed.apply(spark, table, rows, key, gone, buckets)
