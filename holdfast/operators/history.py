"""Keyed upsert, slowly changing dimensions and snapshot comparison on plain DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.operators.keys import current_master
from holdfast.sources import sinks

# Fixed value: end of a version that is still valid
HIGH_DATE = "9999-12-31"
VERSION_COLUMNS = ("effective_from", "effective_to", "is_current")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows, and the target rows whose key the source does not have.

    ``source`` must have one row per key (see ``dedupe_latest``).
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def upsert_table(
    spark: SparkSession, source: DataFrame, path: str | None, new_path: str, keys: Sequence[str]
) -> str:
    """Upsert into the table at ``path`` (None or absent: create); returns the new version.

    The result is a new folder and the old one stays whole until readers have moved on, so
    a lost executor or a failed job never leaves a half-merged table.
    """
    exists = path is not None and sinks.table_exists(spark, path)
    merged = upsert(spark.read.parquet(path), source, keys) if exists else source
    sinks.overwrite(merged, new_path)
    return new_path


def upsert_partitions(
    spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str], partition: str
) -> None:
    """Upsert where the partition column is part of the key.

    Only partitions named by the source are read (dynamic pruning by the semi-join on the
    partition column) and replaced.
    """
    if partition not in keys:
        raise ValueError(f"{partition} must be one of the keys {list(keys)}")
    if not sinks.table_exists(spark, path):
        sinks.overwrite(source, path, [partition])
        return
    touched = source.select(partition).distinct()
    target = spark.read.schema(source.schema).parquet(path).join(touched, partition, "left_semi")
    sinks.replace_partitions(upsert(target, source, keys), path, [partition])


# ---- slowly changing dimensions ---------------------------------------------------


def scd2_initial(incoming: DataFrame, effective_date: str) -> DataFrame:
    """First load: every row is a current version."""
    return incoming.withColumns(
        {
            "effective_from": F.lit(effective_date).cast("date"),
            "effective_to": F.lit(HIGH_DATE).cast("date"),
            "is_current": F.lit(True),
        }
    )


def scd2_apply(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective_date: str,
    close_missing: bool = False,
) -> DataFrame:
    """New state of a versioned dimension after one batch.

    A new key gets a current version, a tracked change (NULL-safe) closes the current version
    and opens one, no change keeps it. A key absent from the batch keeps its version, or is
    closed when ``close_missing`` says that the batch is a full snapshot. ``existing`` is read
    once: history rows go through the join as rows that match nothing, so the plan grows by one
    join a batch. A batch that landed twice is reduced to one row per key.
    """
    columns = incoming.columns
    incoming = current_master(incoming, *keys)
    current = existing.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        F.coalesce(F.col("is_current"), F.lit(True)).alias("_open"),
        F.struct(*[F.col(c) for c in (*columns, *VERSION_COLUMNS)]).alias("old"),
    )
    batch = incoming.select(
        *[F.col(k).alias(f"_n_{k}") for k in keys],
        F.struct(
            *[F.col(c) for c in columns],
            F.lit(effective_date).cast("date").alias("effective_from"),
            F.lit(HIGH_DATE).cast("date").alias("effective_to"),
            F.lit(True).alias("is_current"),
        ).alias("new"),
    )
    same_key: Column = F.col("_open")
    for key in keys:
        same_key = same_key & (F.col(f"_c_{key}") == F.col(f"_n_{key}"))
    same_values: Column = F.lit(True)
    for column in tracked:
        same_values = same_values & F.col(f"old.{column}").eqNullSafe(F.col(f"new.{column}"))
    closed = F.struct(
        *[F.col(f"old.{c}").alias(c) for c in columns],
        F.col("old.effective_from").alias("effective_from"),
        F.lit(effective_date).cast("date").alias("effective_to"),
        F.lit(False).alias("is_current"),
    )
    absent = F.when(F.col("_open"), closed).otherwise(F.col("old")) if close_missing else F.col("old")
    versions = (
        F.when(F.col("new").isNull(), F.array(absent))
        .when(F.col("old").isNull(), F.array(F.col("new")))
        .when(same_values, F.array(F.col("old")))
        .otherwise(F.array(closed, F.col("new")))
    )
    return (
        current.join(batch, same_key, "full_outer")
        .select(F.explode(versions).alias("v"))
        .select("v.*")
    )


def scd2_from_snapshots(
    snapshots: DataFrame,
    date_column: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Versions from a series of dated full snapshots, in one shuffle by key.

    A version runs while the key is in every snapshot with unchanged tracked values; it ends
    on the date of the first snapshot that changes or omits it. The window holds one row per
    snapshot of a key, and the calendar of snapshot dates is as small as their number. ``calendar``
    has the dates where ``snapshots`` holds some keys only.
    """
    dates = (snapshots if calendar is None else calendar).select(F.col(date_column).alias("_date")).distinct()
    in_order = Window.orderBy("_date")
    calendar = dates.withColumns(
        {"_before": F.lag("_date").over(in_order), "_after": F.lead("_date").over(in_order)}
    )
    attributes = [c for c in snapshots.columns if c != date_column]
    by_key = Window.partitionBy(*keys).orderBy("_date")
    values = F.struct(*tracked)
    continued = F.lag("_date").over(by_key).eqNullSafe(F.col("_before")) & F.lag(values).over(
        by_key
    ).eqNullSafe(values)
    return (
        snapshots.withColumnRenamed(date_column, "_date")
        .join(calendar, "_date")
        .withColumn("_starts", F.when(continued & F.col("_before").isNotNull(), 0).otherwise(1))
        .withColumn("_version", F.sum("_starts").over(by_key))
        .groupBy(*keys, "_version")
        .agg(
            *[F.min_by(c, "_date").alias(c) for c in attributes if c not in keys],
            F.min("_date").cast("date").alias("effective_from"),
            F.max_by("_after", "_date").cast("date").alias("_ends"),
        )
        .withColumn("effective_to", F.coalesce("_ends", F.lit(HIGH_DATE).cast("date")))
        .withColumn("is_current", F.col("_ends").isNull())
        .select(*attributes, *VERSION_COLUMNS)
    )


def splice_snapshots(
    versions: DataFrame,
    calendar: DataFrame,
    arrived: DataFrame,
    date_column: str,
    keys: Sequence[str],
    tracked: Sequence[str],
) -> tuple[DataFrame, DataFrame]:
    """What snapshot rows change in a stored history: (new versions, versions that they replace).

    ``versions`` as :func:`scd2_from_snapshots` returns them for the dates of ``calendar``; ``arrived`` holds
    one row per key and date, dates and keys, with ``date_column`` a date: new dates, late ones between known
    ones, or further or corrected rows of a known date. At a date that is new, a key that did not arrive is
    absent; at a known date it stays as it was. Only keys whose stored version says something else on an
    arrived date are derived again, from the last date before on, and spliced to what was before. The dates
    reach the driver, rows do not. Untracked columns of a version that is split are those it had.
    """
    known = sorted(r[0] for r in calendar.select(F.col(date_column).cast("date")).distinct().collect())
    fresh = sorted(r[0] for r in arrived.select(date_column).distinct().collect())
    if not fresh:
        return versions.limit(0), versions.limit(0).select(*keys, "effective_from")
    since = max((d for d in known if d < fresh[0]), default=fresh[0])
    days = lambda dates: F.array(*[F.lit(d) for d in dates]).cast("array<date>")
    valid = lambda d: (F.col("effective_from") <= d) & (d < F.col("effective_to"))
    same_key = [F.col(f"_k{i}").eqNullSafe(F.col(k)) for i, k in enumerate(keys)]
    renamed = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]

    def on(dates: list) -> DataFrame:
        """The stored rows of some dates, one per key and date."""
        return versions.filter(F.col("effective_to") > F.lit(since)).withColumn(
            date_column, F.explode(F.filter(days(dates), valid))
        )

    said = on(fresh).select(*renamed, F.col(date_column).alias("_day"), F.struct(*tracked).alias("_said"))
    rows = arrived.select(*keys, date_column, F.struct(*tracked).alias("_now"))
    met = said.join(rows, [*same_key, F.col("_day") == F.col(date_column)], "full_outer")
    unheard = F.col("_now").isNull() & F.lit(not set(fresh) <= set(known)) & ~F.array_contains(days(known), F.col("_day"))
    differs = F.col("_now").isNotNull() & ~F.col("_now").eqNullSafe(F.col("_said"))
    heard = F.col("_now").isNotNull()
    touched = met.filter(unheard | differs).select(
        *[F.when(heard, F.col(k)).otherwise(F.col(f"_k{i}")).alias(f"_k{i}") for i, k in enumerate(keys)]
    ).distinct()
    columns = [c for c in versions.columns if c not in VERSION_COLUMNS]
    replaced = versions.filter(F.col("effective_to") > F.lit(since)).join(touched, same_key, "left_semi")
    stays = on([d for d in known if d >= since]).join(touched, same_key, "left_semi")
    sent = arrived.select(*renamed, F.col(date_column).alias("_day"))
    stays = stays.join(sent, [*same_key, F.col("_day") == F.col(date_column)], "left_anti")
    daily = stays.select(*columns, date_column).unionByName(
        arrived.join(touched, same_key, "left_semi").select(*columns, date_column)
    )
    dates = versions.sparkSession.createDataFrame(
        [(d,) for d in sorted({d for d in known if d >= since} | set(fresh))], f"`{date_column}` date"
    )
    derived = scd2_from_snapshots(daily, date_column, keys, tracked, dates)
    begun = replaced.filter(F.col("effective_from") < F.lit(since)).select(*renamed, F.col("effective_from").alias("_begun"))
    goes_on = [*same_key, F.col("effective_from") == F.lit(since)]
    spliced = derived.join(begun, goes_on, "left").withColumn(
        "effective_from", F.coalesce("_begun", "effective_from")
    )
    return spliced.select(*versions.columns), replaced.select(*keys, "effective_from")


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changed keys between two snapshots: insert, update or delete."""
    rest = [c for c in new.columns if c not in keys]
    before = old.select(*keys, F.struct(*rest).alias("_old"))
    after = new.select(*keys, F.struct(*rest).alias("_new"))
    return (
        before.join(after, list(keys), "full_outer")
        .filter(~F.col("_old").eqNullSafe(F.col("_new")))
        .select(
            *keys,
            F.when(F.col("_old").isNull(), "insert")
            .when(F.col("_new").isNull(), "delete")
            .otherwise("update")
            .alias("change_type"),
        )
    )
