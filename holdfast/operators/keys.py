"""Key handling shared by the operators: latest row per key and key lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[Column],
    n: int = 1,
    rank: str | None = None,
) -> DataFrame:
    """The first ``n`` rows per key in the given order, with their position as ``rank``.

    Spark keeps only ``n`` rows per key in each map task before the shuffle (window group
    limit), so a key that holds a large share of all rows costs ``n`` rows per task.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    first = df.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= n)
    return first.withColumnRenamed("_rank", rank) if rank else first.drop("_rank")


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_column: str) -> DataFrame:
    """One row per key, the newest by ``order_column``.

    Two copies with the same order value are told apart by all other columns, so the kept
    row does not depend on how the input was read.
    """
    rest = [c for c in df.columns if c not in keys and c != order_column]
    return latest_per_key(df, keys, [F.col(order_column).desc(), *[F.col(c).desc() for c in rest]])


def current_master(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key of a master that is landed append-only: the last ingested one."""
    if "_ingest_ts" in df.columns:
        return dedupe_latest(df, keys, "_ingest_ts")
    rest = [F.col(c).desc() for c in df.columns if c not in keys]
    return latest_per_key(df, keys, rest) if rest else df.distinct()


def latest_value(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """``keys`` and the value of one column in the row that :func:`current_master` keeps of (keys, column).

    Without a landing time that is the largest value, and a hash aggregation finds it: no sort,
    partial sums in the map tasks, and no further shuffle where the rows are dealt by these keys already.
    """
    if "_ingest_ts" in df.columns:
        return current_master(df.select(*keys, column, "_ingest_ts"), *keys).select(*keys, column)
    return df.groupBy(*keys).agg(F.max(column).alias(column))


def mark_known(
    df: DataFrame, column: str, reference: DataFrame, reference_column: str, flag: str
) -> DataFrame:
    """Add ``flag``: whether ``column`` occurs in the reference column. Never NULL.

    Distinct keys first, so that a reference with repeated keys does not multiply rows. No
    broadcast hint: Spark broadcasts the keys while they are below its threshold and
    otherwise uses a sort-merge join whose skewed partitions are split at run time.
    """
    known = reference.select(F.col(reference_column).alias("_known_key")).distinct()
    return (
        df.join(known, F.col(column) == F.col("_known_key"), "left")
        .withColumn(flag, F.col("_known_key").isNotNull())
        .drop("_known_key")
    )


def fk_check(
    df: DataFrame, column: str, reference: DataFrame, reference_column: str | None = None
) -> DataFrame:
    """Usage of each key and whether it is known: rows are pre-aggregated before the join."""
    used = df.groupBy(F.col(column).alias("key_value")).agg(F.count("*").alias("rows_using"))
    return mark_known(used, "key_value", reference, reference_column or column, "is_known")
