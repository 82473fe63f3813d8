"""Rules on a stream: flags by stream-static joins, tiers, and the split in two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.text import is_blank
from holdfast.operators.keys import latest_per_key
from holdfast.operators.quality import FLAG_CODES, MandatoryKeyError, with_flags
from holdfast.sources import keyed


def flag_stream(stream: DataFrame, portfolios: DataFrame, assets: DataFrame) -> DataFrame:
    """``_dq_reason`` on each streamed row, NULL when valid; no row is dropped."""
    return (
        with_flags(stream, portfolios, assets)
        .drop(*FLAG_CODES)
        .withColumnRenamed("dq_reason", "_dq_reason")
    )


# Expectation -> tier and the column that must be filled. FAIL is judged on
# every row, WARN on the valid ones.
EXPECTATIONS = {
    "has_transaction_id": ("FAIL", "transaction_id"),
    "has_counterparty": ("WARN", "counterparty_id"),
}


def _counters() -> list:
    valid = F.col("_dq_reason").isNull()
    return [
        F.count("*").alias("rows_seen"),
        F.count_if(valid).alias("rows_valid"),
        F.count_if(~valid).alias("rows_quarantined"),
        *[
            F.count_if((F.lit(tier == "FAIL") | valid) & is_blank(F.col(column))).alias(name)
            for name, (tier, column) in EXPECTATIONS.items()
        ],
    ]


def route(flagged: DataFrame, tables: str, checkpoint: str) -> None:
    """Drain a flagged stream into ``silver``, ``quarantine`` and ``expectations`` tables.

    Each micro-batch is kept once in memory for its three outputs. Every output is written
    to the folder of the batch id and replaces it, so a batch that is repeated after a
    failure leaves the same rows. A missing mandatory key stops the stream before anything
    of the batch is written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            counted = batch.agg(*_counters())
            counts = counted.first()
            for name, (tier, column) in EXPECTATIONS.items():
                if tier == "FAIL" and counts[name]:
                    raise MandatoryKeyError(f"{counts[name]} row(s) missing '{column}'")
            outputs = {
                "silver": batch.filter(F.col("_dq_reason").isNull()).drop("_dq_reason"),
                "quarantine": batch.filter(F.col("_dq_reason").isNotNull()).withColumnRenamed(
                    "_dq_reason", "quarantine_reason"
                ),
                "expectations": counted,
            }
            for name, rows in outputs.items():
                rows.write.mode("overwrite").parquet(f"{tables}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    (
        flagged.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def expectation_counts(written: DataFrame) -> DataFrame:
    """Failed rows per expectation over all batches, with its tier."""
    names = list(EXPECTATIONS)
    tiers = F.create_map(*[F.lit(x) for n, (t, _) in EXPECTATIONS.items() for x in (n, t)])
    totals = written.agg(*[F.sum(n).alias(n) for n in names])
    return totals.unpivot([], names, "expectation", "failed_rows").withColumn(
        "tier", tiers[F.col("expectation")]
    )


def dedupe_stream(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """First arrival per key; the watermark bounds how long a key is remembered."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def dedupe_by_table(
    stream: DataFrame, key: str, root: str, checkpoint: str, buckets: int = keyed.BUCKETS
) -> DataFrame | None:
    """First arrival per key over the whole history, without state that grows in memory; returns the kept rows.

    The keys that have landed are a keyed table with the number of the batch that brought each. A batch reads
    the buckets of its own keys, keeps the rows whose key is new, or is its own from an attempt that failed, and adds
    their keys as a delta. Within a batch the row that sorts first by all columns stays. NULL is a key.
    """
    seen, target = f"{root}/seen", f"{root}/rows"

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = latest_per_key(batch, [key], [F.col(c) for c in batch.columns if c != key] or [F.lit(0)])
        if keyed.current(spark, seen) is not None:
            before = keyed.read_near(spark, seen, rows).filter(F.col("_batch") != batch_id).select(F.col(key).alias("_seen"))
            rows = rows.join(before, F.col(key).eqNullSafe(F.col("_seen")), "left_anti")
        path = f"{target}/_batch={batch_id}"
        rows.write.mode("overwrite").parquet(path)
        new = spark.read.schema(rows.schema).parquet(path).select(key, F.lit(batch_id).cast("bigint").alias("_batch"))
        keyed.apply(spark, seen, new, [key], buckets=buckets)

    (
        stream.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    spark = stream.sparkSession
    return spark.read.parquet(target).drop("_batch") if keyed.current(spark, seen) is not None else None
