"""Incremental landing of feeds: drain what is there, then stop."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from holdfast.sources.feeds import literal_path, batch_id, read_csv, stream_feed, stream_files, with_audit
from holdfast.sources.schemas import FORMATS, SCHEMAS

# Number of the micro-batch that landed a CSV file, as a folder of the table
LANDED = "_landed"


def ingest(
    spark: SparkSession, feed: str, raw: str, tables: str, checkpoints: str, run_ts: str
) -> StreamingQuery:
    """Start landing the new files of one feed in ``<tables>/raw_<feed>``.

    The checkpoint remembers the files already read. JSON goes through the file sink, which commits
    each batch once. CSV files are bound by their own headers when their batch runs, and
    the batch is written to the folder of its number, which a repeated batch replaces. Either way a
    rerun, or a restart after a failure, neither repeats nor loses rows.
    """
    source, target, batch = f"{raw}/{feed}", f"{tables}/raw_{feed}", batch_id(feed, run_ts)

    def audited(rows: DataFrame) -> DataFrame:
        return with_audit(rows, F.col("_file_name"), batch).drop("_file_name")

    def land(names: DataFrame, number: int) -> None:
        files = [literal_path(r["path"]) for r in names.collect()]
        if files:
            rows = read_csv(names.sparkSession, SCHEMAS[feed], files)
            audited(rows).write.mode("overwrite").parquet(f"{target}/{LANDED}={number}")

    if FORMATS[feed] == "json":
        writer = audited(stream_feed(spark, feed, source)).writeStream.format("parquet").option("path", target)
    else:
        writer = stream_files(spark, source).writeStream.foreachBatch(land)
    return (
        writer.option("checkpointLocation", f"{checkpoints}/{feed}")
        .trigger(availableNow=True)
        .queryName(f"ingest-{feed}")
        .start()
    )


def landed(spark: SparkSession, feed: str, tables: str) -> DataFrame:
    """The landed rows of a feed, with the contract's columns, the rescue column and the audit columns."""
    return spark.read.parquet(f"{tables}/raw_{feed}").drop(LANDED)


def ingest_all(
    spark: SparkSession,
    raw: str,
    tables: str,
    checkpoints: str,
    run_ts: str,
    feeds: Iterable[str] = tuple(SCHEMAS),
) -> list[StreamingQuery]:
    """Start every feed, then wait for each; a failed stream raises here."""
    running = [ingest(spark, feed, raw, tables, checkpoints, run_ts) for feed in feeds]
    for query in running:
        query.awaitTermination()
    return running


def drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything that is available in a stream to a Parquet table and stop."""
    (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
