"""Sinks on plain Parquet: append, slice replacement, partition replacement, CSV export.

Every write ends with Spark's own commit: a failed attempt leaves the old files in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a readable Parquet table is at ``path``."""
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException:
        return False


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of finished steps, in whatever store it is; none there is no error."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def written_once(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a new folder and read back, for steps that would work it out several times."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one table partition together, large ones split, small ones merged (AQE)."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    _balanced(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    _balanced(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions that occur in ``df``; all others stay."""
    (
        _balanced(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def replace_slice(df: DataFrame, path: str, column: str, value: str, cluster_by: str) -> None:
    """Replace one slice, also by nothing: a rerun without rows clears the old ones.

    The slice's own folder is overwritten, because replacing only the partitions that occur
    would keep the old rows when there are no new ones.
    """
    (
        df.filter(F.col(column) == value)
        .drop(column)
        .sortWithinPartitions(cluster_by)
        .write.mode("overwrite")
        .parquet(f"{path}/{column}={value}")
    )


def replace_runs(df: DataFrame, path: str, column: str, values: Sequence[str]) -> None:
    """Replace the slices of the named runs; a run that now has no row has an empty slice."""
    rows = df.filter(F.col(column).isin(*values))
    filled = {r[0] for r in rows.select(column).distinct().collect()}
    replace_partitions(rows, path, [column])
    for value in sorted(set(values) - filled):
        replace_slice(rows, path, column, value, next(c for c in df.columns if c != column))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a table's data files."""
    files = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.sum("file_size")).first()[0] or 0


def compact(
    spark: SparkSession, path: str, target: str, cluster_by: str, file_bytes: int = 128 << 20
) -> None:
    """Rewrite a table into files of about ``file_bytes``, range-clustered and sorted by a key."""
    files = max(1, -(-stored_bytes(spark, path) // file_bytes))
    (
        spark.read.parquet(path)
        .repartitionByRange(files, cluster_by)
        .sortWithinPartitions(cluster_by)
        .write.mode("overwrite")
        .parquet(target)
    )


def export_csv(df: DataFrame, path: str, joined: str, separator: str = "; ") -> StructType:
    """Write rows as CSV with a header, columns in name order, the list column as one text."""
    columns = sorted(df.columns)
    text = df.withColumn(joined, F.array_join(joined, separator)).select(*columns)
    text.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return StructType(
        [
            StructField(f.name, StringType() if f.name == joined else f.dataType, True)
            for f in text.schema.fields
        ]
    )
