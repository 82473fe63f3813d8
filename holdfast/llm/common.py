"""Helpers shared by the corpus operators: words, written tables, span texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from holdfast.session import work_dir

# A word is a maximal run of characters other than these
SPACE = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """The words of a text in order; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: later steps read files that every executor sees, so a lost executor
    costs the tasks that ran on it and not the steps before.
    """
    path = work_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str = "row_id") -> DataFrame:
    """``df`` with a distinct number per row; write the result before it is used twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def held(documents: DataFrame, label: str) -> DataFrame:
    """``documents`` as (row_id, doc): a distinct number per row and its columns as a struct.

    Whatever the columns are called, they cannot clash with those that an operator adds. Where
    doc_id is a whole number, never null and never repeated, it is the row's number, and the
    documents are read where they are. Otherwise rows get numbers of their own in a copy,
    written once. Results are the same; a unique id saves the copy.
    """
    packed = documents.select(F.struct("*").alias("doc"))
    if isinstance(documents.schema["doc_id"].dataType, IntegralType):
        counted = documents.groupBy("doc_id").agg(F.count("*").alias("n"))
        if counted.filter((F.col("n") > 1) | F.col("doc_id").isNull()).isEmpty():
            return packed.select(F.col("doc.doc_id").cast("bigint").alias("row_id"), "doc")
    return written(numbered(packed), label)


def body(documents: DataFrame) -> DataFrame:
    """(row_id, doc_id, text) of :func:`held`."""
    return documents.select("row_id", "doc.doc_id", "doc.text")


def filter_once(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on columns that cost much to work out.

    Spark moves a filter below the projection that it reads and then works the columns out
    once more for every mention. It leaves a projection alone that numbers its rows.
    """
    marked = df.withColumn("_once", F.monotonically_increasing_id())
    return marked.filter(condition & (F.col("_once") >= 0)).drop("_once")
