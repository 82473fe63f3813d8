"""Append-only tables whose columns grow, and tables laid out so that a slice reads few files."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from holdfast.sources import sinks

# Types whose values all fit in a later one of their row
_WIDER = (("tinyint", "smallint", "int", "bigint"), ("float", "double"), ("tinyint", "smallint", "int", "double"))


class SchemaError(ValueError):
    """A batch whose columns do not fit the table."""


# ---- append with schema merge -----------------------------------------------------


def wider(a: DataType, b: DataType) -> DataType | None:
    """The one of two types that holds all values of both; None where neither does."""
    if a == b:
        return a
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        for x, y in ((a, b), (b, a)):
            if x.scale >= y.scale and x.precision - x.scale >= y.precision - y.scale:
                return x
        return None
    for row in _WIDER:
        if {a.simpleString(), b.simpleString()} <= set(row):
            return max(a, b, key=lambda t: row.index(t.simpleString()))
    return None


def merged_schema(table: StructType, batch: StructType) -> StructType:
    """The table's columns, widened where the batch needs it, then the batch's new ones; all nullable.

    A column of one name in other letters, or of a type that does not fit, is an error: nothing is narrowed.
    """
    known = {f.name: f.dataType for f in table.fields}
    letters = {name.lower(): name for name in known}
    for f in batch.fields:
        same = letters.setdefault(f.name.lower(), f.name)
        if same != f.name:
            raise SchemaError(f"column {f.name} differs from {same} in letter case only")
        kind = wider(known[f.name], f.dataType) if f.name in known else f.dataType
        if kind is None:
            raise SchemaError(f"column {f.name}: {f.dataType.simpleString()} does not fit {known[f.name].simpleString()}")
        known[f.name] = kind
    return StructType([StructField(name, kind, True) for name, kind in known.items()])


def _log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("schema string, version bigint").parquet(f"{path}/_schemas")


def logged_schema(spark: SparkSession, path: str) -> tuple[int, StructType] | None:
    """(version, columns) of a table from its schema log; None where there is none yet."""
    try:
        newest = _log(spark, path).orderBy(F.col("version").desc()).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    return None if newest is None else (newest["version"], StructType.fromJson(json.loads(newest["schema"])))


def append_merge(spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> StructType:
    """Append rows whose columns may be more, fewer, wider or narrower than the table's; returns its columns.

    The schema log of the table gets a version when they change, before the rows are written: a reader
    never meets a column that the log does not know. Values of a narrower type are stored in the table's. One
    writer at a time. The first append makes the table.
    """
    known = logged_schema(spark, path)
    columns = merged_schema(known[1] if known else StructType([]), df.schema)
    if known is None or columns != known[1]:
        row = spark.createDataFrame([(json.dumps(columns.jsonValue()),)], "schema string").coalesce(1)
        row.write.mode("overwrite").parquet(f"{path}/_schemas/version={known[0] + 1 if known else 1}")
    sent = df.select(*[F.col(f"`{f.name}`").cast(columns[f.name].dataType).alias(f.name) for f in df.schema.fields])
    sinks.append(sent, path, partition_by)
    return columns


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """All rows of an appended table with the columns of its schema log; older rows have NULL in newer ones."""
    known = logged_schema(spark, path)
    if known is None:
        raise ValueError(f"no schema log at {path}")
    stored = spark.read.schema(known[1]).parquet(path)
    return stored.select(*[F.col(f"`{name}`") for name in known[1].names])


# ---- clustered layout -------------------------------------------------------------

# Ranges of one column in the interleaved key: 2**CLUSTER_BITS
CLUSTER_BITS = 6
# Distinct values that are drawn to place the ranges: a bounded sample; the layout depends on it, no result
CLUSTER_SAMPLE = 1024


class Between(NamedTuple):
    """The values from ``low`` to ``high``, both included."""

    low: object
    high: object


def _range_edges(df: DataFrame, column: str, bits: int) -> list:
    """Values at which the ranges of a column begin, from the second on; at most 2**bits - 1."""
    drawn = df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(F.xxhash64(column), column).limit(CLUSTER_SAMPLE)
    values = sorted(r[0] for r in drawn.collect())
    ranges = 1 << bits
    return sorted({values[i * len(values) // ranges] for i in range(1, ranges)}) if values else []


def with_cluster_key(df: DataFrame, columns: Sequence[str], bits: int = CLUSTER_BITS) -> DataFrame:
    """``_cluster``: a sort key in which rows that are close in every column are close, the bits of their ranges in turn.

    A row finds its range by halving, ``bits`` comparisons for a column. Each step is a column of its own that the
    next one reads twice, so that it is worked out once. NULL is in the first range.
    """
    keyed, key = df, F.lit(0).cast("bigint")
    for place, column in enumerate(columns):
        kind, edges = df.schema[column].dataType, _range_edges(df, column, bits)
        padded = F.array(*[F.lit(e).cast(kind) for e in edges + [None] * ((1 << bits) - 1 - len(edges))])
        number = f"_range{place}"
        keyed = keyed.withColumn(number, F.lit(0))
        for bit in reversed(range(bits)):
            reached = F.col(column) >= F.get(padded, F.col(number) + ((1 << bit) - 1))
            keyed = keyed.withColumn(number, F.col(number) + F.coalesce(reached.cast("int"), F.lit(0)) * (1 << bit))
        # A range's number with its bits at their places in the key
        spread = [
            sum((n >> bit & 1) << (bit * len(columns) + len(columns) - 1 - place) for bit in range(bits))
            for n in range(1 << bits)
        ]
        key = key.bitwiseOR(F.get(F.array(*[F.lit(s).cast("bigint") for s in spread]), F.col(number)))
    return keyed.withColumn("_cluster", key).drop(*[f"_range{place}" for place in range(len(columns))])


def create_clustered(spark: SparkSession, df: DataFrame, path: str, columns: Sequence[str], files: int) -> None:
    """Write a table in about ``files`` files, each a small range of every clustering column, with their bounds.

    The bounds of each file (least and greatest value of each clustering column, whether it has NULLs) are kept
    beside the table, so that a reader of a slice opens only the files that can hold it.
    """
    laid = with_cluster_key(df, columns).repartitionByRange(files, "_cluster", *columns)
    laid.sortWithinPartitions("_cluster", *columns).drop("_cluster").write.mode("overwrite").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path).select(*columns, F.col("_metadata.file_name").alias("_file"))
    bounds = [f(c).alias(f"_{name}{i}") for i, c in enumerate(columns) for name, f in (("low", F.min), ("high", F.max))]
    nulls = [F.bool_or(F.col(c).isNull()).alias(f"_null{i}") for i, c in enumerate(columns)]
    named = stored.groupBy("_file").agg(*bounds, *nulls).withColumn("_columns", F.lit(json.dumps(list(columns))))
    named.coalesce(1).write.mode("overwrite").parquet(f"{path}/_bounds")


def read_clustered(spark: SparkSession, path: str, schema: StructType, **slices: object) -> DataFrame:
    """Rows of a clustered table with given values or ranges (``Between``) of clustering columns.

    Files whose bounds exclude the slice are not opened; in the others Parquet's row groups are skipped by the
    same condition. A NULL asks for the NULLs of a column.
    """
    bounds = spark.read.parquet(f"{path}/_bounds")
    first = bounds.select("_columns").first()
    order = json.loads(first[0]) if first else []
    wanted, may = F.lit(True), F.lit(True)
    for column, value in slices.items():
        i, kind = order.index(column) if first else 0, schema[column].dataType
        if value is None:
            wanted, may = wanted & F.col(column).isNull(), may & F.col(f"_null{i}")
            continue
        low, high = value if isinstance(value, Between) else (value, value)
        low, high = F.lit(low).cast(kind), F.lit(high).cast(kind)
        wanted = wanted & F.col(column).between(low, high)
        may = may & (F.col(f"_low{i}") <= high) & (F.col(f"_high{i}") >= low)
    files = [f"{path}/{r[0]}" for r in bounds.filter(may).select("_file").collect()] if first else []
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files).filter(wanted)
