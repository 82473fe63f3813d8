"""Feed readers, batch and streaming: explicit schema, rescued values, audit columns."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from functools import reduce
from operator import add
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from holdfast.sources.schemas import FORMATS, RESCUE_COLUMN, SCHEMAS


# Files that one trigger of a stream takes
MAX_FILES = 1000


def batch_id(source: str, run_timestamp: str) -> str:
    """``<source>__<run timestamp>``: the same inputs give the same id."""
    return f"{source}__{run_timestamp}"


def with_audit(
    df: DataFrame, source_file: Column | str, batch: str, ingested: Column | None = None
) -> DataFrame:
    """Add ``_ingest_ts``, ``_source_file`` and ``_batch_id``."""
    return df.withColumns(
        {
            "_ingest_ts": F.current_timestamp() if ingested is None else ingested,
            "_source_file": F.lit(source_file) if isinstance(source_file, str) else source_file,
            "_batch_id": F.lit(batch),
        }
    )


def rescue_json(lines: DataFrame, schema: StructType, line: str = "value") -> DataFrame:
    """JSON lines as typed columns; whatever breaks the contract goes to the rescue column.

    The line is parsed once, to a map of texts. A field outside the schema and a value that
    does not cast to its type are kept there as JSON; a line that is no JSON object is kept
    whole. No row is lost and a field that is only absent is not drift.
    """
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    fields = F.col("_fields")
    typed = [
        F.expr(f"try_cast(_fields['{f.name}'] AS {f.dataType.simpleString()})").alias(f.name)
        for f in schema.fields
    ]
    broken = {
        f.name: fields[f.name].isNotNull()
        & F.expr(f"try_cast(_fields['{f.name}'] AS {f.dataType.simpleString()})").isNull()
        for f in schema.fields
        if not isinstance(f.dataType, StringType)
    }
    wrong = F.array_compact(F.array(*[F.when(b, F.lit(n)) for n, b in broken.items()]))
    outside = F.map_filter(
        fields, lambda k, v: ~F.array_contains(known, k) | F.array_contains(F.col("_wrong"), k)
    )
    parsed = lines.withColumn("_fields", F.from_json(line, "map<string,string>")).withColumn(
        "_wrong", wrong
    )
    # Nearly every line holds known fields only, each once, and none is wrong: it is not filtered field by field
    held = reduce(add, [F.map_contains_key(fields, F.lit(f.name)).cast("int") for f in schema.fields])
    plain = (F.size("_wrong") == 0) & (F.size(fields) == held)
    return parsed.select(
        *[c for c in lines.columns if c != line],
        *typed,
        F.when(fields.isNull(), F.col(line))
        .when(plain, F.lit(None).cast("string"))
        .when(F.size(outside) > 0, F.to_json(outside))
        .alias(RESCUE_COLUMN),
    )


def _csv_options(reader, schema: StructType, header: bool):
    rescued = StructType([*schema.fields, StructField(RESCUE_COLUMN, StringType(), True)])
    return (
        reader.schema(rescued)
        .option("header", header)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RESCUE_COLUMN)
    )


# A value of a CSV line behind its comma, quoted or not
_CSV_VALUE = r',("(?:[^"\\\\]|\\\\.|"")*"|[^,]*)'
_PLACE = "_extra_"


def split_csv(line: Column) -> Column:
    """The values of one CSV record as an array of texts, as many as there are; empty ones NULL."""
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CSV_VALUE), F.lit(1))
    inner = lambda v: F.regexp_replace(F.substring(v, 2, F.length(v) - 2), r'[\\"]"', '"')
    return F.transform(found, lambda v: F.nullif(F.when(v.startswith('"'), inner(v)).otherwise(v), F.lit("")))


def header_names(values: Sequence[str | None]) -> list[str]:
    """Names of a header's columns; an empty or repeated one is named after its place."""
    names: list[str] = []
    for i, value in enumerate(values):
        name = (value or "").lstrip("\ufeff").strip()
        usable = name and name not in names and not name.startswith(_PLACE)
        names.append(name if usable else f"{_PLACE}{i + 1}")
    return names


def csv_layouts(spark: SparkSession, paths: str | Sequence[str]) -> list[Row]:
    """(header, torn, slashed, own, files) of the CSV files at ``paths``, one row per distinct header.

    One grouped pass over the lines finds each file's first line, whether any line has an odd
    number of quotes, so that a value of the file holds a line end, and whether quotes inside values are
    marked by a backslash and not doubled. What reaches the driver is the headers and the file names.
    A set among the aggregates makes Spark group by an object hash, one entry per file; with a text and
    flags alone it would sort all lines of a task.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(paths).select(
        "value", "_metadata.file_path", "_metadata.file_block_start", (quotes % 2 == 1).alias("odd"),
        F.contains("value", F.lit('\\"')).alias("slash"),
        F.monotonically_increasing_id().alias("at"),
    )
    by_file = lines.groupBy("file_path").agg(
        F.min_by("value", F.when(F.col("file_block_start") == 0, F.col("at"))).alias("header"),
        F.array_contains(F.collect_set("odd"), True).alias("torn"),
        F.bool_or("slash").alias("slashed"),
    )
    # A header with a line end inside is told apart by file: its first line alone does not name it
    cut = F.when((F.length("header") - F.length(F.replace("header", F.lit('"'), F.lit("")))) % 2 == 1, F.col("file_path"))
    return by_file.groupBy("header", "torn", "slashed", cut.alias("own")).agg(F.collect_list("file_path").alias("files")).collect()


def literal_path(path: str) -> str:
    """A file's name with no character of it read as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _bound(spark: SparkSession, schema: StructType, layout: Row) -> DataFrame:
    files = [literal_path(unquote(f)) for f in layout["files"]]
    reader = spark.read.option("multiLine", layout["torn"]).option("columnPruning", False)
    reader = reader.option("escape", "\\" if layout["slashed"] else '"')
    if layout["own"] is not None:
        names = header_names(reader.option("header", False).csv(files[:1]).first() or ())
    else:
        names = header_names(next(csv.reader([layout["header"]]), []))
    columns = ", ".join(f"_c{i} string" for i in range(len(names)))
    raw = (
        reader.schema(f"{columns}, _whole string").option("header", True).option("enforceSchema", True)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_whole").csv(files)
    )
    place = {name: F.col(f"_c{i}") for i, name in enumerate(names)}
    cast = {
        f.name: F.expr(f"try_cast({f'_c{names.index(f.name)}' if f.name in place else 'NULL'} AS {f.dataType.simpleString()})")
        for f in schema.fields
    }
    entry = lambda k, v: F.struct(k.alias("k"), v.alias("v"))
    drift = [
        F.when(value.isNotNull() & (cast[name].isNull() if name in cast else F.lit(True)), entry(F.lit(name), value))
        for name, value in place.items()
        if name not in cast or not isinstance(schema[name].dataType, StringType)
    ]
    more = F.slice(split_csv(F.col("_whole")), len(names) + 1, 1 << 30)
    named = F.transform(more, lambda v, i: entry(F.concat(F.lit(_PLACE), (i + len(names) + 1).cast("string")), v))
    beyond = F.coalesce(F.filter(named, lambda e: e["v"].isNotNull()), F.array().cast("array<struct<k:string,v:string>>"))
    rescued = F.concat(F.array_compact(F.array(*drift)), beyond) if drift else beyond
    return raw.select(
        *[value.alias(name) for name, value in cast.items()],
        F.when(F.size(rescued) > 0, F.to_json(F.map_from_entries(rescued))).alias(RESCUE_COLUMN),
        F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B"))).alias("_file_name"),
    )


def read_csv(spark: SparkSession, schema: StructType, paths: str | Sequence[str]) -> DataFrame:
    """CSV files as typed columns bound by each file's header, with the rescue column and ``_file_name``.

    Files of one header are one scan of Spark's CSV reader, of whatever width; files with a line end
    inside a value are read record by record, the others are split. A column the file lacks is NULL.
    A column the contract lacks, a value that does not cast and a value beyond the header go to the rescue
    column as JSON, like those of JSON feeds. Only a file's first record is its header.
    """
    bound = [_bound(spark, schema, layout) for layout in csv_layouts(spark, paths)]
    if not bound:
        names = [RESCUE_COLUMN, "_file_name"]
        return spark.createDataFrame([], StructType([*schema.fields, *[StructField(n, StringType(), True) for n in names]]))
    return reduce(DataFrame.unionByName, bound)


def read_feed(spark: SparkSession, feed: str, path: str, header: bool = True) -> DataFrame:
    """All files of a feed folder as one typed DataFrame with the rescue column.

    CSV columns are bound by each file's header; without one, by position.
    """
    schema = SCHEMAS[feed]
    if FORMATS[feed] == "json":
        return rescue_json(spark.read.text(path), schema)
    if header:
        return read_csv(spark, schema, path).drop("_file_name")
    return _csv_options(spark.read, schema, header).csv(path)


def stream_feed(
    spark: SparkSession, feed: str, path: str, max_files: int = MAX_FILES
) -> DataFrame:
    """The same rows of a JSON feed as a stream that sees each file once; keeps the file name.

    A trigger takes at most ``max_files``, so a backlog is read in steps of a bounded size.
    """
    if FORMATS[feed] != "json":
        raise ValueError(f"{feed} is bound by the headers of its files: see stream_files and read_csv")
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    name = F.col("_metadata.file_name").alias("_file_name")
    return rescue_json(reader.text(path).select("value", name), SCHEMAS[feed])


def stream_files(spark: SparkSession, path: str, max_files: int = MAX_FILES) -> DataFrame:
    """The names (``path``) of arriving files as a stream; their content is not read.

    A micro-batch holds at most ``max_files`` names. Whatever depends on a whole file, such as its header,
    is worked out when its batch runs, so it makes no difference when a file arrives.
    """
    listed = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(listed).option("maxFilesPerTrigger", max_files)
    return reader.load(path).select("path")
