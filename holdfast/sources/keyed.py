"""Tables merged by key: Parquet files in hash buckets, and a manifest that names the current ones.

A batch is written as a delta of its own size, with marks for deleted keys. Readers merge a bucket's
deltas by key; a bucket is rewritten when its deltas have grown to a share of it. A commit is one new manifest file:
a reader that has resolved a version keeps reading that version's files. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from holdfast.operators.keys import latest_per_key

BUCKETS = 64
# A bucket is rewritten when its deltas hold this share of the rows below them
REWRITE_RATIO = 0.5

_GENERATION, _BUCKET, _DELETED = "_generation", "_bucket", "_deleted"
_MANIFEST = "bucket bigint, generation bigint, rows bigint, delta boolean, settings string, version bigint"


class Part(NamedTuple):
    """The rows of one bucket that one write left."""

    bucket: int
    generation: int
    rows: int
    delta: bool


class Version(NamedTuple):
    """What a manifest says: the parts of the table, oldest first, its keys, buckets and columns."""

    root: str
    number: int
    keys: tuple[str, ...]
    buckets: int
    schema: StructType
    parts: tuple[Part, ...]


def current(spark: SparkSession, root: str) -> Version | None:
    """The newest version of the table at ``root``; None where there is none."""
    try:
        manifests = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = manifests.agg(F.max("version")).first()[0]
    if newest is None:
        return None
    rows = manifests.filter(F.col("version") == newest).collect()
    said = json.loads(next(r["settings"] for r in rows if r["settings"]))
    parts = sorted(Part(r["bucket"], r["generation"], r["rows"], r["delta"]) for r in rows if r["settings"] is None)
    return Version(root, newest, tuple(said["keys"]), said["buckets"], StructType.fromJson(said["schema"]), tuple(parts))


def _commit(spark: SparkSession, version: Version) -> Version:
    said = json.dumps({"keys": version.keys, "buckets": version.buckets, "schema": version.schema.jsonValue()})
    rows = [(None, None, None, None, said), *[(*part, None) for part in version.parts]]
    # One task and one file: the version is there whole or not at all
    manifest = spark.createDataFrame(rows, _MANIFEST.rpartition(",")[0]).coalesce(1)
    manifest.write.mode("overwrite").parquet(f"{version.root}/manifest/version={version.number}")
    return version


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def _write(spark: SparkSession, version: Version, rows: DataFrame, generation: int, delta: bool, spread: bool) -> list[Part]:
    """Write rows (with ``_deleted``) as one generation and count them by bucket.

    Rows that are ``spread`` come from a shuffle by key: every task holds its share of each bucket and writes
    it as a file of its own, without a second shuffle of all rows.
    """
    path = f"{version.root}/data/{_GENERATION}={generation}"
    dealt = rows.withColumn(_BUCKET, _bucket_of(version.keys, version.buckets))
    dealt = dealt if spread else dealt.hint("rebalance", F.col(_BUCKET))
    dealt.write.mode("overwrite").partitionBy(_BUCKET).parquet(path)
    stored = spark.read.schema(f"{_DELETED} boolean, {_BUCKET} bigint").parquet(path)
    counts = stored.groupBy(_BUCKET).agg(F.count("*").alias("n")).collect()
    return [Part(r[_BUCKET], generation, r["n"], delta) for r in counts]


def _load(spark: SparkSession, version: Version, parts: Iterable[Part]) -> DataFrame:
    """The stored rows of some parts, with their generation and mark; reads the folders of these parts only."""
    stored = StructType([*version.schema.fields, StructField(_DELETED, BooleanType()), StructField(_GENERATION, LongType())])
    paths = [f"{version.root}/data/{_GENERATION}={p.generation}/{_BUCKET}={p.bucket}" for p in parts]
    if not paths:
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).option("basePath", f"{version.root}/data").parquet(*paths).drop(_BUCKET)


def _merged(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    newest = latest_per_key(rows, keys, [F.col(_GENERATION).desc()])
    return newest.filter(~F.coalesce(F.col(_DELETED), F.lit(False)))


def _unsettled(parts: Iterable[Part]) -> set[int]:
    return {p.bucket for p in parts if p.delta}


def read(spark: SparkSession, root: str, version: Version | None = None) -> DataFrame:
    """The rows of a version, the newest unless one is given.

    Buckets without deltas are scanned as they are; in the others the newest row of a key counts.
    """
    version = version or current(spark, root)
    if version is None:
        raise ValueError(f"no keyed table at {root}")
    open_ = _unsettled(version.parts)
    plain = _load(spark, version, [p for p in version.parts if p.bucket not in open_])
    if open_:
        plain = plain.unionByName(_merged(_load(spark, version, [p for p in version.parts if p.bucket in open_]), version.keys))
    return plain.select(*version.schema.names)


def read_near(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """The rows of the buckets in which the keys of ``rows`` lie; other buckets are not opened."""
    version = current(spark, root)
    if version is None:
        raise ValueError(f"no keyed table at {root}")
    near = {r[0] for r in rows.select(_bucket_of(version.keys, version.buckets)).distinct().collect()}
    return read(spark, root, version._replace(parts=tuple(p for p in version.parts if p.bucket in near)))


def _joined(schema: StructType, new: StructType) -> StructType:
    """All columns of both, nullable; a column that changes its type is an error."""
    known = {f.name: f.dataType for f in schema.fields}
    for f in new.fields:
        if known.setdefault(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name}: {f.dataType.simpleString()} does not fit {known[f.name].simpleString()}")
    return StructType([StructField(name, kind, True) for name, kind in known.items()])


def _with_delta(
    spark: SparkSession,
    root: str,
    rows: DataFrame | None,
    deletes: DataFrame | None,
    keys: Sequence[str],
    buckets: int,
    spread: bool = False,
) -> Version:
    """The next version, not committed: the batch as a delta behind what is there."""
    old = current(spark, root) or Version(root, 0, tuple(keys), buckets, StructType([]), ())
    if tuple(keys) != old.keys:
        raise ValueError(f"the table's keys are {list(old.keys)}")
    marked = []
    if deletes is not None:
        gone = deletes.select(*keys).distinct()
        if rows is not None:
            marks = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
            gone = gone.join(rows.select(*[F.col(k).alias(f"_new_{k}") for k in keys]), marks, "left_anti")
        marked.append(gone.withColumn(_DELETED, F.lit(True)))
    if rows is not None:
        marked.append(rows.withColumn(_DELETED, F.lit(False)))
        old = old._replace(schema=_joined(old.schema, rows.schema))
    batch = marked[0] if len(marked) == 1 else marked[0].unionByName(marked[1], allowMissingColumns=True)
    new = old._replace(number=old.number + 1)
    held = {p.bucket for p in old.parts}
    parts = _write(spark, new, batch, 2 * new.number, True, spread and deletes is None)
    # The first rows of a bucket need no merging, unless some of them are marks
    first = deletes is None
    parts = [p._replace(delta=not first or p.bucket in held) for p in parts]
    return new._replace(parts=tuple(sorted(old.parts + tuple(parts))))


def _settled(spark: SparkSession, version: Version, ratio: float) -> Version:
    """The version with every bucket rewritten whose deltas reach the ratio."""
    below = {b: 0 for b in _unsettled(version.parts)}
    above = dict(below)
    for p in version.parts:
        if p.bucket in below:
            (above if p.delta else below)[p.bucket] += p.rows
    due = {b for b in below if above[b] >= ratio * below[b]}
    if not due:
        return version
    rows = _merged(_load(spark, version, [p for p in version.parts if p.bucket in due]), version.keys)
    parts = _write(spark, version, rows.drop(_GENERATION), 2 * version.number + 1, False, True)
    return version._replace(parts=tuple(sorted([p for p in version.parts if p.bucket not in due] + parts)))


def apply(
    spark: SparkSession,
    root: str,
    rows: DataFrame | None,
    keys: Sequence[str],
    deletes: DataFrame | None = None,
    buckets: int = BUCKETS,
    ratio: float = REWRITE_RATIO,
    spread: bool = False,
) -> Version:
    """Upsert ``rows`` (one per key) and delete the keys of ``deletes``; creates the table where there is none.

    A key in both is upserted. What is written is the batch, and the buckets whose deltas have reached
    ``ratio`` times the rows below them: over many batches a constant factor of what they bring. A repeated
    batch leaves the same rows. NULL keys are equal to each other. New columns are added, NULL before.
    ``spread`` says that ``rows`` lie in tasks of even size, as a shuffle by their keys or a table of them leaves them;
    without deletes they are then not shuffled again.
    """
    if rows is None and deletes is None:
        raise ValueError("nothing to apply")
    return _commit(spark, _settled(spark, _with_delta(spark, root, rows, deletes, keys, buckets, spread), ratio))


def merge(
    spark: SparkSession, root: str, rows: DataFrame, keys: Sequence[str], deletes: DataFrame | None = None, buckets: int = BUCKETS
) -> Version:
    """:func:`apply`, with the buckets of the batch's keys rewritten at once, so that reads need no merging."""
    return apply(spark, root, rows, keys, deletes, buckets, ratio=0.0)


def expire(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete the files that none of the newest ``keep`` versions names; returns how many folders went."""
    manifests = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")
    numbers = sorted(r[0] for r in manifests.select("version").distinct().collect())
    if not numbers:
        return 0
    oldest = numbers[-keep:][0]
    used = {(r[0], r[1]) for r in manifests.filter((F.col("version") >= oldest) & F.col("bucket").isNotNull()).select("generation", "bucket").collect()}
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    number = lambda status: int(status.getPath().getName().rpartition("=")[2])
    folders = lambda at: [s for s in store.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName()]
    gone = [s.getPath() for s in folders(path(f"{root}/manifest")) if number(s) < oldest]
    for generation in folders(path(f"{root}/data")):
        # What belongs to a version that is being written has a higher number than any committed one
        if number(generation) <= 2 * numbers[-1] + 1:
            gone += [s.getPath() for s in folders(generation.getPath()) if (number(generation), number(s)) not in used]
    for folder in gone:
        store.delete(folder, True)
    return len(gone)
