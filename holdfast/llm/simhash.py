"""Near-duplicates by SimHash: one-wildcard variants of the fingerprint's halves, joined by equality."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from holdfast.llm.common import written
from holdfast.llm.graph import components, merged

# Words of a shingle, seed of its hash, bits in which linked fingerprints may differ
WIDTH = 3
SEED = 42
DISTANCE = 3
# Shingles that are counted at once
BLOCK = 1 << 16


def fingerprint(text: str | None, width: int = WIDTH, seed: int = SEED) -> int:
    """A bit is one where it is one in over half of the shingles' hashes; zero without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(width, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        hashed = [xxhash.xxh64_intdigest(flat[s:e], seed) for s, e in zip(starts[at : at + BLOCK], ends[at : at + BLOCK])]
        bits = np.unpackbits(np.array(hashed, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, print): the 64 bits of each text's fingerprint as a bigint."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "print"])

    schema = StructType(documents.select("doc_id").schema.fields).add("print", "long")
    return documents.select("doc_id", F.col("text").cast(StringType())).mapInArrow(of, schema)


def apart(a: str, b: str) -> Column:
    """In how many bits two fingerprints differ."""
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _opened(rows: DataFrame, part: str, bits: int, first: str) -> DataFrame:
    """Each row at 2 * ``bits`` spots: per half of ``part`` the value without one of its bits, which is the side.

    ``part`` has 2 * ``bits`` bits. Two values that differ by at most one bit in a half share a spot. The
    spot is packed behind ``first``, a number that the rows of one spot have in common; ``half`` says which half.
    """
    half = f"(shiftrightunsigned({part}, CAST({bits} * (_i DIV {bits}) AS INT)) & {(1 << bits) - 1}L)"
    low = f"({half} & (shiftleft(1L, _i % {bits}) - 1))"
    high = f"shiftleft(shiftright({half}, _i % {bits} + 1), _i % {bits})"
    packed = f"shiftleft(shiftleft({first}, {(2 * bits - 1).bit_length()}) | _i, {bits - 1}) | {high} | {low}"
    numbered = rows.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(2 * bits - 1))))
    return numbered.withColumns(
        {"spot": F.expr(packed), "_half": F.expr(f"_i DIV {bits}"), "_bit": F.expr(f"shiftright({half}, _i % {bits}) & 1")}
    ).drop("_i")


def _met(rows: DataFrame, others: DataFrame, by: str | list[str], how: str = "inner") -> DataFrame:
    """Rows at spots joined by shuffles, whatever size Spark takes them for.

    It sizes an exploded table like the one before, up to 64 times too low, and would broadcast all of its
    rows from the driver.
    """
    return rows.join(others.hint("merge"), by, how)


def halves(nodes: DataFrame) -> DataFrame:
    """Fingerprints at two spots: each half as it is."""
    spot = "shiftleft(CAST(half AS BIGINT), 32) | (shiftrightunsigned(print, CAST(32 * half AS INT)) & 4294967295L)"
    return nodes.withColumn("half", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("spot", F.expr(spot))


def variants(nodes: DataFrame) -> DataFrame:
    """Fingerprints at 64 spots of 37 bits, a half without one bit each, with that bit as their side."""
    return _opened(nodes, "print", 32, "0L").withColumnsRenamed({"_half": "half", "_bit": "side"})


def _finer(rows: DataFrame) -> DataFrame:
    """Rows dealt to finer spots by each piece of the half that their spot leaves open.

    Links within a spot differ in three bits of that half at most, so one of its four pieces is equal. Between the
    sides of a variant, which differ in the bit that it leaves out, it is two bits, and three pieces do.
    """
    pieces = 3 if "side" in rows.columns else 4
    size = -(-32 // pieces)
    piece = f"shiftrightunsigned(shiftrightunsigned(print, IF(half = 0, 32, 0)) & 4294967295L, CAST({size} * _i AS INT)) & {(1 << size) - 1}L"
    numbered = rows.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    return numbered.withColumn("finer", F.expr(f"shiftleft(spot, 13) | shiftleft(_i, 11) | ({piece})")).drop("_i")


def _starred(rows: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) of each spot's members with the one that has the most documents.

    The lead is found by an aggregation and joined back, so a spot that holds a third of all rows is split by Spark
    and none is gathered in one task. Where rows have a side, they are compared with the other side's lead.
    """
    sides = ["side"] if "side" in rows.columns else []
    leads = rows.groupBy("spot", *sides).agg(F.max_by("print", "n").alias("lead"))
    if sides:
        leads = leads.withColumn("side", 1 - F.col("side"))
    linked = _met(rows, leads, ["spot", *sides]).filter((F.col("print") != F.col("lead")) & (apart("print", "lead") <= distance))
    return linked.select(F.least("print", "lead").alias("a"), F.greatest("print", "lead").alias("b")).distinct()


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    own = labels.select(F.col("node").alias("print"), F.col("component").alias("_label"))
    return rows.drop("label").join(own, "print", "left").withColumn("label", F.coalesce("_label", "print")).drop("_label")


def _torn(rows: DataFrame) -> DataFrame:
    """Rows of the spots whose members are of several components yet; with sides, those that meet another one there."""
    if "side" not in rows.columns:
        spans = rows.groupBy("spot").agg(F.min("label").alias("_least"), F.max("label").alias("_most"))
        return _met(rows, spans.filter("_least < _most").select("spot"), "spot", "left_semi")
    ends = [
        f(F.when(F.col("side") == side, F.col("label"))).alias(f"_{name}{side}")
        for side in (0, 1) for name, f in (("least", F.min), ("most", F.max))
    ]
    apart_ = "_least0 IS NOT NULL AND _least1 IS NOT NULL AND NOT (_least0 = _most0 AND _most0 = _least1 AND _least1 = _most1)"
    spans = rows.groupBy("spot").agg(*ends).filter(apart_)
    meets = F.expr("IF(side = 0, _least1 <> label OR _most1 <> label, _least0 <> label OR _most0 <> label)")
    return _met(rows, spans, "spot").filter(meets).select(*rows.columns)


def _outside(rows: DataFrame) -> DataFrame:
    """The rows that are not of the component with most rows of their spot: one end of every link that is missing."""
    counted = rows.groupBy("spot", "label").agg(F.count("*").alias("_rows"))
    main = counted.groupBy("spot").agg(F.max_by("label", "_rows").alias("_main"))
    return _met(rows, main, "spot").filter("label <> _main").drop("_main")


def _crossing(rows: DataFrame, distance: int, leads: bool) -> DataFrame:
    """Links (a, b) between members of one spot and of different components.

    Rows outside a spot's main component are looked up at the finer spots, among all rows or their leads.
    """
    sides = ["side"] if "side" in rows.columns else []
    kept = _finer(rows)
    if leads:
        kept = kept.groupBy("finer", *sides).agg(F.max_by(F.struct("print", "label"), "n").alias("k")).select("finer", *sides, "k.*")
    there = kept.select("finer", F.col("print").alias("b"), F.col("label").alias("_b"), *[F.col(c).alias("_side") for c in sides])
    asked = _finer(_outside(rows)).select("finer", F.col("print").alias("a"), F.col("label").alias("_a"), *sides)
    links = (F.col("_a") != F.col("_b")) & (apart("a", "b") <= distance)
    met = _met(asked, there, "finer").filter(links & (F.col("side") != F.col("_side")) if sides else links)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _joined(rows: DataFrame, labels: DataFrame, distance: int) -> DataFrame:
    """``labels`` with every link inside the spots of ``rows`` (spot, half, print, n, label): a written table.

    Members are compared with their spot's lead first, those outside the spot's main component then with
    the leads of finer spots, and those that are still outside with all members of the finer spots. Spots whose
    members are all of one component leave in between.
    """
    edges = _starred(rows, distance)
    for leads in (True, False):
        labels = merged(labels, written(edges, "simhash-edges"))
        rows = written(_torn(written(_labelled(rows, labels), "simhash-rows")), "simhash-torn")
        if rows.isEmpty():
            return labels
        edges = _crossing(rows, distance, leads)
    return merged(labels, written(edges, "simhash-edges"))


def linked_prints(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(node, component) of the fingerprints with a link; ``nodes`` (print, n) distinct, a written table.

    Of the two halves of linked fingerprints one differs by one bit at most. Those with an equal half are
    joined first. The variants without one bit then have to bring together fingerprints that differ in just that
    bit, and only those that are not of one component by then: a large group of near copies has mostly
    become one and its members meet nobody. No link is lost: what is left out joins what is joined already.
    """
    if distance > DISTANCE:
        raise ValueError(f"two halves with one open bit each find links of up to {DISTANCE} bits")
    none = nodes.select(F.col("print").alias("node"), F.col("print").alias("component")).filter("false")
    alike = halves(nodes)
    shared = alike.groupBy("spot").agg(F.count("*").alias("_members")).filter("_members > 1")
    rows = written(_met(alike, shared.select("spot"), "spot", "left_semi").withColumn("label", F.col("print")), "simhash-halves")
    labels = _joined(rows, none, distance)
    rows = written(_torn(variants(written(_labelled(nodes, labels), "simhash-nodes"))), "simhash-variants")
    return labels if rows.isEmpty() else _joined(rows, labels, distance)


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hexadecimal digits), component_id, n_links.

    Lower-cased words, runs of three words with repeats, hashed by XXH64; a shorter text is one run. Documents
    link where their fingerprints differ in at most three bits; component_id is the smallest doc_id reachable, and
    n_links how many other documents share the component.

    A null, empty or blank text has fingerprint zero and links like any other. A null doc_id takes part
    and never names a component unless all of its documents have none. Rows that repeat are documents each. An
    empty table gives no rows. Texts are read whole, a block of shingles at a time. Other columns are not read.
    """
    printed = written(fingerprints(documents), "simhash-prints")
    nodes = written(
        printed.groupBy("print").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")), "simhash-nodes"
    )
    labels = linked_prints(nodes.select("print", "n"))
    placed = nodes.join(labels.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "n", "least", F.coalesce("component", "print").alias("component")
    )
    named = placed.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("n").alias("_all"))
    of_print = written(placed.join(named, "component").select("print", "component_id", "_all"), "simhash-components")
    return printed.join(of_print, "print").select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
        (F.col("_all") - 1).alias("n_links"),
    )
