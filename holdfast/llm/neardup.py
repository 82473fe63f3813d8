"""Near-duplicates by min-max hashing, confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import body, held, written
from holdfast.llm.graph import components, merged
from holdfast.llm.shingles import mix, shingle_sets, stream

SHINGLE_WORDS = 5
PERCENT = 75
PERMUTATIONS = 64
BAND_VALUES = 4
# While a turn of stars joins at least this share of the pairs it measured, another follows
STAR_GAIN = 0.05

_U = np.uint64


def min_max_signature(values: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """Minimum and maximum of the set under each permutation: 2 values per hash evaluation.

    A permutation is an odd multiplier and an addend modulo 2^64 over mixed hashes. Both
    extremes agree between two sets with the probability of their Jaccard similarity.
    """
    factor = (stream(31, permutations) | _U(1))[:, None]
    addend = stream(37, permutations)[:, None]
    with np.errstate(over="ignore"):
        least, most = None, None
        for at in range(0, len(values), 4096):
            permuted = values[None, at : at + 4096] * factor + addend
            low, high = permuted.min(axis=1), permuted.max(axis=1)
            least = low if least is None else np.minimum(least, low)
            most = high if most is None else np.maximum(most, high)
    return np.concatenate([least, most])


def band_keys(signature: np.ndarray, size: int = BAND_VALUES) -> np.ndarray:
    """One hash per band of the signature; a band's number is part of its hash."""
    banded = signature.reshape(-1, size)
    with np.errstate(over="ignore"):
        key = mix(np.arange(1, len(banded) + 1, dtype=_U))
        for j in range(size):
            key = mix(key * _U(0x9E3779B97F4A7C15) + banded[:, j])
    return key.view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, first, second, bands = [], [], [], []
        for values in shingle_sets(batch.column(2), SHINGLE_WORDS):
            sizes.append(len(values))
            with np.errstate(over="ignore"):
                first.append(int(mix(values ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U).view(np.int64)))
                second.append(int(mix(values + _U(0x14057B7EF767814F)).sum(dtype=_U).view(np.int64)))
            bands.append(band_keys(min_max_signature(values)) if len(values) else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                pa.array(first, pa.int64()), pa.array(second, pa.int64()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            names=["row_id", "doc_id", "n_shingles", "set_a", "set_b", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [v.view(np.int64) for v in shingle_sets(batch.column(1), SHINGLE_WORDS)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"]
        )


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes of both whole sets and of what they share."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size(F.array_intersect("left", "right")).cast("bigint").alias("shared"),
        F.size("left").cast("bigint").alias("na"), F.size("right").cast("bigint").alias("nb"),
    )


def _similar(shared: Column, na: Column, nb: Column) -> Column:
    return shared * 100 >= (na + nb - shared) * PERCENT


def _stars(buckets: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The comparisons with the first leads, and the labels that all links found give.

    The lead of a bucket is its most central member, the one with the largest buckets: in a
    group of copies that is the copy with the fewest changes. Everyone in the bucket is compared
    with the lead; members outside the lead's component form a bucket with a lead of its own,
    again while a turn joins a good part of those it asked about.
    """
    first, labels = None, None
    opened = buckets
    while True:
        lead = F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("lead")
        leads = opened.groupBy("key").agg(lead, F.count("*").alias("rows")).filter("rows > 1").select(
            "key", (-F.col("lead.minus")).alias("b")
        )
        led = written(opened.join(leads, "key"), "neardup-led")
        pairs = led.filter("node <> b").select(F.col("node").alias("a"), "b").distinct()
        star = written(_measured(pairs, sets), "neardup-star")
        linked = star.filter(_similar(F.col("shared"), F.col("na"), F.col("nb"))).select("a", "b")
        first = star if first is None else first
        labels = components(linked) if labels is None else merged(labels, linked)
        counts = star.agg(
            F.count("*").alias("asked"),
            F.count_if(_similar(F.col("shared"), F.col("na"), F.col("nb"))).alias("joined"),
        ).first()
        if counts["joined"] < STAR_GAIN * counts["asked"] or not counts["asked"]:
            return first, labels
        of_node = labels.select("node", F.col("component").alias("own"))
        of_lead = labels.select(F.col("node").alias("b"), F.col("component").alias("theirs"))
        opened = written(
            led.join(of_node, "node", "left").join(of_lead, "b", "left")
            .filter(
                (F.col("node") != F.col("b"))
                & (F.coalesce("own", "node") != F.coalesce("theirs", "b"))
            )
            .select("key", "node", "weight"),
            "neardup-open",
        )


def _left_over(first: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that may still join two components, of all that share a bucket.

    Both members x, y were measured against their bucket's lead R. What they share within R is at
    most the smaller of their parts of R, so for a link they need a certain number of common
    shingles that R lacks. x and y need comparing only if their parts of R alone would suffice,
    or if they meet in the prefixes that this number leaves of their shingles outside R. All
    other pairs are excluded for certain without being formed.
    """
    own = labels.select(F.col("node").alias("a"), F.col("component").alias("_own"))
    lead = labels.select(F.col("node").alias("b"), F.col("component").alias("_lead"))
    members = (
        first.join(own, "a", "left").join(lead, "b", "left")
        .withColumn("component", F.coalesce("_own", "a"))
        .withColumn("outside", F.col("component") != F.coalesce("_lead", "b"))
    )
    families = (
        members.groupBy("b")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.bool_or("outside").alias("open"),
             F.min("na").alias("least"))
        .filter(F.col("open") & (F.col("low") != F.col("high")))
        .select("b", "least")
    )
    members = written(
        members.join(families, "b").select(
            "b", F.col("a").alias("node"), F.col("na").alias("n"), "shared", "component", "outside", "least"
        ),
        "neardup-members",
    )

    def both(rows: DataFrame, keys: list) -> tuple[DataFrame, DataFrame]:
        x = rows.filter("outside").select(*keys, F.col("node").alias("x"), F.col("n").alias("nx"), F.col("shared").alias("sx"), F.col("component").alias("cx"))
        y = rows.select(*keys, F.col("node").alias("y"), F.col("n").alias("ny"), F.col("shared").alias("sy"), F.col("component").alias("cy"), F.col("outside").alias("oy"))
        return x, y

    # A pair of two outside members is formed once
    once = (F.col("cx") != F.col("cy")) & (~F.col("oy") | (F.col("x") < F.col("y")))
    within = F.least("sx", "sy")
    enough = members.filter(_similar(F.col("shared"), F.col("n"), F.col("least")))
    x, y = both(enough, ["b"])
    by_lead = x.join(y, "b").filter(once & _similar(within, F.col("nx"), F.col("ny"))).select("x", "y")
    inner = sets.select("node", F.col("shingles").alias("own_set"))
    outer = sets.select(F.col("node").alias("b"), F.col("shingles").alias("lead_set"))
    private = members.join(inner, "node").join(outer, "b").select(
        "b", "node", "n", "shared", "component", "outside", "least",
        F.explode(F.array_except("own_set", "lead_set")).alias("shingle"),
    )
    private = written(private, "neardup-private")
    # A link needs so many shingles outside the lead in common: of any of them, in an order that both
    # share, one is among the first ones. The rare come first, and one that nobody shares joins nobody
    common = private.groupBy("b", "shingle").agg(F.count("*").alias("f")).filter("f > 1")
    place = Window.partitionBy("b", "node").orderBy(F.col("f").desc(), "shingle")
    other = F.greatest(F.ceil(F.col("n") * PERCENT / 100), F.col("least"))
    needed = F.greatest(F.ceil((F.col("n") + other) * PERCENT / (100 + PERCENT)) - F.col("shared"), F.lit(1))
    prefix = (
        private.join(common, ["b", "shingle"]).withColumn("from_last", F.row_number().over(place))
        .filter(F.col("from_last") >= needed)
    )
    # Where two meet first, what is left of the shorter rest bounds all that they share outside
    place_of = lambda n: F.col("from_last").alias(n)
    x, y = both(prefix, ["b", "shingle", place_of("rx")])[0], both(prefix, ["b", "shingle", place_of("ry")])[1]
    by_rest = (
        x.join(y, ["b", "shingle"])
        .filter(once & _similar(within + F.least("rx", "ry"), F.col("nx"), F.col("ny")))
        .select("x", "y")
    )
    return by_lead.unionByName(by_rest).select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
    ).distinct()


def _links(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; no pair that shares a band is lost."""
    keys = nodes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1")
    common = written(keys.join(shared, "key"), "neardup-buckets")
    weights = common.groupBy("node").agg(F.sum("rows").alias("weight"))
    buckets = written(common.select("key", "node").join(weights, "node"), "neardup-weighted")
    texts = rows.select(F.col("row_id").alias("node"), "text").join(weights.select("node"), "node", "left_semi")
    sets = written(texts.mapInArrow(_sets, "node bigint, shingles array<bigint>"), "neardup-sets")
    first, labels = _stars(buckets, sets)
    measured = _measured(_left_over(first, labels, sets), sets)
    found = written(
        measured.filter(_similar(F.col("shared"), F.col("na"), F.col("nb"))).select("a", "b"), "neardup-edges"
    )
    return labels if found.isEmpty() else merged(labels, found)


def near_duplicates(rows: DataFrame) -> DataFrame:
    """Per row: row_id, doc_id, n_shingles, component_id, kept, stays.

    ``rows`` (row_id, doc_id, text) are read several times. Rows with equal sets are one node,
    so copies cost no comparison. ``component_id`` is the smallest doc_id reachable (null only
    if all are null), ``kept`` tells whether it is the row's own, and ``stays`` marks exactly one
    row of each group, also when a doc_id repeats. A null, empty or blank text has no shingles,
    is linked with nothing and stays. An empty table gives no rows.
    """
    signed = written(
        rows.select("row_id", "doc_id", "text").mapInArrow(
            _signatures,
            f"row_id bigint, doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
            "n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>",
        ),
        "neardup-signatures",
    )
    same = ["n_shingles", "set_a", "set_b"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id"))
    nodes = written(
        signed.filter("n_shingles > 0").groupBy(*same).agg(
            F.min("row_id").alias("node"), first.alias("first"), F.any_value("bands").alias("bands")
        ),
        "neardup-nodes",
    )
    placed = nodes.select(*same, "node", "first").join(
        _links(nodes.select("node", "n_shingles", "bands"), rows), "node", "left"
    ).withColumn("component", F.coalesce("component", "node"))
    heads = placed.groupBy("component").agg(F.min("first").alias("head"))
    group = placed.join(heads, "component").select(*same, "head")
    empty = F.col("n_shingles") == 0
    return signed.drop("bands").join(group, same, "left").select(
        "row_id", "doc_id", "n_shingles",
        F.when(empty, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        (empty | F.col("doc_id").eqNullSafe(F.col("head.doc_id"))).alias("kept"),
        (empty | (F.col("row_id") == F.col("head.row_id"))).alias("stays"),
    )


def deduplicated(documents: DataFrame) -> DataFrame:
    """One document of each group of near-duplicates, with the columns it came with."""
    kept = held(documents, "neardup-documents")
    stays = near_duplicates(body(kept)).filter("stays").select("row_id")
    return kept.join(stays, "row_id", "left_semi").select("doc.*")
