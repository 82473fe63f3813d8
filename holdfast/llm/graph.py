"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable. ``edges`` (a, b), read many times.

    Each round a node takes the smallest label among its neighbours and itself, then the
    label of that label, so a chain halves with each round. Labels are the least of a
    pre-aggregated group, so a node with very many edges is no large group. Each round is
    written to the shared folder.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = written(
        both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("component")
        ),
        "components",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy("a").agg(F.min("component").alias("near"))
        )
        offered = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        jump = labels.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        moved = written(
            offered.join(jump, F.col("component") == F.col("_n"), "left").select(
                "node", "old", F.least("component", F.coalesce("_c", "component")).alias("component")
            ),
            "components",
        )
        labels = moved.select("node", "component")
        if moved.filter(F.col("old") != F.col("component")).isEmpty():
            return labels


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (node, component) after further edges: only components are joined anew.

    The edges are lifted to the components of their ends, so the rounds run over as many
    edges as are new, whatever has been joined before.
    """
    own = lambda n: labels.select(F.col("node").alias(n), F.col("component").alias(f"_{n}"))
    placed = written(
        edges.join(own("a"), "a", "left").join(own("b"), "b", "left").select(
            "a", "b", F.coalesce("_a", "a").alias("ca"), F.coalesce("_b", "b").alias("cb")
        ),
        "components",
    )
    lifted = components(placed.filter("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    ends = placed.select(F.explode(F.array(F.struct("a", "ca"), F.struct(F.col("b").alias("a"), F.col("cb").alias("ca")))).alias("e"))
    new = ends.filter("e.a = e.ca").select(F.col("e.a").alias("node"), F.col("e.ca").alias("component")).distinct()
    known = labels.unionByName(new.join(labels.select("node"), "node", "left_anti"))
    moved = lifted.withColumnRenamed("node", "_from").withColumnRenamed("component", "_to")
    return written(
        known.join(moved, F.col("component") == F.col("_from"), "left").select(
            "node", F.coalesce("_to", "component").alias("component")
        ),
        "components",
    )
