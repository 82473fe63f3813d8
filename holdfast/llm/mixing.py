"""Mix sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import held, numbered, words, written

# Weights of the sources in code point order, repeating; share of all words
# that the mix takes; times a document may be taken
WEIGHTS = (3, 1, 2)
BUDGET_PERCENT = 150
EPOCHS = 2
# Rows that one window task orders, about
ROWS_PER_BUCKET = 2000
# Rows of one range of a source's order, about
ROWS_PER_RANGE = 50_000


def source_targets(
    sized: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    epochs: int = EPOCHS,
) -> DataFrame:
    """Words to take per source: (source, source_no, source_size, target).

    Sources in code point order, null last, get the weights in turn. They share the budget by
    weight; a target stops at ``epochs`` times its source's size and the excess is shared
    again. Ordered by the level at which each is full, the sources that stop are a prefix,
    so one running sum finds them. The windows run over one row per source.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(
        F.array(*[F.lit(w).cast("bigint") for w in weights]), (place - 1) % len(weights) + 1
    )
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    leveled = (
        per_source.withColumn("source_no", place)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * epochs)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("budget", F.col("total") * budget_percent / F.lit(100.0))
        .withColumn("stopped", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(rest))
        .withColumn(
            "full",
            F.col("cap") * F.col("open_weight")
            <= F.col("weight") * (F.col("budget") - F.col("stopped")),
        )
    )
    share = (
        F.col("weight")
        * (F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0)))
        / F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    )
    return leveled.select(
        "source", "source_no", "source_size",
        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def _virtual_finish(sized: DataFrame, rows: int, epochs: int) -> DataFrame:
    """One row per document and epoch with its virtual finish time.

    The order of a source is a hash of document and epoch, then what tells rows of one id apart. Its
    running sum is taken in two steps: sums of ranges of that order, then inside each range, so that a
    source with a third of all documents, or an id, or rows without one, are spread over many ranges.
    """
    copies = sized.filter("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "epoch"))
    order = ["draw", "doc_id", "size", "row_id"]
    ranges = max(16, -(-rows * epochs // ROWS_PER_RANGE))
    dealt = written(
        copies.withColumn("draw", key).repartitionByRange(ranges, "source_no", "epoch", *order)
        .withColumn("bucket", F.spark_partition_id()),
        "mix-order",
    )
    lane = ["source_no", "epoch"]
    sums = dealt.groupBy(*lane, "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy(*lane).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *lane, "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy(*lane, "bucket").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    through = F.col("epoch") * F.col("source_size") + F.col("offset") + F.col("inside")
    return (
        dealt.withColumn("inside", F.sum("size").over(inside))
        .join(offsets, [*lane, "bucket"])
        .withColumn("finish", through / F.col("target"))
        .select("row_id", "doc_id", "size", "source_no", "epoch", "draw", "finish")
    )


def _order() -> Column:
    """The global order of the mix, ties included."""
    return F.struct("finish", "source_no", "draw", "size", "row_id")


def schedule(
    sized: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    epochs: int = EPOCHS,
) -> tuple[DataFrame, DataFrame]:
    """The rows with their targets, and the copies taken: (row_id, size, finish).

    ``sized`` (row_id, doc_id, source, size) is a written table. All copies, ordered by
    virtual finish time, are taken while their running sum stays within the budget: ranges of
    the finish time are summed, and only the range in which the budget ends is ordered
    row by row. What reaches the driver is that one range's number and the last copy.
    """
    rows = sized.count()
    buckets = max(64, -(-rows // ROWS_PER_BUCKET))
    targets = source_targets(sized, weights, budget_percent, epochs)
    planned = sized.join(
        targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source")
    copies = written(_virtual_finish(planned, rows, epochs), "mix-finish").withColumn(
        "range", F.least(F.floor(F.col("finish") * buckets), F.lit(2 * buckets))
    )
    total = sized.agg(F.sum("size")).first()[0] or 0
    allowed = total * budget_percent // 100
    through = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        copies.groupBy("range").agg(F.sum("size").alias("n"))
        .withColumn("through", F.sum("n").over(through))
        .filter(F.col("through") > allowed)
        .orderBy("range")
        .first()
    )
    if cut is None:
        return planned, copies.select("row_id", "size", "finish")
    in_order = Window.partitionBy("range").orderBy(_order()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    last = (
        copies.filter(F.col("range") == cut["range"])
        .withColumn("through", F.sum("size").over(in_order) + (cut["through"] - cut["n"]))
        .filter(F.col("through") <= allowed)
        .agg(F.max(_order()).alias("last"))
        .first()["last"]
    )
    taken = F.col("range") < cut["range"]
    if last is not None:
        taken = taken | (
            (F.col("range") == cut["range"])
            & (
                _order()
                <= F.struct(
                    F.lit(last["finish"]).alias("finish"),
                    F.lit(last["source_no"]).alias("source_no"),
                    F.lit(last["draw"]).alias("draw"),
                    F.lit(last["size"]).cast("bigint").alias("size"),
                    F.lit(last["row_id"]).cast("bigint").alias("row_id"),
                )
            )
        )
    return planned, copies.filter(taken).select("row_id", "size", "finish")


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def mix_plan(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words, repeats counted).

    A null text has size 0 and is never taken. A null source is a source, the last one. A
    null doc_id is drawn like any other. Repeated rows and ties in the draw are told apart by
    size and by a row number, so each row is decided once. An empty table gives no rows.
    Only doc_id, source and text are read.
    """
    sized = written(
        numbered(documents.select("doc_id", "source", size_of(F.col("text")).alias("size"))),
        "mix-sizes",
    )
    planned, copies = schedule(sized)
    taken = copies.groupBy("row_id").agg(F.sum("size").alias("taken"))
    return planned.join(taken, "row_id", "left").select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
    )


def mix(documents: DataFrame) -> DataFrame:
    """The mixed documents themselves, in the order of their virtual finish times.

    Columns as in ``documents``; a document taken twice occurs twice, one not taken is gone.
    The cases of :func:`mix_plan` hold. The plan is worked out from the sizes alone and joined
    back by row number.
    """
    kept = held(documents, "mix-documents")
    sized = written(
        kept.select("row_id", "doc.doc_id", "doc.source", size_of(F.col("doc.text")).alias("size")), "mix-sizes"
    )
    _, copies = schedule(sized)
    return kept.join(copies.select("row_id", "finish"), "row_id").orderBy("finish", "row_id").select("doc.*")
