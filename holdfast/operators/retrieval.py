"""Approved document chunks, similarity top-k and prompt context."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.exact import ratio, rounded
from holdfast.functions.text import strip
from holdfast.operators.keys import latest_per_key

# Scores are ranked after rounding, so equal texts tie and the id decides
SCORE_DIGITS = 9
# Question vectors that a task holds
QUESTION_BLOCK = 4096
# Bytes of scores that a task holds at once, and of the chunk vectors that it meets them with
SCORE_BYTES = 32 << 20
SHARD_BYTES = 64 << 20


def approved_documents(documents: DataFrame, register: DataFrame) -> DataFrame:
    """Two gates before any text is split: on the register as approved, and not restricted."""
    approved = register.filter("approved").select("doc_id")
    restricted = register.filter("restricted").select("doc_id")
    return documents.join(approved, "doc_id", "left_semi").join(restricted, "doc_id", "left_anti")


def chunk_documents(documents: DataFrame) -> DataFrame:
    """One chunk per non-empty line, numbered per document after empty lines are dropped."""
    lines = F.transform(F.split("text", "\n"), strip)
    kept = F.filter(lines, lambda line: line != "")
    return documents.select("doc_name", F.posexplode(kept).alias("line_no", "chunk_text")).select(
        F.concat_ws("#", "doc_name", "line_no").alias("chunk_id"), "doc_name", "chunk_text"
    )


def revoke(chunks: DataFrame, revoked: DataFrame) -> DataFrame:
    """Chunks without those of revoked documents."""
    return chunks.join(revoked.select("doc_name"), "doc_name", "left_anti")


def chunk_coverage(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("doc_name").agg(F.count("*").alias("chunks"))


def chunk_leaks(chunks: DataFrame, documents: DataFrame, register: DataFrame) -> DataFrame:
    """Documents in the index that must not be, and approved ones that are missing."""
    named = documents.select("doc_name", "doc_id").join(register, "doc_id", "left")
    indexed = chunks.groupBy("doc_name").agg(F.count("*").alias("chunks"))
    allowed = F.coalesce(F.col("approved") & ~F.col("restricted"), F.lit(False))
    present = F.col("chunks").isNotNull()
    return (
        named.join(indexed, "doc_name", "full_outer")
        .withColumn(
            "finding",
            F.when(present & F.coalesce("restricted", F.lit(False)), "restricted_indexed")
            .when(present & ~allowed, "not_approved_indexed")
            .when(~present & allowed, "approved_missing"),
        )
        .filter(F.col("finding").isNotNull())
        .select("doc_name", "finding")
    )


def _vectors(array: pa.ListArray) -> np.ndarray:
    flat = array.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(array), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _pair_scorer(k: int):
    """Arrow task of one block of questions and one shard of chunks: the best ``k`` chunks of each question."""

    def score(questions: pa.Table, chunks: pa.Table) -> pa.Table:
        asked, ids = questions["question_id"].to_numpy(), chunks["chunk_id"].to_numpy()
        if not len(asked) or not len(ids):
            return pa.table({"question_id": pa.array([], pa.int64()), "chunk_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        matrix = _unit(_vectors(questions["embedding"].combine_chunks()))
        vectors = _vectors(chunks["embedding"].combine_chunks())
        rows = max(1, SCORE_BYTES // (8 * len(asked)))
        # The scores that a chunk has to reach by now, and what did so far, by question
        reach = np.full(len(asked), -np.inf)
        q, c, best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for at in range(0, len(ids), rows):
            scores = np.round(matrix @ _unit(vectors[at : at + rows]).T, SCORE_DIGITS)
            if scores.shape[1] > k:
                reach = np.maximum(reach, np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k])
            new_q, new_c = np.nonzero(scores >= reach[:, None])
            q, best = np.concatenate([q, new_q]), np.concatenate([best, scores[new_q, new_c]])
            c = np.concatenate([c, ids[at + new_c]])
            order = np.lexsort((c, -best, q))
            q, c, best = q[order], c[order], best[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            kept = place < k
            q, c, best, place = q[kept], c[kept], best[kept], place[kept]
            full = place == k - 1
            reach[q[full]] = best[full]
        return pa.table({"question_id": pa.array(asked[q]), "chunk_id": pa.array(c), "score": pa.array(best)})

    return score


def _usable() -> Column:
    """A vector with a direction: not NULL, no NULL inside, not all zero."""
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    return F.coalesce(norm > 0, F.lit(False))


def rejected_vectors(chunks: DataFrame) -> DataFrame:
    """Chunks that no search can return, counted per reason."""
    reason = F.when(F.col("embedding").isNull(), "null_vector").otherwise("no_direction")
    return chunks.filter(~_usable()).groupBy(reason.alias("reason")).agg(F.count("*").alias("chunks"))


def vector_topk(
    questions: DataFrame, chunks: DataFrame, k: int = 3, block: int = QUESTION_BLOCK, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """The ``k`` chunks most similar (cosine) to each question vector; exact, also with ties (smaller id).

    Both sides stay tables. Questions are dealt to blocks and chunks to shards by hash, every block meets every
    shard of its width in one task by a cogroup, and a task hands on its best ``k`` per question: the shuffle
    carries each side once for every block or shard of the other, never pairs of rows. A task holds one block, one shard and
    ``SCORE_BYTES`` of scores; nothing but the number of rows by width reaches the driver, and the plan is
    the same for any number of questions. See ``rejected_vectors`` for vectors that no search can return.
    """
    width = F.size("embedding")
    usable = chunks.filter(_usable()).select(F.col("chunk_id").cast("bigint"), "embedding", width.alias("width"))
    asked = questions.filter(_usable()).select(F.col("question_id").cast("bigint"), "embedding", width.alias("width"))
    sizes = (
        asked.groupBy("width").agg(F.count("*").alias("q"))
        .join(usable.groupBy("width").agg(F.count("*").alias("c")), "width").collect()
    )
    blocks = {r["width"]: max(1, -(-r["q"] // block)) for r in sizes}
    shards = {r["width"]: max(1, -(-r["c"] * 8 * r["width"] // shard_bytes)) for r in sizes}
    of = lambda parts: F.create_map(*[F.lit(x) for pair in (parts or {-1: 1}).items() for x in pair])[F.col("width")]
    deal = lambda column, parts: F.pmod(F.xxhash64(column), of(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), (of(parts) - 1).cast("int")))
    some = F.col("width").isin(*blocks) if blocks else F.lit(False)
    left = asked.filter(some).withColumn("block", deal("question_id", blocks)).withColumn("shard", every(shards))
    right = usable.filter(some).withColumn("shard", deal("chunk_id", shards)).withColumn("block", every(blocks))
    pair = ["width", "block", "shard"]
    scored = (
        left.groupBy(*pair).cogroup(right.groupBy(*pair))
        .applyInArrow(_pair_scorer(k), "question_id bigint, chunk_id bigint, score double")
    )
    return latest_per_key(
        scored, ["question_id"], [F.col("score").desc(), F.col("chunk_id")], k, rank="rank"
    )


def score_floor(top: DataFrame, labelled: DataFrame) -> DataFrame:
    """(floor): the best score of any passage found for a question that must find nothing; one row.

    ``labelled`` (question_id, expected) says whether the index holds an answer. A passage counts
    when it scores more than the floor; without expected misses that is NULL and every passage counts.
    """
    best = top.filter("rank = 1").select("question_id", "score")
    return labelled.filter("NOT expected").join(best, "question_id").agg(F.max("score").alias("floor"))


def above_floor(top: DataFrame, floor: Column) -> DataFrame:
    """Passages that score more than the floor; a question without any can cite none."""
    return top.filter(F.coalesce(F.col("score") > floor, floor.isNull()))


def golden_rates(top: DataFrame, labelled: DataFrame, floor: Column) -> DataFrame:
    """Per ``expected``: questions, how many found a passage above the floor, and the rates of both mistakes.

    An expected answer that is not found is a miss, an expected miss that finds a passage a false hit.
    """
    best = above_floor(top, floor).filter("rank = 1").select("question_id", "score")
    found = F.col("score").isNotNull()
    share = lambda wrong: F.coalesce(rounded(ratio(F.count_if(wrong), F.count("*")), 4), F.lit(0.0))
    return labelled.join(best, "question_id", "left").groupBy("expected").agg(
        F.count("*").alias("questions"),
        F.count_if(found).alias("found"),
        share(F.col("expected") & ~found).alias("miss_rate"),
        share(~F.col("expected") & found).alias("false_hit_rate"),
    )


def hit_at_k(top: DataFrame, questions: DataFrame, chunks: DataFrame) -> DataFrame:
    """Per question: how many of its top chunks have the expected topic."""
    found = top.join(chunks.select("chunk_id", "topic"), "chunk_id")
    hit = F.col("topic") == F.col("question_id")
    return (
        questions.select("question_id")
        .join(found, "question_id", "left")
        .groupBy("question_id")
        .agg(
            F.count("chunk_id").alias("retrieved"),
            F.count_if(hit).alias("hits"),
            F.coalesce(rounded(ratio(F.count_if(hit), F.count("chunk_id")), 4), F.lit(0.0))
            .alias("hit_rate"),
        )
    )


def prompt_context(
    questions: DataFrame, passages: DataFrame, breaches: DataFrame, instruction: str
) -> DataFrame:
    """One prompt per question: instruction, breach rows, ranked passages, the question.

    ``questions`` (question_id, question, portfolio_id); ``passages`` (question_id, rank, line_no,
    doc_name, chunk_text), the chunks of k documents per question; ``breaches`` of the day (portfolio_id, limit_id,
    line), as many as the portfolio has limits.
    """
    line = F.concat(F.lit("["), "doc_name", F.lit("] "), "chunk_text")
    cited = passages.groupBy("question_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "line_no", line.alias("line")))).alias("p")
    )
    listed = breaches.groupBy("portfolio_id").agg(
        F.sort_array(F.collect_list(F.struct("limit_id", "line"))).alias("b")
    )
    empty = F.lit("")
    prompt = F.concat(
        F.lit(f"{instruction}\n\nBREACH DATA:\n"),
        F.coalesce(F.array_join(F.col("b.line"), "\n"), empty),
        F.lit("\n\nPOLICY PASSAGES:\n"),
        F.coalesce(F.array_join(F.col("p.line"), "\n"), empty),
        F.lit("\n\nQUESTION: "),
        F.col("question"),
    )
    return (
        questions.join(cited, "question_id", "left")
        .join(listed, "portfolio_id", "left")
        .select("question_id", "portfolio_id", prompt.alias("prompt"))
    )
