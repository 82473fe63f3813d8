"""Importance resampling towards a target text: hashed n-gram gains and a distributed quickselect."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from holdfast.llm.common import numbered, written
from holdfast.llm.shingles import text_chunks

# Fixed values
BUCKETS = 10_000
WIDEST = 3
SCALE = 1_000
SEED = 42
LEAST_WORDS = 20
PERCENT = 5
# Pivots of one round; rows that one task ranks
PIVOTS = 16
ROWS_PER_RANGE = 200_000
# Bytes of a word that are hashed side by side with all others; the rest of a longer one is hashed alone
_SIDE_BY_SIDE = 48

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_ONES = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    """The 256 steps of the reflected CRC-32 polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC_TABLE = _crc_table()
_AFTER_SPACE = np.uint32(32)


def _extended(state: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC states after one more word each."""
    state, sizes = state.copy(), ends - starts
    open_ = np.arange(len(state))
    for step in range(_SIDE_BY_SIDE):
        if not len(open_):
            return state
        now = state[open_]
        state[open_] = CRC_TABLE[(now ^ raw[starts[open_] + step]) & 255] ^ (now >> 8)
        open_ = open_[sizes[open_] > step + 1]
    for i in open_:
        rest = raw[starts[i] + _SIDE_BY_SIDE : ends[i]]
        state[i] = zlib.crc32(rest, int(state[i] ^ _ONES)) ^ 0xFFFFFFFF
    return state


def feature_buckets(
    raw: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Word offsets of the texts, and the bucket of the run of 1, 2, 3 words from each word on.

    A run that goes on into the next text has bucket -1.
    """
    low = _LOWER[raw]
    word = _IS_WORD[low]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(word & (edge[:-1] | ~np.r_[False, word[:-1]]))
    ends = np.flatnonzero(word & (edge[1:] | ~np.r_[word[1:], False])) + 1
    at = np.searchsorted(starts, offsets)
    last = np.repeat(at[1:], np.diff(at))
    state, found = np.full(len(starts), _ONES), []
    for width in range(1, WIDEST + 1):
        if width > 1:
            state = state[: max(0, len(starts) - width + 1)]
            state = CRC_TABLE[(state ^ _AFTER_SPACE) & 255] ^ (state >> 8)
        n = len(state)
        state = _extended(state, low, starts[width - 1 :], ends[width - 1 :])
        bucket = ((state ^ _ONES) % np.uint32(buckets)).astype(np.int64)
        bucket[np.arange(n) + width > last[:n]] = -1
        found.append(bucket)
    return at, found


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all ``text`` values fall in each bucket.

    A task adds up its texts in one array and hands on what is not zero, so a shuffle carries at
    most ``buckets`` rows per task, and so many numbers reach the driver whatever the corpus.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for raw, offsets in text_chunks(batch.column(0)):
                for found in feature_buckets(raw, offsets, buckets)[1]:
                    total += np.bincount(found[found >= 0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(count, "bucket bigint, n bigint")
    total = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Per bucket the floor of the scaled log ratio of the smoothed shares, in doubles."""
    n = len(source)
    s_all, t_all = float(int(source.sum()) + n), float(int(target.sum()) + n)
    return np.array(
        [math.floor(scale * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
         for s, t in zip(source.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def weighted(documents: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per row: the gains of its features, summed from an array."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weights = [], [], []
            for raw, offsets in text_chunks(batch.column(1)):
                at, found = feature_buckets(raw, offsets, len(gain))
                n = np.diff(at)
                weight = np.zeros(len(n), np.int64)
                for bucket in found:
                    upto = np.zeros(at[-1] + 1, np.int64)
                    np.cumsum(np.where(bucket >= 0, gain[bucket], 0), out=upto[1 : len(bucket) + 1])
                    upto[len(bucket) + 1 :] = upto[len(bucket)]
                    weight += upto[at[1:]] - upto[at[:-1]]
                words.append(n)
                features.append(sum(np.maximum(n - k, 0) for k in range(WIDEST)))
                weights.append(weight)
            columns = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in (words, features, weights)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_words", "n_features", "weight"])

    schema = StructType(documents.select("doc_id").schema.fields)
    for name in ("n_words", "n_features", "weight"):
        schema = schema.add(name, LongType())
    return documents.select("doc_id", "text").mapInArrow(weigh, schema)


def _noise(doc_id: Column, seed: int, scale: int) -> Column:
    """Gumbel noise that depends on seed and id alone, scaled and floored."""
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(label, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / float(1 << 32)))).cast("bigint")


def _fixed(row: Row, schema: StructType, key: Sequence[str]) -> Column:
    return F.struct(*[F.lit(row[c]).cast(schema[c].dataType).alias(c) for c in key])


def kth_key(rows: DataFrame, key: Sequence[str], k: int, pivots: int = PIVOTS) -> Row | None:
    """The k-th smallest key (from 1), by quickselect; None where there are fewer rows.

    ``key`` is unique. Each round draws random keys among those that are left and counts exactly
    what is less than, equal to and greater than each; only the part with the k-th key is kept, written
    anew, about a ``pivots``-th of the part before. The driver sees pivots and counts, no other rows.
    """
    rows = rows.select(*key)
    schema, of = rows.schema, F.struct(*key)
    rest, turn = k, 0
    while True:
        turn += 1
        drawn = rows.orderBy(F.xxhash64(*key, F.lit(turn)), *key).limit(pivots).orderBy(*key).collect()
        if not drawn:
            return None
        marks = [_fixed(p, schema, key) for p in drawn]
        counted = rows.agg(
            *[F.count_if(of < m).alias(f"less{i}") for i, m in enumerate(marks)],
            *[F.count_if(of == m).alias(f"equal{i}") for i, m in enumerate(marks)],
        ).first()
        low = high = None
        for i, mark in enumerate(marks):
            less, equal = counted[f"less{i}"], counted[f"equal{i}"]
            if less >= rest:
                high = mark
                break
            if rest <= less + equal:
                return drawn[i]
            low, below = mark, less + equal
        if low is not None:
            rows, rest = rows.filter(of > low), rest - below
        if high is not None:
            rows = rows.filter(of < high)
        rows = written(rows, "resample-part")


def _ranked(winners: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """``winners`` with their rank: sorted by ranges of the key, each range ranked in its own task."""
    parts = max(1, -(-n // ROWS_PER_RANGE))
    dealt = written(
        winners.repartitionByRange(parts, *key).withColumn("_range", F.spark_partition_id()), "resample-winners"
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*key)) + F.col("_offset")
    return dealt.join(offsets, "_range").withColumn("rank", place.cast("bigint")).drop("_range", "_offset")


def resampled(
    documents: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight, score, rank.

    ``documents`` (doc_id, text) and ``target`` (text); other columns are not read. The weight is the sum
    of the gains of a text's runs of one to three words, the score adds noise drawn from the id, and the
    best ``percent`` of the documents with ``least_words`` are drawn without replacement: ranks 1, 2, 3...

    A null or empty text has no words and weight 0 and is never drawn. A null doc_id draws noise of its own
    like any id and comes last among equal scores. Rows that repeat are documents each; between equal scores
    and ids the one with fewer features goes first, and rows alike in everything take any order among themselves.
    An empty table gives no rows; an empty target has count zero in every bucket. Long texts are one text each.
    """
    gain = gains(bucket_counts(documents, buckets), bucket_counts(target, buckets))
    score = F.col("weight") + _noise(F.col("doc_id"), seed, SCALE)
    scored = written(
        numbered(weighted(documents, gain).withColumn("score", score)).withColumns(
            {"_down": -F.col("score"), "_no_id": F.col("doc_id").isNull()}
        ),
        "resample-scores",
    )
    key = ["_down", "_no_id", "doc_id", "n_features", "row_id"]
    able = F.col("n_words") >= least_words
    wanted = scored.filter(able).count() * percent // 100
    last = kth_key(scored.filter(able), key, wanted) if wanted else None
    out = scored.withColumn("rank", F.lit(None).cast("bigint"))
    if last is not None:
        wins = able & (F.struct(*key) <= _fixed(last, scored.schema, key))
        out = out.filter(~wins).unionByName(_ranked(scored.filter(wins), key, wanted))
    return out.select("doc_id", "n_words", "n_features", "weight", "score", "rank")
