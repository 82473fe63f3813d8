"""Collocations: mergeable Misra-Gries summaries of hashed n-grams, then exact counts of what survives."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.common import written
from holdfast.llm.shingles import mix, stream

# Fixed values
LONGEST = 4
LEAST = 30
SCALE = 2_000_000
CONTAINED_PERCENT = 80
TOP = 2_000
UNKNOWN = "und"
# Bytes of text whose words are numbered together; n-grams that a task holds before it hands them on
BLOCK_BYTES = 1 << 21
TASK_KEYS = 1 << 19
# Rows of an Arrow batch that are texts in memory at once
BATCH_TEXTS = 2_500
# Counters of one hash partition's summary, about; n-grams in one row of a partial summary
CELL_KEYS = 1 << 18
ROW_KEYS = 1 << 8
# Bits of the filter that the second pass asks first: a fixed size whatever the corpus
FILTER_BITS = 1 << 27
_PROBES = 3

_U = np.uint64
_STOP = b"."
_FACTORS = stream(31, LONGEST) | _U(1)


def _byte_map() -> bytes:
    """Lower case; every character that ends a piece becomes a full stop, a tab a space."""
    to = bytearray(range(256))
    to[65:91] = range(97, 123)
    for end in b".,;:!?\n\x0b\x0c\r":
        to[end] = _STOP[0]
    to[9] = 32
    return bytes(to)


_MAP = _byte_map()


def _blocks(texts: Sequence[str | None]) -> Iterator[bytes]:
    """The texts as byte blocks with full stops between them, cut at spaces."""
    held, size = [], 0
    for text in texts:
        raw = (text or "").encode().translate(_MAP).replace(_STOP, b" . ")
        at = 0
        while at < len(raw):
            end = len(raw)
            if end - at > BLOCK_BYTES:
                end = raw.find(b" ", at + BLOCK_BYTES)
                end = len(raw) if end < 0 else end
            held.append(raw[at:end])
            size += end - at
            at = end
            if size >= BLOCK_BYTES:
                yield b" ".join(held)
                held, size = [], 0
        held.append(_STOP)
    if held:
        yield b" ".join(held)


class Grams:
    """The distinct n-grams of one block with their counts; equal are those with equal words."""

    def __init__(self, tokens: list[bytes], carried: int, longest: int):
        ids, self.words = pd.factorize(np.array(tokens, object))
        self.ids, self.carried, self.longest = ids.astype(np.int64), carried, longest

    @property
    def widths(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(width, ids, place, count, key), worked out one width at a time."""
        ids = self.ids
        stop = np.array([w == _STOP for w in self.words], bool)
        hashed = np.array([xxhash.xxh64_intdigest(w) for w in self.words], _U)
        inside = ~stop[ids] if len(ids) else np.zeros(0, bool)
        level, n = ids, len(ids)
        for width in range(1, self.longest + 1):
            if n < width:
                break
            if width > 1:
                inside = inside[:-1] & ~stop[ids[width - 1 :]]
                # Two numbers below 2**31 each in one, then numbered anew: exact, no hash
                level = pd.factorize(level[:-1] * (len(self.words) + 1) + ids[width - 1 :])[0].astype(np.int64)
            new = np.arange(len(level)) + width > self.carried
            places = np.flatnonzero(inside & new)
            count = np.bincount(level[places])
            some = np.zeros(len(count), np.int64)
            some[level[places]] = places
            at, count = some[count > 0], count[count > 0]
            with np.errstate(over="ignore"):
                key = np.full(len(at), _U(width))
                for j in range(width):
                    key += hashed[ids[at + j]] * _FACTORS[j]
            yield width, ids, at, count, key

    def texts(self, width: int, ids: np.ndarray, at: np.ndarray) -> list[str]:
        parts = [self.words[ids[at + j]] for j in range(width)]
        return [b" ".join(p).decode() for p in zip(*parts, strict=True)]


def _grams(texts: Sequence[str | None], longest: int) -> Iterator[Grams]:
    """The n-grams of texts, block by block; one that spans two blocks is counted in the second."""
    tail: list[bytes] = []
    for block in _blocks(texts):
        tokens = tail + block.split()
        grams, tail = Grams(tokens, len(tail), longest), tokens[max(0, len(tokens) - longest + 1) :]
        # Only the distinct words stay while the n-grams are counted
        del tokens, block
        yield grams


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str | None]]]:
    """The texts of a language in some rows of a batch; no more than ``BATCH_TEXTS`` at once."""
    for batch in batches:
        for first in range(0, batch.num_rows, BATCH_TEXTS):
            frame = batch.slice(first, BATCH_TEXTS).to_pandas()
            for lang, texts in frame.groupby("lang", sort=False)["text"]:
                yield lang, texts.tolist()


def _lang_key(lang: str) -> np.uint64:
    return _U(xxhash.xxh64_intdigest(lang.encode(), 7))


def merge_summary(
    keys: np.ndarray, counts: np.ndarray, capacity: int | None = None
) -> tuple[np.ndarray, np.ndarray, int]:
    """Misra-Gries: equal keys summed, then all counters lowered until ``capacity`` of them are left.

    Returns what the counters were lowered by: no key's true count exceeds its counter, or zero where
    it has none, by more than the sum of these over all merges. Each lowering by one takes one from
    more than ``capacity`` counters, so that sum is below the mass divided by the capacity.
    """
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    keys = keys[starts]
    counts = np.add.reduceat(counts, starts) if len(starts) else counts
    if capacity is None or len(keys) <= capacity:
        return keys, counts, 0
    lowered = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    left = counts > lowered
    return keys[left], counts[left] - lowered, lowered


def _partial_summaries(documents: DataFrame, cell_bits: int, longest: int) -> DataFrame:
    """(cell, mass, keys, counts): what a task counted, by hash partition, in rows of bounded size."""

    def rows(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        cells = (keys >> _U(64 - cell_bits)).astype(np.int64)
        edges = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1], True]) if len(keys) else np.zeros(1, np.int64)
        cuts = np.concatenate([np.arange(a, b, ROW_KEYS) for a, b in zip(edges[:-1], edges[1:])] or [edges[:0]])
        ends = np.r_[cuts[1:], len(keys)] if len(cuts) else cuts
        small = counts.astype("<u4")
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(cells[cuts]),
                pa.array(np.add.reduceat(counts, cuts) if len(cuts) else counts),
                pa.array([keys[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                pa.array([small[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            ],
            ["cell", "mass", "keys", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size, settled = [], [], 0, 0
        for lang, texts in _by_lang(batches):
            salt = _lang_key(lang)
            for grams in _grams(texts, longest):
                with np.errstate(over="ignore"):
                    for *_, count, key in grams.widths:
                        keys.append(mix(key + salt))
                        counts.append(count)
                        size += len(key)
                if size >= 2 * settled + TASK_KEYS:
                    k, c, _ = merge_summary(np.concatenate(keys), np.concatenate(counts))
                    if len(k) >= TASK_KEYS:
                        yield from rows(k, c)
                        k, c = k[:0], c[:0]
                    keys, counts, size, settled = [k], [c], len(k), len(k)
        if size:
            yield from rows(*merge_summary(np.concatenate(keys), np.concatenate(counts))[:2])

    return documents.mapInArrow(count, "cell bigint, mass bigint, keys binary, counts binary")


def _survivors(partial: DataFrame, least: int) -> DataFrame:
    """(key) of every hashed n-gram that may occur ``least`` times: one summary per hash partition.

    The capacity exceeds the partition's mass divided by ``least``, so counters are lowered by less than that.
    """
    mass = F.sum("mass").over(Window.partitionBy("cell"))
    dealt = partial.withColumn("mass", mass)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, capacity, lowered = None, 0, 0
        keys, counts, waiting = [], [], 0

        def settle() -> None:
            nonlocal keys, counts, waiting, lowered
            k, c, by = merge_summary(np.concatenate(keys), np.concatenate(counts), capacity)
            keys, counts, waiting, lowered = [k], [c], 0, lowered + by

        def finished() -> pa.RecordBatch:
            settle()
            likely = keys[0][counts[0] + lowered >= least]
            return pa.RecordBatch.from_arrays([pa.array(likely.view(np.int64))], ["key"])

        for batch in batches:
            for c, m, k, n in zip(*[batch.column(i) for i in range(4)], strict=True):
                if c.as_py() != cell:
                    if cell is not None:
                        yield finished()
                    cell, capacity, lowered = c.as_py(), m.as_py() // least + 1, 0
                    keys, counts, waiting = [], [], 0
                keys.append(np.frombuffer(k.as_buffer(), "<u8"))
                counts.append(np.frombuffer(n.as_buffer(), "<u4").astype(np.int64))
                waiting += len(keys[-1])
                if waiting > capacity + TASK_KEYS // 4:
                    settle()
        if cell is not None:
            yield finished()

    return dealt.select("cell", "mass", "keys", "counts").mapInArrow(summed, "key bigint")


def _probe(key: np.ndarray, number: int) -> np.ndarray:
    """Bit numbers of hashed keys in the filter."""
    with np.errstate(over="ignore"):
        return (mix(key + _U(number * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % _U(FILTER_BITS)).astype(np.int64)


def _filter(spark: SparkSession, survivors: DataFrame) -> np.ndarray:
    """A Bloom filter of the surviving keys, at most ``FILTER_BITS`` bits whatever their number."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False).view(_U)
            at = np.unique(np.concatenate([_probe(key, i) for i in range(_PROBES)]))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(np.left_shift(1, at & 63))], ["w", "b"])

    words = survivors.mapInArrow(bits, "w bigint, b bigint").groupBy("w").agg(F.bit_or("b").alias("b"))
    full = np.zeros(FILTER_BITS // 64, np.int64)
    for part in words.toArrow().to_batches():
        full[part.column(0).to_numpy()] = part.column(1).to_numpy()
    return full.view(np.uint8)


def _counted(documents: DataFrame, survivors: DataFrame, least: int, longest: int) -> DataFrame:
    """(lang, width, phrase, n): exact counts of the phrases that occur ``least`` times, and of all words (width 0)."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(_filter(spark, survivors))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for lang, texts in _by_lang(batches):
            salt, words = _lang_key(lang), 0
            for grams in _grams(texts, longest):
                for width, ids, at, count, key in grams.widths:
                    if width == 1:
                        words += int(count.sum())
                    with np.errstate(over="ignore"):
                        key = mix(key + salt)
                    some = np.arange(len(key))
                    for i in range(_PROBES):
                        bit = _probe(key[some], i)
                        some = some[(known[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1]
                    if len(some):
                        yield _rows(lang, width, grams.texts(width, ids, at[some]), count[some])
            if words:
                yield _rows(lang, 0, [""], np.array([words]))

    found = documents.mapInArrow(count, "lang string, width int, phrase string, n bigint")
    return found.groupBy("lang", "width", "phrase").agg(F.sum("n").alias("n")).filter((F.col("width") == 0) | (F.col("n") >= least))


def _rows(lang: str, width: int, phrases: list[str], counts: np.ndarray) -> pa.RecordBatch:
    n = len(phrases)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), pa.array(np.full(n, width, np.int32)), pa.array(phrases, pa.string()),
         pa.array(counts.astype(np.int64))],
        ["lang", "width", "phrase", "n"],
    )


def frequent(documents: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(lang, width, phrase, n) of every run of up to ``longest`` words with ``least`` occurrences, exactly.

    Width 0 has the number of all words of a language. Written to the shared folder.
    """
    texts = documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text")
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Words are two bytes with what follows them at least
    cells = longest * size // 2 // least // CELL_KEYS
    partial = _partial_summaries(texts, max(6, int(cells).bit_length()), longest)
    survivors = written(_survivors(partial, least), "phrase-survivors")
    return written(_counted(texts, survivors, least, longest), "phrase-counts")


def _part(first: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def _exact(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def collocations(
    documents: DataFrame, least: int = LEAST, longest: int = LONGEST, scale: int = SCALE,
    contained: int = CONTAINED_PERCENT, top: int = TOP,
) -> DataFrame:
    """Per language its best phrases of two to ``longest`` words: lang, rank, phrase, a, l, r, n, score.

    A phrase that occurs a times is cut after each of its words; l and r count the two parts. The cut with the
    lowest floor(scale * a / (l + r)) counts, the first of equal ones. A phrase goes if a longer candidate holds it
    and occurs ``contained`` percent as often. ``documents`` (lang, text); other columns are not read.

    A null text is empty, a null lang is ``und``. Rows that repeat count each. A text without words adds
    nothing; an empty table gives no rows. Ranks go by score, then a, both falling, then phrase by its bytes. Texts
    are read whole; a long one goes by in blocks, and a phrase that spans two is counted.
    """
    counts = frequent(documents, least, longest)
    phrases = counts.filter("width >= 2").withColumn("words", F.split("phrase", " "))
    cuts = phrases.select(
        "lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("width") - 1)).alias("k"),
        "words", "width",
    ).select(
        "lang", "phrase", "a", "k",
        F.explode(F.array(
            F.struct(F.lit(True).alias("left"), _part(F.lit(1), F.col("k")).alias("part")),
            F.struct(F.lit(False).alias("left"), _part(F.col("k") + 1, F.col("width") - F.col("k")).alias("part")),
        )).alias("side"),
    )
    # A frequent word ends many phrases: its rows are spread by a salt, its count is repeated for each
    salts = 16
    parts = counts.filter((F.col("width") > 0) & (F.col("width") < longest)).select(
        "lang", F.col("phrase").alias("part"), F.col("n").alias("m"),
        F.explode(F.sequence(F.lit(0), F.when(F.col("width") == 1, salts - 1).otherwise(0))).alias("salt"),
    )
    salt = F.when(F.instr("side.part", " ") > 0, 0).otherwise(F.pmod(F.xxhash64("phrase"), F.lit(salts))).cast("int")
    sided = (
        cuts.select("lang", "phrase", "a", "k", "side.left", F.col("side.part").alias("part"), salt.alias("salt"))
        .join(parts, ["lang", "part", "salt"])
        .groupBy("lang", "phrase", "a", "k")
        .agg(F.max(F.when(F.col("left"), F.col("m"))).alias("l"), F.max(F.when(~F.col("left"), F.col("m"))).alias("r"))
    )
    top_part, bottom = _exact(F.lit(scale)) * _exact(F.col("a")), _exact(F.col("l")) + _exact(F.col("r"))
    scored = sided.withColumn("score", F.call_function("div", top_part.cast("decimal(38,0)"), bottom.cast("decimal(38,0)")))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
    longer = phrases.filter("width >= 3").select(
        "lang", "n",
        F.explode(F.flatten(F.transform(
            F.sequence(F.lit(2), F.col("width") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("width") - size + 1), lambda at: F.array_join(F.slice("words", at, size), " ")
            ),
        ))).alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("n").alias("_held"))
    over = _exact(F.lit(100)) * _exact(F.coalesce("_held", F.lit(0))) >= _exact(F.lit(contained)) * _exact(F.col("cut.a"))
    left = best.join(longer, ["lang", "phrase"], "left").filter(~over)
    order = [F.col("cut.score").desc(), F.col("cut.a").desc(), F.col("phrase")]
    ranked = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    totals = counts.filter("width = 0").select("lang", F.col("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "cut.a", "cut.l", "cut.r", "n", "cut.score"
    )
