"""Personal data: base patterns, and unseen identifiers found by bootstrapped contexts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import numbered, written
from holdfast.llm.shingles import mix, text_chunks, word_hashes

# The base kinds in their order
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "context")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++){0,3}+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# A token that may be an identifier: where one can begin, what it is stripped of
_MARK = re.compile(r"[0-9@][^\x20\x09-\x0D]*")
_SPACES = frozenset(" \t\n\x0b\x0c\r")
_STRIP = "\"'`.,;:!?()[]{}<>*#$%&|=+"
_LEAST_DIGITS = 4

# Rounds of scoring; a pattern counts with so many distinct instances and that share of all
# places where its words occur
ROUNDS = 3
LEAST_SUPPORT = 3
LEAST_SCORE = 0.5
# Bits of the filter of contexts, a fixed size whatever the corpus
FILTER_BITS = 1 << 24
# Distinct contexts that a task counts before it hands them on
TASK_KEYS = 1 << 20

_U = np.uint64


def emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        start = at
        if domain:
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
        if start < at:
            last = domain.end()
            yield start, last
            at = text.find("@", last)
        else:
            at = text.find("@", at + 1)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".")
        if len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
            yield m.span()


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _DIGITS.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds, by start and kind."""
    found = (emails, addresses, cards, phones)
    return sorted((s, k, e) for k, find in enumerate(found) for s, e in find(text))


def candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Tokens that may be identifiers and touch no base span, in order."""
    place, reach = 0, 0
    for m in _MARK.finditer(text):
        start, end = m.span()
        while start > 0 and text[start - 1] not in _SPACES:
            start -= 1
        while start < end and text[start] in _STRIP:
            start += 1
        while end > start and text[end - 1] in _STRIP:
            end -= 1
        token = text[start:end]
        if "@" not in token and sum(c in "0123456789" for c in token) < _LEAST_DIGITS:
            continue
        while place < len(base) and base[place][0] < end:
            reach = max(reach, base[place][2])
            place += 1
        if start < reach:
            continue
        yield start, end


def _context_keys(hashed: np.ndarray, at: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the word, and of the two words, that end before word ``at``."""
    with np.errstate(over="ignore"):
        one = mix(hashed[at - 1] + _U(0x632BE59BD9B4E019))
        two = mix(hashed[at - 2] * _U(0x9E3779B97F4A7C15) + hashed[at - 1])
    return one.view(np.int64), two.view(np.int64)


_SPAN = pa.struct([("start", pa.int64()), ("kind_no", pa.int32()), ("end", pa.int64())])
_PLACE = pa.struct(
    [("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_()), ("instance", pa.int64()),
     ("one", pa.int64()), ("two", pa.int64()), ("words", pa.string())]
)


def _instance(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.lower().encode(), digest_size=8).digest(), "little", signed=True)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans of each text, and all seeds and candidates with the words before them."""
    for batch in batches:
        spans, places = [], []
        texts = iter(batch.column(2))
        for raw, offsets in text_chunks(batch.column(2)):
            hashed, at = word_hashes(raw, offsets)
            for n in range(len(offsets) - 1):
                text = next(texts).as_py() or ""
                base = base_spans(text)
                spans.append([{"start": s, "kind_no": k, "end": e} for s, k, e in base])
                marked = sorted([(s, e, True) for s, _, e in base] + [(s, e, False) for s, e in candidates(text, base)])
                own = []
                words = None
                seen, before = 0, 0
                for start, end, seed in marked:
                    before += len(text[seen:start].encode())
                    seen = start
                    if words is None:
                        words = _word_starts(raw[offsets[n] : offsets[n + 1]])
                    k = int(np.searchsorted(words, before, side="right")) - 1
                    first = int(at[n])
                    one = two = None
                    if k >= 1:
                        a, b = _context_keys(hashed, np.array([first + k]))
                        one = int(a[0])
                        two = int(b[0]) if k >= 2 else None
                    said = bytes(raw[offsets[n] + words[max(k - 2, 0)] : offsets[n] + words[k]]).decode() if k >= 1 else ""
                    own.append(
                        {"start": start, "end": end, "seed": seed, "instance": _instance(text[start:end]),
                         "one": one, "two": two, "words": said.strip()}
                    )
                places.append(own)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(spans, pa.list_(_SPAN)), pa.array(places, pa.list_(_PLACE))],
            names=["row_id", "doc_id", "base", "places"],
        )


def _word_starts(raw: np.ndarray) -> np.ndarray:
    """Byte positions at which the words of one text begin."""
    word = (raw > 32) | ((raw < 9) | ((raw > 13) & (raw < 32)))
    before = np.concatenate([[False], word[:-1]])
    return np.flatnonzero(word & ~before)


def _bits(key: Column) -> Column:
    """Two bit numbers of a context key."""
    return F.array(
        F.pmod(key, F.lit(FILTER_BITS)), F.pmod(F.shiftright(key, 32), F.lit(FILTER_BITS))
    )


def _filter_of(patterns: DataFrame) -> np.ndarray:
    """A Bloom filter of the patterns: at most ``FILTER_BITS`` / 64 numbers reach the driver."""
    bit = patterns.select(F.explode(_bits(F.col("pattern"))).alias("bit"))
    cells = bit.groupBy(F.floor(F.col("bit") / 64).cast("int").alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 AS int))")).alias("mask")
    )
    out = np.zeros(FILTER_BITS // 64, np.int64)
    got = cells.toArrow()
    out[got["cell"].to_numpy()] = got["mask"].to_numpy()
    return out.view(_U)


def _counter(filled: np.ndarray):
    """Task: how often each context that passes the filter occurs in its texts."""

    def passes(keys: np.ndarray) -> np.ndarray:
        keep = np.ones(len(keys), bool)
        for number in (keys % FILTER_BITS, (keys >> 32) % FILTER_BITS):
            keep &= (filled[number // 64] >> (number % 64).astype(_U)) & _U(1) == 1
        return keys[keep]

    def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(keys, return_inverse=True)
        return keys, np.bincount(place, n, len(keys)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for raw, offsets in text_chunks(batch.column(0)):
                hashed, at = word_hashes(raw, offsets)
                if len(hashed) < 2:
                    continue
                place = np.arange(len(hashed)) - np.repeat(at[:-1], np.diff(at))
                one, _ = _context_keys(hashed, np.flatnonzero(place >= 1))
                _, two = _context_keys(hashed, np.flatnonzero(place >= 2))
                keys, n = np.unique(np.concatenate([passes(one), passes(two)]), return_counts=True)
                held, counts = summed(np.concatenate([held, keys]), np.concatenate([counts, n]))
                if len(held) > TASK_KEYS:
                    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts)], names=["pattern", "n"])
                    held, counts = held[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts)], names=["pattern", "n"])

    return count


def bootstrap(edges: DataFrame, totals: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, score): the patterns that are trusted.

    ``edges`` (pattern, instance, seed, n): how often a pattern precedes an instance; ``totals``
    (pattern, total): how often its words occur at all. Seeds have confidence 1. In each
    round a pattern's score is the confident part of all its places, and an instance's
    confidence the best score among its patterns; a pattern with fewer than
    ``LEAST_SUPPORT`` distinct confident instances has none. Both directions are joins over
    pre-aggregated edges.
    """
    confidence = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("confidence"))
    for turn in range(rounds):
        confident = F.count_if(F.col("confidence") >= LEAST_SCORE)
        scores = written(
            edges.join(confidence, "instance").groupBy("pattern")
            .agg(F.sum(F.col("n") * F.col("confidence")).alias("hits"), confident.alias("support"))
            .filter(F.col("support") >= LEAST_SUPPORT)
            .join(totals, "pattern")
            .select("pattern", F.least(F.col("hits") / F.col("total"), F.lit(1.0)).alias("score")),
            "pii-scores",
        )
        if turn < rounds - 1:
            confidence = written(
                edges.join(scores, "pattern", "left").groupBy("instance").agg(
                    F.greatest(
                        F.max(F.col("seed").cast("double")), F.coalesce(F.max("score"), F.lit(0.0))
                    ).alias("confidence")
                ),
                "pii-confidence",
            )
    return scores.filter(F.col("score") >= LEAST_SCORE)


def personal_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """Per row: row_id, doc_id, base and found, both lists of (start, kind_no, end).

    Tokens with four digits or an at sign that no base pattern takes are candidates. The one
    and the two words before a seed or candidate are its patterns; those that announce mainly
    identifiers are learnt by :func:`bootstrap` from all rows, and candidates that follow one
    are found. A null or empty text has nothing. Rows are told apart by a number, so repeated
    rows and repeated or null ids each get their own result; copies of an instance count
    once for a pattern's support. An empty table gives no rows. Only doc_id and the text are read.
    """
    id_type = df.schema["doc_id"].dataType.simpleString()
    rows = written(
        numbered(df.select("doc_id", F.col(text).alias("text"))).select("row_id", "doc_id", "text").mapInArrow(
            _find,
            f"row_id bigint, doc_id {id_type}, base array<struct<start:bigint,kind_no:int,end:bigint>>, "
            "places array<struct<start:bigint,end:bigint,seed:boolean,instance:bigint,one:bigint,two:bigint,words:string>>",
        ),
        "pii-rows",
    )
    places = rows.select("row_id", F.explode("places").alias("p")).select("row_id", "p.*")
    patterns = F.explode(F.array_compact(F.array("one", "two"))).alias("pattern")
    seen = written(
        places.select("instance", "seed", patterns).groupBy("pattern", "instance").agg(
            F.max("seed").alias("seed"), F.count("*").alias("n")
        ),
        "pii-edges",
    )
    # With fewer distinct instances in all, a pattern never has the support of confident ones
    able = seen.groupBy("pattern").agg(F.count("*").alias("all")).filter(F.col("all") >= LEAST_SUPPORT)
    edges = written(seen.join(able.select("pattern"), "pattern", "left_semi"), "pii-edges")
    counted = df.select(F.col(text).alias("text")).mapInArrow(
        _counter(_filter_of(edges.select("pattern"))), "pattern bigint, n bigint"
    )
    totals = written(
        counted.groupBy("pattern").agg(F.sum("n").alias("total"))
        .join(edges.select("pattern").distinct(), "pattern", "left_semi"),
        "pii-totals",
    )
    trusted = bootstrap(edges, totals).select("pattern")
    found = (
        places.filter("not seed").select("row_id", "start", "end", patterns)
        .join(trusted, "pattern", "left_semi")
        .groupBy("row_id").agg(
            F.sort_array(
                F.collect_set(F.struct("start", F.lit(len(BASE)).alias("kind_no"), "end"))
            ).alias("found")
        )
    )
    return rows.select("row_id", "doc_id", "base").join(found, "row_id", "left").withColumn(
        "found", F.coalesce("found", F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint>>"))
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind_no"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")
