"""Hashed words and word shingles of Arrow text columns, vectorised inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

_U = np.uint64
# Bytes of text hashed at once; a longer text is hashed on its own
CHUNK_BYTES = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply); a bijection."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers that depend on the seed alone."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


_BASE = 0x2545F4914F6CDD1D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = stream(11, 256)[_LOWER]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        both = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(1 << bits, _U(base))
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        return both[0], both[1]


def text_chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets) of consecutive texts; null is empty."""
    texts = column.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(ends, ends[first] + CHUNK_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield raw[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each lower-cased word, and the offsets of the texts in that list.

    A word's hash is a polynomial over random byte values, taken from one running sum.
    """
    n = len(raw)
    if n == 0:
        return np.zeros(0, _U), np.zeros(len(offsets), np.int64)
    word = ~_IS_SPACE[raw]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    inner = offsets[offsets < n]
    before[inner] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    after[inner[inner > 0] - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    power, inverse = _powers(max(21, int(n).bit_length()))
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, _U)
        np.cumsum(_BYTE[raw] * power[:n], out=total[1:])
        hashed = (total[ends] - total[starts]) * inverse[starts]
        hashed = mix(hashed + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))
    return hashed, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Per text its sorted distinct shingle hashes: empty without words, one if it is short."""
    factors = stream(23, width) | _U(1)
    for raw, offsets in text_chunks(column):
        hashed, at = word_hashes(raw, offsets)
        with np.errstate(over="ignore"):
            wide = np.zeros(max(0, len(hashed) - width + 1), _U)
            for j in range(width):
                wide += hashed[j : j + len(wide)] * factors[j]
            wide = mix(wide)
            for first, last in zip(at[:-1], at[1:], strict=True):
                if last - first >= width:
                    yield np.unique(wide[first : last - width + 1])
                elif last > first:
                    short = (hashed[first:last] * factors[: last - first]).sum(dtype=_U)
                    yield mix(np.array([short + _U(last - first)], _U))
                else:
                    yield np.zeros(0, _U)
