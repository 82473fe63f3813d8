"""Byte-level BPE encoding and decoding by a local rank file."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

# A text longer than this many characters is encoded piece by piece
PIECE_CHARS = 1 << 16

_FIELDS = {
    "n_tokens": ("bigint", pa.int64()),
    "ids": ("array<int>", pa.list_(pa.int32())),
    "ids_sha256": ("string", pa.string()),
    "decoded": ("binary", pa.binary()),
    "decoded_sha256": ("string", pa.string()),
}
# Characters that every engine takes for white space
_SPACE = re.compile("[ \t\n\r]")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file; one per worker process."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a long text only where no pattern match can reach across.

    No alternative of the pattern holds white space after another character, so a cut before
    a white-space character that follows another kind is safe: nothing ends beyond it, and
    the look-ahead of a white-space run sees the same characters.
    """
    start = 0
    while len(text) - start > size:
        cut = start + size
        while True:
            found = _SPACE.search(text, cut)
            if found is None:
                yield text[start:]
                return
            cut = found.start()
            if not text[cut - 1].isspace():
                break
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:]


def encode_text(text: str, path: str, pattern: str) -> list[int]:
    """Ids of a whole text, the same as of one call on all of it."""
    encoder = encoding(path, pattern)
    if len(text) <= PIECE_CHARS:
        return encoder.encode_ordinary(text)
    ids: list[int] = []
    for piece in pieces(text):
        ids.extend(encoder.encode_ordinary(piece))
    return ids


def token_columns(
    df: DataFrame, path: str, pattern: str, fields: Sequence[str],
    text: str = "text", keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Encode ``text`` of every row and decode the ids again.

    ``fields`` names what a task works out and returns beside the columns ``keep``: n_tokens,
    ids, ids_sha256 (of the ids as little-endian unsigned 32-bit integers), decoded (raw
    bytes), decoded_sha256. Only those leave Python. A null text counts as empty: no ids.
    Rows are independent, so repeated rows, ties and an empty table need no rule; columns not
    named are dropped, so extra ones cannot clash. A long text is cut at safe places and
    needs memory for itself and its ids. Special-token strings are ordinary text.
    """
    if clash := set(fields) & set(keep):
        raise ValueError(f"columns kept under the name of a result: {sorted(clash)}")
    source = df.select(*keep, df[text].alias("_text"))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    schema = ", ".join([*kept, *[f"{f} {_FIELDS[f][0]}" for f in fields]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f: [] for f in fields}
            for value in batch.column(len(keep)):
                ids = encode_text(value.as_py() or "", path, pattern)
                raw = None
                if "decoded" in out or "decoded_sha256" in out:
                    raw = encoding(path, pattern).decode_bytes(ids)
                for field, column in out.items():
                    if field == "n_tokens":
                        column.append(len(ids))
                    elif field == "ids":
                        column.append(np.asarray(ids, np.int32))
                    elif field == "ids_sha256":
                        column.append(hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest())
                    elif field == "decoded":
                        column.append(raw)
                    else:
                        column.append(hashlib.sha256(raw).hexdigest())
            arrays = [pa.array(column, _FIELDS[f][1]) for f, column in out.items()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], *arrays], names=[*keep, *fields]
            )

    return source.mapInArrow(run, schema)
