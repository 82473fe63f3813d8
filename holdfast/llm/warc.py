"""WARC archives: a writer on Spark's text sink and a reader that salvages damaged files."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import numbered, written
from holdfast.session import work_dir

# Payloads from this many bytes on are stored once
REVISIT_BYTES = 1000
# Records per archive file, and about the bytes that they may come to; a reader's task holds one archive
RECORDS_PER_ARCHIVE = 2000
ARCHIVE_BYTES = 1 << 29

_CRLF = "\r\n"
_VERSION = b"WARC/1."
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_GZIP = b"\x1f\x8b\x08"
# Compressed bytes inflated at a time
_INFLATE_BYTES = 1 << 16
_TRAILER = "gzip trailer does not fit"
_RFC4648 = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIXED_DATE = "1970-01-01T00:00:00Z"


def _uri(url: Column) -> Column:
    """A header value: control characters and spaces percent-encoded, null empty."""
    return F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), "[\\x00-\\x20\\x7F]", "%20")


def planned(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Pages as they are to be stored: row_id, page_id, target, payload, digest, size, revisits.

    Of rows with the same payload of at least ``REVISIT_BYTES`` bytes, the one with the largest
    page_id (nulls least; of equal ids the row read last) is stored; the others name it. The choice is a
    maximum per digest, pre-aggregated, so a payload of a third of all pages is no large group.
    """
    held = written(
        numbered(
            pages.select(
                F.col("page_id").cast("bigint").alias("page_id"),
                _uri(F.col(url)).alias("target"),
                F.coalesce(F.col(html), F.lit("")).alias("payload"),
            )
        ).withColumn("digest", F.sha1(F.col("payload").cast("binary"))).withColumn("size", F.octet_length("payload")),
        "warc-pages",
    )
    large = F.col("size") >= REVISIT_BYTES
    last = F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("at"), "page_id", "row_id")
    chosen = (
        held.filter(large).groupBy("digest").agg(F.count("*").alias("n"), F.max(last).alias("to"))
        .filter("n > 1")
        .select(F.col("digest").alias("_digest"), F.col("to.row_id").alias("to_row"))
    )
    return held.join(chosen, large & (F.col("digest") == F.col("_digest")), "left").select(
        "row_id", "page_id", "target", "payload", "digest", "size",
        F.when(F.col("to_row") != F.col("row_id"), F.col("to_row")).alias("revisits"),
    )


def _record_id(row: Column) -> Column:
    """A URN that follows from the row's number."""
    h = F.md5(row.cast("string"))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(
        F.lit("<urn:uuid:"),
        F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)),
        F.lit(">"),
    )


def _base32(hexed: Column) -> Column:
    """Base 32 of a digest given in hex: the usual form in WARC headers."""
    bits = F.concat(*[F.lpad(F.conv(F.substring(hexed, i, 5), 16, 2), 20, "0") for i in range(1, 41, 5)])
    digits = [F.conv(F.substring(bits, i, 5), 2, 10).cast("int") + 1 for i in range(1, 161, 5)]
    return F.concat(*[F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), d, F.lit(1)) for d in digits])


# An empty gzip member: what the text sink puts after each compressed record. Readers of
# concatenated members pass over it
EMPTY_MEMBER = gzip.compress(b"", mtime=0)


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        closed = [member(v.as_py().encode() + b"\r\n\r\n") for v in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(closed, pa.binary())], names=["value"])


def write(
    stored: DataFrame, path: str, records_per_archive: int = RECORDS_PER_ARCHIVE, gzipped: bool = True,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Archives at ``path``, one record per row of :func:`planned`.

    Records go by size into classes, each with so many records a file that they come to about
    ``archive_bytes`` at most, before compression; a larger record has a file of its own. A
    revisit counts as its page.

    Spark's text sink writes each record and, as line end, what closes it: an empty gzip
    member, or in a plain archive the two empty lines. Its commit keeps the files of failed
    attempts out.
    """
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "),
        F.octet_length("payload").cast("string"), F.lit(_CRLF + _CRLF),
    )
    block = F.when(F.col("revisits").isNull(), F.concat(head, F.col("payload"))).otherwise(head)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF))
    revisit = F.col("revisits").isNotNull()
    withblock = stored.withColumn("block", block)
    record = F.concat(
        F.lit(f"WARC/1.1{_CRLF}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("row_id"))),
        line("WARC-Date", F.lit(_FIXED_DATE)),
        line("WARC-Target-URI", F.col("target")),
        F.when(F.col("page_id").isNotNull(), line("WARC-Page-ID", F.col("page_id").cast("string")))
        .otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), _base32(F.col("digest")))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), _base32(F.sha1(F.col("block").cast("binary"))))),
        F.when(
            revisit,
            F.concat(line("WARC-Refers-To", _record_id(F.col("revisits"))), line("WARC-Profile", F.lit(_RFC4648))),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit(_CRLF), F.col("block"),
    )
    # Without the revisits the sizes are read from the pages alone, no payload is shuffled for them
    size = F.octet_length("target") + F.col("size")
    most = max(1, archive_bytes // records_per_archive)
    bounds = []
    while (most << 3 * len(bounds)) < archive_bytes:
        bounds.append(most << 3 * len(bounds))
    of_size = sum((F.when(size > b, 1).otherwise(0) for b in bounds), F.lit(0))
    used = sorted(r[0] for r in stored.select(of_size.alias("c")).distinct().collect()) or [0]
    for c in used:
        own = withblock.filter(of_size == c) if len(used) > 1 else withblock
        records = own.select(record.alias("value"))
        if gzipped:
            records = records.mapInArrow(_compressed, "value binary").select(F.col("value").cast("string"))
        (
            records.write.option("lineSep", EMPTY_MEMBER.decode("latin-1") if gzipped else _CRLF + _CRLF)
            .option("encoding", "ISO-8859-1" if gzipped else "UTF-8")
            .option("maxRecordsPerFile", min(records_per_archive, archive_bytes // bounds[c]) if c < len(bounds) else 1)
            .mode("overwrite" if c == used[0] else "append").text(path)
        )


@dataclass
class Record:
    """One record, or a quarantined gap (``reason`` set): bytes ``start`` to ``end``."""

    start: int
    end: int
    headers: dict[str, str]
    block: bytes
    reason: str | None = None


class Damaged(ValueError):
    """A record that fails a check."""


def _digest_fits(named: str, data: bytes) -> bool:
    algorithm, _, value = named.partition(":")
    if algorithm.strip().lower() != "sha1":
        return True
    digest = hashlib.sha1(data)
    return value.strip() == base64.b32encode(digest.digest()).decode() or value.strip().lower() == digest.hexdigest()


def parse_record(data: bytes, at: int) -> Record:
    """The record that begins at ``at``; raises :class:`Damaged` when a check fails."""
    version = _VERSION_LINE.match(data, at)
    if not version:
        raise Damaged("no version line")
    stop = data.find(b"\r\n\r\n", version.end() - 2)
    if stop < 0:
        raise Damaged("headers without end")
    if _VERSION_LINE.search(data, version.end(), stop + 2):
        raise Damaged("headers run into the next record")
    headers: dict[str, str] = {}
    for line in data[version.end() : stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without colon")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", length):
        raise Damaged("no content length")
    begin, end = stop + 4, stop + 4 + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("record cut short" if end + 4 > len(data) else "content length does not fit")
    block = data[begin:end]
    if not _digest_fits(headers.get("warc-block-digest", ""), block):
        raise Damaged("block digest does not fit")
    return Record(at, end + 4, headers, block)


def _plain(data: bytes, offset: int = 0) -> Iterator[Record]:
    at, bad_from, reason = 0, None, ""
    while at < len(data):
        try:
            record = parse_record(data, at)
        except Damaged as error:
            if bad_from is None:
                bad_from, reason = at, str(error)
            at = data.find(_VERSION, at + 1)
            if at < 0:
                break
            continue
        if bad_from is not None:
            yield Record(offset + bad_from, offset + at, {}, data[bad_from:at], reason)
            bad_from = None
        at = record.end
        record.start, record.end = offset + record.start, offset + record.end
        yield record
    if bad_from is not None:
        yield Record(offset + bad_from, offset + len(data), {}, data[bad_from:], reason)


def _member_body(data: bytes, at: int) -> int:
    """Where the compressed bytes of the gzip member at ``at`` begin, behind its header."""
    if len(data) < at + 10:
        raise Damaged("gzip member cut short")
    flags, to = data[at + 3], at + 10
    if flags & 0xE0:
        raise Damaged("no gzip member")
    if flags & 4:
        to += 2 + int.from_bytes(data[to : to + 2], "little")
    for bit in (8, 16):
        if flags & bit:
            to = data.find(b"\0", to) + 1
            if not to:
                raise Damaged("gzip member cut short")
    return to + 2 * bool(flags & 2)


def _inflated(data: bytes, begin: int) -> tuple[bytes, int, str | None]:
    """What the compressed bytes from ``begin`` inflate to, where that ends, and what is wrong with it.

    Of damaged bytes all that inflates before the damage is returned.
    """
    inflate, out, at, step = zlib.decompressobj(wbits=-15), [], begin, _INFLATE_BYTES
    while at < len(data) and not inflate.eof:
        piece = data[at : at + step]
        # A failed call keeps its output to itself: the piece is fed again byte by byte
        before = inflate.copy() if step > 1 else None
        try:
            out.append(inflate.decompress(piece))
        except zlib.error as error:
            if before is None:
                return b"".join(out), at, str(error)
            inflate, step = before, 1
            continue
        at += len(piece)
    raw, end = b"".join(out), at - len(inflate.unused_data)
    if not inflate.eof or end + 8 > len(data):
        return raw, len(data), _TRAILER if inflate.eof else "gzip member cut short"
    trailer = zlib.crc32(raw).to_bytes(4, "little") + (len(raw) % (1 << 32)).to_bytes(4, "little")
    return raw, end + 8, None if data[end : end + 8] == trailer else _TRAILER


def _used(data: bytes, begin: int, size: int) -> int:
    """How far the compressed bytes from ``begin`` are read for ``size`` bytes of output."""
    inflate, at = zlib.decompressobj(wbits=-15), begin
    while size and at < len(data):
        piece = data[at : at + _INFLATE_BYTES]
        size -= len(inflate.decompress(piece, size))
        at += len(piece) - len(inflate.unconsumed_tail)
        if inflate.eof:
            return at - len(inflate.unused_data)
    return at


def _member(data: bytes, at: int, inside: bool) -> tuple[list[Record], int, int]:
    """Records of the gzip member at ``at``, where it ends, and where the search goes on.

    A member that is whole ends where the search goes on. A damaged one gives the good records
    of what it inflates to; the search goes on behind the bytes that these take. The trailer of
    a member of one record answers for that record alone, so if it does not fit the record is bad.
    """
    begin = _member_body(data, at)
    raw, end, wrong = _inflated(data, begin)
    # Damaged bytes may inflate on over members that stand behind them
    records = list(_plain(raw) if wrong is None or inside else salvage(raw, True))
    good = [r for r in records if not r.reason]
    if records and (not good or wrong == _TRAILER and len(records) == 1):
        raise Damaged(wrong or records[0].reason)
    if wrong and not good:
        raise Damaged(wrong)
    on = end if wrong is None else max(_used(data, begin, good[-1].end), at + 1)
    return records, end, on


def salvage(data: bytes, inside: bool = False) -> Iterator[Record]:
    """All records of an archive that pass their checks, and a gap for each run of other bytes.

    After a failed check the search goes on, one byte behind the place that failed, for the
    next version line or gzip member at which a whole record passes, whatever the archive began
    with. A stored length that does not fit is never trusted to skip by. Of a gzip member,
    positions are those of the compressed bytes; a gap inside one has the inflated bytes. ``inside``
    says that the data are what a damaged member inflates to.
    """
    at, bad_from, reason = 0, None, ""
    # The last member that was damaged but has good records: they wait for where it ends
    waiting: tuple[list[Record], int] | None = None
    following = {_GZIP: -1, _VERSION: -1}

    def closed(to: int) -> Iterator[Record]:
        start = bad_from
        if waiting is not None:
            records, end = waiting
            end = min(end, to)
            for record in records:
                record.start, record.end = bad_from, end
                yield record
            start = end
        if start is not None and start < to:
            yield Record(start, to, {}, data[start:to], reason)

    while at < len(data):
        try:
            if data.startswith(_GZIP, at):
                records, end, on = _member(data, at, inside)
                whole = on == end
                for record in records:
                    record.start, record.end = at, end
            else:
                record = parse_record(data, at)
                records, on, whole = [record], record.end, True
        except Damaged as error:
            if bad_from is None:
                bad_from, reason = at, str(error)
            on = at + 1
        else:
            yield from closed(at)
            bad_from, waiting = None, None
            if whole:
                yield from records
                at = on
                continue
            bad_from, waiting, reason = at, (records, end), "gzip member damaged"
        for mark, place in following.items():
            if place < on:
                place = data.find(mark, on)
                following[mark] = place if place >= 0 else len(data)
        at = min(following.values())
    yield from closed(len(data))


def member(record: bytes) -> bytes:
    """One record as a gzip member of its own."""
    return gzip.compress(record, compresslevel=6, mtime=0)


def _http_payload(block: bytes) -> bytes:
    head, gap, body = block.partition(b"\r\n\r\n")
    return body if gap and head.startswith(b"HTTP/") else block


_READ = pa.schema(
    [
        ("archive", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reason", pa.string()),
        ("quarantined", pa.binary()), ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()),
        ("target", pa.string()), ("refers", pa.string()), ("named_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)
_READ_TYPES = (
    "archive string, start bigint, end bigint, reason string, quarantined binary, record_id string, "
    "record_type string, page_id bigint, target string, refers string, named_digest string, payload binary"
)
# Records handed to Spark at once
_BATCH = 256


def _hex_digest(named: str | None) -> str | None:
    value = (named or "").partition(":")[2].strip()
    try:
        return base64.b32decode(value).hex() if len(value) == 32 else value.lower() or None
    except ValueError:
        return None


def _bigint(value: str) -> int | None:
    number = int(value) if re.fullmatch("-?[0-9]{1,19}", value) else None
    return number if number is not None and -(1 << 63) <= number < 1 << 63 else None


def _row(archive: str, r: Record) -> tuple:
    if r.reason:
        return (archive, r.start, r.end, r.reason, r.block) + (None,) * 7
    h = r.headers
    return (
        archive, r.start, r.end, None, None, h.get("warc-record-id"), h.get("warc-type"),
        _bigint(h.get("warc-page-id", "")), h.get("warc-target-uri"),
        h.get("warc-refers-to"), _hex_digest(h.get("warc-payload-digest")),
        _http_payload(r.block) if h.get("warc-type") != "revisit" else None,
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ
        )

    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            rows = []
            for record in salvage(content.as_py() or b""):
                rows.append(_row(path.as_py(), record))
                if len(rows) == _BATCH:
                    yield packed(rows)
                    rows = []
            if rows:
                yield packed(rows)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all archives under ``path``, plain or of gzip members.

    A gap has ``reason`` and the bytes in ``quarantined``; a record has neither. A task reads
    one archive at a time and holds it whole (at most 2 GB), so archives are to be cut to a
    size; :func:`write` does. An empty archive gives no rows.
    """
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_read, _READ_TYPES)


def gap_log(records: DataFrame) -> DataFrame:
    """The quarantined byte ranges of :func:`read`."""
    return records.filter(F.col("reason").isNotNull()).select(
        "archive", "start", "end", "reason", "quarantined"
    )


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages and read them back: page_id, payload_bytes, payload_digest, record_type,
    refers_to, target.

    A null html is an empty payload, a null url an empty target, a null page_id stays null.
    Repeated rows are records of their own. A revisit takes size and digest from the record
    that it names. An empty table gives no rows; columns other than page_id, url and html are not
    stored.
    """
    spark = pages.sparkSession
    path = path or work_dir(spark, "warc-archives")
    write(planned(pages), path)
    records = written(
        read(spark, path).filter(F.col("reason").isNull()).select(
            "record_id", "record_type", "page_id", "target", "refers", "named_digest",
            F.octet_length("payload").cast("bigint").alias("size"), F.sha1("payload").alias("digest"),
        ),
        "warc-records",
    )
    named = records.select(
        F.col("record_id").alias("_id"), F.col("page_id").alias("_page"),
        F.col("size").alias("_size"), F.col("digest").alias("_digest"),
    )
    return records.join(named, F.col("refers") == F.col("_id"), "left").select(
        "page_id",
        F.coalesce("size", "_size").alias("payload_bytes"),
        F.coalesce("digest", "_digest").alias("payload_digest"),
        "record_type",
        F.col("_page").alias("refers_to"),
        "target",
    )
