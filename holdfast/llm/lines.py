"""Repeated passages removed by content-defined chunks of lines, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import SPACE, SPACE_CHARS, filter_once, held, written

# A line ends at a line feed or, within a paragraph, at the space after a sentence
LINE_END = "(?<=\\n)|(?<=[.!?]\\x20)"
# A repeated chunk goes if it has at least so many lines and words
LEAST_LINES = 2
LEAST_WORDS = 10


def _bare(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACE_CHARS))


def with_chunks(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``_chunks``: the text's chunks in order, as (body, n_lines); joined, they are the text.

    Over the hashes of the lines rolls a window of three: a chunk ends after a line whose hash is less than
    that of the line before and of the line behind. Two such lines never follow each other, so every chunk
    but a text's last has two lines at least, three on average. An end depends on those three lines alone, so
    a passage is cut in the same places wherever it stands and whatever stands before it.
    """
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), LINE_END), lambda s: s != "")
    hashed = df.withColumn("_lines", lines).withColumn(
        "_hashes", F.transform("_lines", lambda s: F.md5(_bare(s)))
    )
    line_hashes, last = F.col("_hashes"), F.size("_lines")
    hashed_at = lambda i: F.get(line_hashes, i)
    least = lambda i: (hashed_at(i - 1) < hashed_at(i - 2)) & (hashed_at(i - 1) < hashed_at(i))
    ends = F.filter(F.transform("_lines", lambda s, i: i + 1), lambda i: (i == last) | ((i > 1) & least(i)))
    ended = hashed.withColumn("_ends", ends)
    before = lambda j: F.coalesce(F.get(F.col("_ends"), j - 1), F.lit(0))
    chunk = lambda e, j: F.struct(
        F.array_join(F.slice(F.col("_lines"), before(j) + 1, e - before(j)), "").alias("body"),
        (e - before(j)).alias("n_lines"),
    )
    return ended.withColumn("_chunks", F.transform("_ends", chunk)).drop("_lines", "_hashes", "_ends")


def _repeats(rows: DataFrame) -> DataFrame:
    """(row_id, places): the chunks to remove of each row that has any."""
    chunks = written(
        with_chunks(rows)
        .select(
            "row_id", "doc_id",
            F.posexplode(F.transform("_chunks", lambda c: F.struct(F.xxhash64(_bare(c["body"])).alias("h"), c["n_lines"].alias("n")))).alias("place", "c"),
        )
        .filter(F.col("c.n") >= LEAST_LINES)
        .select("row_id", "doc_id", "place", F.col("c.h").alias("h")),
        "line-chunks",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id", "place"))
    repeated = (
        chunks.groupBy("h").agg(F.count("*").alias("n"), first.alias("first")).filter("n > 1")
        .select("h", F.col("first.row_id").alias("first_row"), F.col("first.place").alias("first_place"))
    )
    is_first = (F.col("row_id") == F.col("first_row")) & (F.col("place") == F.col("first_place"))
    per_row = (
        chunks.join(repeated, "h")
        .groupBy("row_id").agg(F.collect_list(F.struct("place", "h", is_first.alias("is_first"))).alias("at"))
    )
    body = lambda a: F.get(F.col("_chunks"), a["place"])["body"]
    bodies = written(
        with_chunks(rows.select("row_id", "text").join(per_row, "row_id"))
        .select(
            "row_id",
            F.explode(F.transform("at", lambda a: F.struct(a["place"].alias("place"), a["h"].alias("h"), a["is_first"].alias("is_first"), _bare(body(a)).alias("body")))).alias("c"),
        )
        .select("row_id", "c.*")
        .filter(F.size(F.filter(F.split("body", SPACE), lambda w: w != "")) >= LEAST_WORDS),
        "line-bodies",
    )
    kept = bodies.filter("is_first").select("h", F.col("body").alias("kept_body"))
    return (
        bodies.filter("not is_first").join(kept, "h").filter(F.col("body") == F.col("kept_body"))
        .groupBy("row_id").agg(F.collect_set("place").alias("places"))
    )


def cleaned(rows: DataFrame, extra: str | None = None) -> DataFrame:
    """Per row: row_id, doc_id, text without repeats, n_chunks, n_removed (and the column ``extra``).

    ``rows`` (row_id, doc_id, text) are read several times. Of a chunk that repeats anywhere,
    the first occurrence stays: smallest doc_id (null last), then row and place. Chunks are
    found by hash, counted before the shuffle, and only those of equal hash are fetched and
    compared byte by byte (white space at the end aside), each with the first occurrence, so
    a passage in a third of all documents costs as many comparisons as occurrences. A null text
    stays null, an empty one empty. Repeated rows and doc_ids are told apart by row_id. An empty
    table gives no rows.
    """
    repeats = _repeats(rows.select("row_id", "doc_id", "text"))
    marked = with_chunks(rows.join(repeats, "row_id", "left"))
    removed = F.coalesce("places", F.array().cast("array<int>"))
    every = F.transform("_chunks", lambda c, i: i)
    rest = F.transform(F.array_except(every, removed), lambda i: F.get(F.col("_chunks"), i)["body"])
    return marked.select(
        "row_id", "doc_id",
        F.when(F.size(removed) > 0, F.array_join(rest, "")).otherwise(F.col("text")).alias("text"),
        F.size("_chunks").cast("bigint").alias("n_chunks"),
        F.size(removed).cast("bigint").alias("n_removed"),
        *([extra] if extra else []),
    )


def deduplicated(documents: DataFrame) -> DataFrame:
    """The documents without repeated chunks, with the columns they came with.

    ``n_chars`` is counted anew where a text changed; a document of which nothing but white
    space remains goes. The cases of :func:`cleaned` hold.
    """
    kept = held(documents, "line-documents")
    out = cleaned(kept.select("row_id", "doc.doc_id", "doc.text", "doc"), "doc")
    changed = F.col("n_removed") > 0
    doc = F.when(changed, F.col("doc").withField("text", F.col("text"))).otherwise(F.col("doc"))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        doc = F.when(
            changed,
            F.col("doc").withField("text", F.col("text")).withField("n_chars", F.length("text").cast(kind)),
        ).otherwise(F.col("doc"))
    rest = filter_once(out, ~changed | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    return rest.select(doc.alias("doc")).select("doc.*")


def chunks_sql() -> str:
    """Per document its chunks, those removed and the text that remains, in DuckDB SQL."""
    bare = "rtrim({}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, text,
         list_filter(string_split(regexp_replace(coalesce(text, ''), '(\n|[.!?] )', '\1' || chr(1), 'g'), chr(1)),
                     lambda x: x <> '') AS l FROM documents),
s AS (
  SELECT r, doc_id, i, s, lead(i) OVER w IS NULL
         OR coalesce(h < lag(h) OVER w AND h < lead(h) OVER w, false) AS is_end
  FROM (SELECT r, doc_id, i, l[i] AS s, md5({bare.format("l[i]")}) AS h
        FROM (SELECT r, doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d))
  WINDOW w AS (PARTITION BY r ORDER BY i)),
c AS (
  SELECT r, doc_id, place, string_agg(s, '' ORDER BY i) AS body, count(*) AS n
  FROM (SELECT *, coalesce(sum(is_end::INT) OVER (PARTITION BY r ORDER BY i
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM s)
  GROUP BY r, doc_id, place),
k AS (
  SELECT *, n >= {LEAST_LINES}
         AND len(list_filter(string_split_regex(body, '[\x20\x09-\x0D]+'), lambda x: x <> '')) >= {LEAST_WORDS} AS counts FROM c),
m AS (
  SELECT *, counts AND row_number() OVER (PARTITION BY counts, {bare.format("body")}
         ORDER BY doc_id NULLS LAST, r, place) > 1 AS gone FROM k),
o AS (
  SELECT r, count(*) AS n_chunks, count_if(gone) AS n_removed,
         coalesce(string_agg(body, '' ORDER BY place) FILTER (WHERE NOT gone), '') AS body FROM m GROUP BY r)
SELECT doc_id, coalesce(n_chunks, 0)::BIGINT AS n_chunks, coalesce(n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN coalesce(n_removed, 0) > 0 THEN body ELSE text END AS text
FROM d LEFT JOIN o USING (r)
"""
