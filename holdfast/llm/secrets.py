"""Secret scan with multipart credential linking, in DataFrame operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import numbered, written


def _either_case(*names: str) -> str:
    """Names as a pattern in which every letter may be of either case (ASCII only)."""
    one = lambda name: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)
    return "|".join(one(n) for n in names)


_IS = "[\"']?\\x20*[:=]\\x20*[\"']?"
# The kinds in their order and what a match must look like
ASSIGN = f"({_either_case('password', 'passwd', 'secret', 'token', 'api_?key')}){_IS}([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
# The parts that count only together: identifiers, long mixed tokens and endpoints
WEAK_ID = (
    f"({_either_case('username', 'user', 'login', 'client_?id', 'access_?key_?id', 'account')})"
    f"{_IS}([A-Za-z0-9._@+-]+)"
)
WEAK_SECRET = "[A-Za-z0-9+/_=-]{32,}"
ENDPOINT = (
    "(https?|wss?|ftp|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|redis|amqp|amqps)"
    "://[^\\x20\\x09-\\x0D\"'<>]+"
)
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "weak_id", "weak_secret", "endpoint")
_PATTERNS = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, WEAK_ID, WEAK_SECRET, ENDPOINT), strict=True))
# A literal without which there is no match; saves the pattern for most texts
_NEEDS = {"access": "AKIA", "endpoint": "://"}
_ROLE = {"assign": "secret", "hex": "secret", "weak_secret": "secret", "access": "id", "weak_id": "id",
         "endpoint": "endpoint"}
# Parts at most this many characters apart are in one scope; a cell of the interval join
REACH = 200
CELL = 256


def _matches(text: Column, kind: str) -> Column:
    """All matches of a kind as (gap to the match before, length, whether it counts).

    A text cut at the matches and the list of matches are aligned, so running sums of both
    lengths give the positions. The whole is worked out only for texts with a match.
    """
    pattern = F.lit(_PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, _PATTERNS[kind], -1)
    if kind in ("assign", "weak_id"):
        value = F.regexp_extract_all(text, pattern, F.lit(2))
        least = 6 if kind == "assign" else 3
        counts = lambda m, i: F.length(F.get(value, i)) >= least
    elif kind == "weak_secret":
        counts = lambda m, i: m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]")
    else:
        counts = lambda m, i: F.lit(True)
    listed = F.transform(
        found,
        lambda m, i: F.struct(
            F.length(F.get(gaps, i)).cast("bigint").alias("gap"),
            F.length(m).cast("bigint").alias("size"),
            counts(m, i).alias("counts"),
        ),
    )
    has = text.rlike(_PATTERNS[kind])
    if kind in _NEEDS:
        has = text.contains(_NEEDS[kind]) & has
    return F.when(has, listed)


def scan(df: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows with a number, and their spans (row_id, kind_no, start, end).

    The texts are read once; what was found is written, without them.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = written(
        numbered(df.select("doc_id", *[_matches(whole, k).alias(f"m{i}") for i, k in enumerate(KINDS)])),
        "secret-matches",
    )
    each = [
        rows.select("row_id", F.lit(i).alias("kind_no"), F.posexplode(f"m{i}").alias("place", "m"))
        for i in range(len(KINDS))
    ]
    through = Window.partitionBy("row_id", "kind_no").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    spans = (
        reduce(DataFrame.unionByName, each)
        .withColumn("end", F.sum(F.col("m.gap") + F.col("m.size")).over(through))
        .filter("m.counts")
        .select("row_id", "kind_no", (F.col("end") - F.col("m.size")).alias("start"), "end")
    )
    return rows.select("row_id", "doc_id"), written(spans, "secret-spans")


def linked(spans: DataFrame) -> DataFrame:
    """The weak spans that are part of a credential.

    An interval join within the document: a weak span looks into the cells that its reach
    covers, every span stands in the cells that it covers, and the two meet by document and
    cell. A cell holds only as many spans as have room in it, so a document with very many
    spans makes no large group. An identifier needs a secret in its scope, a long token an
    identifier, an endpoint both. A long token that overlaps a base span is that span.
    """
    role = F.element_at(F.array(*[F.lit(_ROLE[k]) for k in KINDS]), F.col("kind_no") + 1)
    parts = spans.withColumn("role", role)
    cells = lambda low, high: F.explode(F.sequence(F.floor(low / CELL), F.floor(high / CELL)))
    start, end = F.col("start"), F.col("end")
    weak = parts.filter(F.col("kind_no") >= len(BASE)).withColumn(
        "cell", cells(F.greatest(start - REACH, F.lit(0)), end + REACH)
    )
    near = parts.select(
        "row_id", F.col("role").alias("other"), F.col("kind_no").alias("other_kind"),
        F.col("start").alias("s"), F.col("end").alias("e"), cells(start, end - 1).alias("cell"),
    )
    own = (F.col("other_kind") == F.col("kind_no")) & (F.col("s") == start) & (F.col("e") == end)
    overlap = (F.col("s") < end) & (F.col("e") > start)
    met = weak.join(near, ["row_id", "cell"]).filter(
        ~own & (F.col("s") - end <= REACH) & (start - F.col("e") <= REACH)
    )
    has = lambda what: F.bool_or((F.col("other") == what) & ~overlap)
    needs = (
        F.when(F.col("role") == "id", F.col("with_secret"))
        .when(F.col("role") == "secret", F.col("with_id"))
        .otherwise(F.col("with_id") & F.col("with_secret"))
    )
    return (
        met.groupBy("row_id", "kind_no", "role", "start", "end")
        .agg(has("id").alias("with_id"), has("secret").alias("with_secret"),
             F.bool_or((F.col("other_kind") < len(BASE)) & overlap).alias("covered"))
        .filter(needs & ~F.col("covered"))
        .select("row_id", "kind_no", "start", "end")
    )


def _listed(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind_no"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")


def secret_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Positions count code points. A null or empty text has no span. Rows are told apart by a
    number, so repeated rows and repeated or null ids each get their own result; an empty
    table gives none. Only ``doc_id`` and the text are read. The spans of one document meet
    in one list, which its own length bounds.
    """
    rows, spans = scan(df, text)
    base = F.col("kind_no") < len(BASE)
    reported = spans.filter(base).unionByName(linked(spans))
    span = F.struct("start", "kind_no", "end")
    per_row = reported.groupBy("row_id").agg(
        *[F.count_if(F.col("kind_no") == i).alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.sort_array(F.collect_list(span)).alias("all"),
    )
    none = F.coalesce("all", F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint>>"))
    return rows.join(per_row, "row_id", "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in BASE],
        F.sha2(_listed(F.filter(none, lambda s: s["kind_no"] < len(BASE))), 256).alias("base_sha256"),
        _listed(none).alias("spans"),
    )


def scan_sql() -> str:
    """The same result in DuckDB SQL."""
    kinds = "\n".join(
        "UNION ALL " * (i > 0)
        + f"""SELECT row_id, {i} AS kind_no, unnest(range(1, len(m) + 1)) AS place,
            unnest(list_transform(g[:len(m)], lambda x: length(x))) AS gap,
            unnest(list_transform(m, lambda x: length(x))) AS size, unnest(c) AS counts
          FROM (SELECT row_id, m, g, {c} AS c FROM (
            SELECT row_id, t, regexp_extract_all(t, '{p}', 0) AS m, string_split_regex(t, '{p}') AS g{v} FROM d))"""
        for i, (p, c, v) in enumerate(
            (
                pattern.replace("'", "''"),
                f"list_transform(v, lambda x: length(x) >= {6 if kind == 'assign' else 3})"
                if kind in ("assign", "weak_id")
                else "list_transform(m, lambda x: regexp_matches(x, '[a-z]') AND regexp_matches(x, '[A-Z]')"
                " AND regexp_matches(x, '[0-9]'))"
                if kind == "weak_secret"
                else "list_transform(m, lambda x: true)",
                ", regexp_extract_all(t, '{}', 2) AS v".format(pattern.replace("'", "''"))
                if kind in ("assign", "weak_id")
                else "",
            )
            for kind, pattern in _PATTERNS.items()
        )
    )
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "][kind_no + 1]"
    roles = "[" + ", ".join(f"'{_ROLE[k]}'" for k in KINDS) + "][kind_no + 1]"
    listed = f"string_agg({names} || ':' || s || ':' || e, ',' ORDER BY s, kind_no, e)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({kinds}),
p AS (
  SELECT row_id, kind_no, e - size AS s, e, {roles} AS role
  FROM (SELECT *, sum(gap + size) OVER (PARTITION BY row_id, kind_no ORDER BY place)::BIGINT AS e FROM m)
  WHERE counts),
w AS (
  SELECT a.row_id, a.kind_no, a.s, a.e, a.role,
         bool_or(b.role = 'id' AND NOT (b.s < a.e AND b.e > a.s)) AS with_id,
         bool_or(b.role = 'secret' AND NOT (b.s < a.e AND b.e > a.s)) AS with_secret,
         bool_or(b.kind_no < 3 AND b.s < a.e AND b.e > a.s) AS covered
  FROM p a JOIN p b ON a.row_id = b.row_id AND b.s - a.e <= {REACH} AND a.s - b.e <= {REACH}
       AND (a.kind_no, a.s, a.e) <> (b.kind_no, b.s, b.e)
  WHERE a.kind_no >= 3 GROUP BY ALL),
r AS (
  SELECT row_id, kind_no, s, e FROM p WHERE kind_no < 3 UNION ALL
  SELECT row_id, kind_no, s, e FROM w WHERE NOT covered AND CASE role WHEN 'id' THEN with_secret
    WHEN 'secret' THEN with_id ELSE with_id AND with_secret END),
o AS (
  SELECT row_id, count_if(kind_no = 0) AS n_assign, count_if(kind_no = 1) AS n_access,
         count_if(kind_no = 2) AS n_hex, {listed} FILTER (WHERE kind_no < 3) AS base, {listed} AS spans
  FROM r GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN o USING (row_id)
"""
