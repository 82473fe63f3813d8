"""Queries of the corpus operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import hpylm, lines, mixing, mtree, neardup, phrases, pii, quality, resample, secrets, simhash, tokens, warc
from holdfast.llm.common import body, held, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@_query("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_columns(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        ("n_tokens", "ids_sha256", "decoded_sha256"),
    )


MIX_SQL = r"""
WITH sized AS (
  SELECT row_number() OVER () AS row_id, doc_id, source,
         len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size
  FROM documents),
s1 AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS source_no
  FROM sized GROUP BY source),
s2 AS (
  SELECT *, [3, 1, 2][(source_no - 1) % 3 + 1] AS weight, 2 * source_size AS cap,
         1.5::DOUBLE * sum(source_size) OVER () AS budget FROM s1),
s3 AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source_no
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS stopped,
         sum(weight) OVER (ORDER BY cap / weight, source_no
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS open_weight FROM s2),
s4 AS (SELECT *, cap * open_weight <= weight * (budget - stopped) AS is_full FROM s3),
s5 AS (
  SELECT source, source_no, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE
         weight * (budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0)::DOUBLE)
         / (sum(CASE WHEN NOT is_full THEN weight END) OVER ())::DOUBLE END AS target FROM s4),
copies AS (
  SELECT d.*, s.source_no, s.source_size, s.target, e.epoch,
         md5(coalesce(d.doc_id::VARCHAR, 'null') || ':' || e.epoch) AS draw
  FROM sized d JOIN s5 s ON d.source IS NOT DISTINCT FROM s.source,
       (SELECT unnest([0, 1]) AS epoch) e WHERE d.size > 0),
finish AS (
  SELECT *, (epoch * source_size + sum(size) OVER (PARTITION BY source_no, epoch
             ORDER BY draw, doc_id, size, row_id ROWS UNBOUNDED PRECEDING))::DOUBLE / target AS finish
  FROM copies),
run AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source_no, draw, size, row_id
             ROWS UNBOUNDED PRECEDING) AS through FROM finish),
taken AS (
  SELECT row_id, sum(size)::BIGINT AS taken FROM run
  WHERE 2 * through <= (SELECT 3 * sum(size) FROM sized) GROUP BY row_id)
SELECT d.doc_id, d.size, s.source_size, s.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM sized d JOIN s5 s ON d.source IS NOT DISTINCT FROM s.source LEFT JOIN taken t USING (row_id)
"""


@_query("op8_fair_mix", MIX_SQL)
def op8_fair_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_plan(table(spark, folder, "documents"))


_MEASURED_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (
  SELECT r, unnest([i, i + 1, i + 2]) AS p
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM twice GROUP BY r),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l)::BIGINT AS n_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (r)),
b AS (
  SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
            + 4 * (100 * n_symbols > 20 * n_words)::BIGINT + 8 * (word_chars > 12 * n_words)::BIGINT
            + 16 * (word_chars < 2 * n_words)::BIGINT
            + 32 * (100 * n_dup_lines > 50 * n_lines)::BIGINT AS failed_bits FROM m)
"""

QUALITY_SQL = _MEASURED_SQL + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits,
       failed_bits % 4 <> 0 AS base_failed, failed_bits = 0 AS kept FROM b
"""


@_query("op5_quality_ledger", QUALITY_SQL)
def op5_quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    noted = quality.stored(table(spark, folder, "documents"))
    bits = F.col("_ledger.failed_bits")
    return noted.select(
        "doc_id",
        *[F.col(f"_ledger.{m}") for m in quality.MEASURES if m != "n_lines"],
        bits,
        (bits.bitwiseAND(F.lit(quality.BASE)) != 0).alias("base_failed"),
        quality.passes().alias("kept"),
    )


ABLATION_SQL = _MEASURED_SQL + """,
p AS (
  SELECT version, mask, unnest(['few_words', 'repeated_words', 'many_symbols', 'long_words', 'short_words', 'repeated_lines'])
         AS rule, unnest([1, 2, 4, 8, 16, 32]) AS bit
  FROM (VALUES (1, 3), (2, 63)) AS v(version, mask))
SELECT version, rule, count(*) FILTER (failed_bits & mask & bit <> 0)::BIGINT AS failing,
       count(*) FILTER (failed_bits & mask = bit)::BIGINT AS only_this_rule,
       count(*) FILTER (failed_bits & mask = 0)::BIGINT AS kept
FROM b, p WHERE mask & bit <> 0 GROUP BY version, rule
"""


@_query("quality_ablations", ABLATION_SQL)
def quality_ablations(spark: SparkSession, folder: str) -> DataFrame:
    noted = quality.stored(table(spark, folder, "documents"))
    return quality.ablations(noted.select("_ledger.failed_bits"))


@_query("op2_min_max_hash")
def op2_min_max_hash(spark: SparkSession, folder: str) -> DataFrame:
    rows = body(held(table(spark, folder, "documents").select("doc_id", "text"), "neardup-documents"))
    return neardup.near_duplicates(rows).select("doc_id", "n_shingles", "component_id", "kept")


@_query("op7_linked_secrets", secrets.scan_sql())
def op7_linked_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_spans(table(spark, folder, "documents"))


WARC_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY page_id DESC) AS k,
             max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 1000 AND k > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND k > 1 THEN last END AS refers_to
FROM q
"""


@_query("op4_warc_salvage", WARC_SQL)
def op4_warc_salvage(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages")).drop("target")


TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
WHERE rank <= 5
"""


@_query("op9_mtree_topk", TOP_SQL)
def op9_mtree_topk(spark: SparkSession, folder: str) -> DataFrame:
    return mtree.nearest(table(spark, folder, "embeddings"), 50)


@_query("op6_line_chunks", lines.chunks_sql())
def op6_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    rows = body(held(table(spark, folder, "documents").select("doc_id", "text"), "line-documents"))
    return lines.cleaned(rows).select("doc_id", "n_chunks", "n_removed", "text")


@_query("op1_contextual_pii")
def op1_contextual_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.personal_spans(table(spark, folder, "documents"))
    of_kind = lambda i: F.size(F.filter("base", lambda s: s["kind_no"] == i)).cast("bigint")
    return found.select(
        "doc_id",
        *[of_kind(i).alias(f"n_{kind}") for i, kind in enumerate(pii.BASE)],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.sort_array(F.concat("base", "found"))).alias("spans"),
    )


@_query("op3_pitman_yor")
def op3_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    return hpylm.scored(table(spark, folder, "documents"))


def _resample_sql() -> str:
    """The CRC of each distinct feature is folded over its bytes; the step table comes from its rule."""
    steps = ", ".join(str(n) for n in resample.CRC_TABLE)
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, 0 AS side, doc_id, text FROM documents
  UNION ALL SELECT row_number() OVER (), 1, NULL, text FROM benchmark),
w AS (
  SELECT r, side, doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM texts),
f AS (
  SELECT r, side, unnest(list_concat(w, list_concat(
           list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
           list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS f FROM w),
n AS (SELECT r, side, f, count(*) AS n FROM f GROUP BY ALL),
h AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM n)),
b AS (
  SELECT f, xor(4294967295::BIGINT, list_reduce(
           list_transform(range(0, len(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::BIGINT),
           lambda c, y: xor(c >> 8, [{steps}][(xor(c, y) & 255) + 1]::BIGINT),
           4294967295::BIGINT)) % 10000 AS b FROM h),
counts AS (SELECT b, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM n JOIN b USING (f) GROUP BY b),
total AS (SELECT coalesce(sum(s), 0)::DOUBLE + 10000 AS s_all, coalesce(sum(t), 0)::DOUBLE + 10000 AS t_all FROM counts),
g AS (
  SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * s_all / ((coalesce(s, 0) + 1)::DOUBLE * t_all)))::BIGINT AS gain
  FROM counts, total),
v AS (
  SELECT r, sum(n) AS n_features, sum(n * gain) AS weight FROM n JOIN b USING (f) JOIN g USING (b)
  WHERE side = 0 GROUP BY r),
s AS (
  SELECT w.r, doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((
           ('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT
           AS score
  FROM w LEFT JOIN v USING (r) WHERE side = 0),
k AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS k FROM s WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN k <= (SELECT 5 * count(*) // 100 FROM k) THEN k END AS rank
FROM s LEFT JOIN k USING (r)
"""


@_query("op11_importance_resampling", _resample_sql())
def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resample.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@_query("op12_deletion_variants")
def op12_deletion_variants(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


PHRASE_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(string_split_regex(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
g AS (
  SELECT lang, k, i, w[i : i + k - 1] AS w
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS k))),
n AS (SELECT lang, count(*)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, w, array_to_string(w, ' ') AS phrase, count(*)::BIGINT AS f FROM g GROUP BY lang, k, w HAVING count(*) >= 30),
cuts AS (
  SELECT lang, k, w, phrase, f AS a, unnest(range(1, k)) AS cut FROM f WHERE k >= 2),
sided AS (
  SELECT c.*, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.w = c.w[1 : cut] JOIN f y ON y.lang = c.lang AND y.w = c.w[cut + 1 : c.k]),
best AS (
  SELECT * FROM sided QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, cut) = 1),
held AS (
  SELECT lang, sub, max(f) AS f
  FROM (SELECT lang, f, w[i : i + size - 1] AS sub
        FROM (SELECT lang, f, w, size, unnest(range(1, k - size + 2)) AS i
              FROM (SELECT lang, f, w, k, unnest(range(2, k)) AS size FROM f WHERE k >= 3))) GROUP BY lang, sub),
kept AS (
  SELECT b.* FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.sub = b.w
  WHERE NOT coalesce(100::HUGEINT * h.f >= 80::HUGEINT * b.a, false))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""


@_query("op13_phrase_collocations", PHRASE_SQL)
def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))
