"""Document retrieval queries: chunks, allowlist, refresh, similarity and prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.operators import retrieval
from holdfast.plans import valuation as valuation_plans
from holdfast.plans.registry import query
from holdfast.session import work_dir
from holdfast.sources import keyed, market, sinks

# Fixed values
TOP_K = 3
INDEX_BUCKETS = 16
INSTRUCTION = "Answer from the data below only and name the document you used."


def approved(spark, folder):
    return retrieval.approved_documents(
        market.documents(spark, folder), market.document_register(spark, folder)
    )


@query("chunk_documents", "SELECT chunk_id, doc_name, chunk_text FROM chunk")
def chunk_documents(spark, folder):
    return retrieval.chunk_documents(market.documents(spark, folder))


@query("approved_chunks", "SELECT chunk_id, doc_name, chunk_text FROM approved_chunk")
def approved_chunks(spark, folder):
    return retrieval.chunk_documents(approved(spark, folder))


_REFRESHED = "SELECT doc_id FROM documents WHERE lang IN ('de', 'fr')"


@query(
    "chunk_upsert",
    f"""SELECT chunk_id, doc_name,
               CASE WHEN doc_id IN ({_REFRESHED}) THEN replace(chunk_text, 'e', 'E')
                    ELSE chunk_text END AS chunk_text
        FROM approved_chunk""",
)
def chunk_upsert(spark, folder):
    """First index without German; a refresh then brings new German and changed French texts."""
    languages = market.table(spark, folder, "documents").select("doc_id", "lang")
    documents = approved(spark, folder).join(languages, "doc_id")
    first = documents.filter(F.col("lang") != "de")
    refresh = documents.filter(F.col("lang").isin("de", "fr")).withColumn(
        "text", F.replace("text", F.lit("e"), F.lit("E"))
    )
    root = work_dir(spark, "chunks")
    for texts in (first, refresh):
        keyed.merge(spark, root, retrieval.chunk_documents(texts), ["chunk_id"], buckets=INDEX_BUCKETS)
    return keyed.read(spark, root)


@query(
    "chunk_revoke",
    """SELECT chunk_id, doc_name, chunk_text FROM chunk
       WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def chunk_revoke(spark, folder):
    """De-index the restricted documents from an index of everything."""
    documents = market.documents(spark, folder)
    restricted = market.document_register(spark, folder).filter("restricted")
    revoked = documents.join(restricted, "doc_id", "left_semi")
    return retrieval.revoke(retrieval.chunk_documents(documents), revoked)


@query("chunk_coverage", "SELECT doc_name, count(*) AS chunks FROM approved_chunk GROUP BY 1")
def chunk_coverage(spark, folder):
    return retrieval.chunk_coverage(retrieval.chunk_documents(approved(spark, folder)))


@query(
    "chunk_leaks",
    """WITH d AS (
         SELECT doc.doc_name, coalesce(l.toxic = 1, false) AS restricted,
                coalesce(l.quality = 1 AND l.toxic = 0, false) AS allowed,
                doc.doc_name IN (SELECT doc_name FROM chunk) AS present
         FROM doc LEFT JOIN labels l USING (doc_id))
       SELECT doc_name, CASE WHEN present AND restricted THEN 'restricted_indexed'
                             WHEN present AND NOT allowed THEN 'not_approved_indexed'
                             ELSE 'approved_missing' END AS finding
       FROM d WHERE (present AND NOT allowed) OR (NOT present AND allowed)""",
)
def chunk_leaks(spark, folder):
    """Leak test of an index built without the gates."""
    documents = market.documents(spark, folder)
    return retrieval.chunk_leaks(
        retrieval.chunk_documents(documents), documents, market.document_register(spark, folder)
    )


_QUESTIONS = """SELECT label AS question_id, arg_min(embedding, vec_id) AS q, min(vec_id) AS own
                FROM embeddings GROUP BY label"""
_TOP = f"""SELECT question_id, chunk_id, score, rn AS rank FROM (
    SELECT question_id, chunk_id, score, row_number() OVER (
             PARTITION BY question_id ORDER BY score DESC, chunk_id) AS rn
    FROM (SELECT q.question_id, e.vec_id AS chunk_id,
                 round(list_cosine_similarity(q.q::DOUBLE[], e.embedding::DOUBLE[]), 9) AS score
          FROM embeddings e JOIN ({_QUESTIONS}) q ON true
          WHERE e.vec_id IN (SELECT doc_id FROM labels GROUP BY doc_id
                             HAVING bool_or(quality = 1) AND NOT bool_or(toxic = 1))
            AND e.vec_id NOT IN (SELECT min(vec_id) FROM embeddings GROUP BY label)))
    WHERE rn <= {TOP_K}"""


def top(spark, folder):
    """Passages per question: from approved documents only, and never a question itself."""
    questions = market.question_vectors(spark, folder)
    index = retrieval.approved_documents(
        market.chunk_vectors(spark, folder).withColumnRenamed("chunk_id", "doc_id"),
        market.document_register(spark, folder),
    ).withColumnRenamed("doc_id", "chunk_id")
    others = index.join(
        questions.select(F.col("own_chunk_id").alias("chunk_id")), "chunk_id", "left_anti"
    )
    return retrieval.vector_topk(questions, others, TOP_K)


@query(
    "vector_topk",
    f"""SELECT question_id::BIGINT AS question_id, chunk_id, rank::INT AS rank,
               round(score, 6) AS score FROM ({_TOP})""",
)
def vector_topk(spark, folder):
    return top(spark, folder).withColumn("score", F.round("score", 6))


@query(
    "retrieval_hit_at_k",
    f"""SELECT q.question_id::INT AS question_id, count(e.vec_id) AS retrieved,
               count(*) FILTER (e.label = q.question_id) AS hits,
               coalesce(round(CAST(count(*) FILTER (e.label = q.question_id)::DOUBLE
                          / nullif(count(e.vec_id), 0)::DOUBLE AS DECIMAL(28,10)), 4)::DOUBLE, 0.0) AS hit_rate
        FROM ({_QUESTIONS}) q LEFT JOIN ({_TOP}) t USING (question_id)
        LEFT JOIN embeddings e ON e.vec_id = t.chunk_id GROUP BY 1""",
)
def retrieval_hit_at_k(spark, folder):
    return retrieval.hit_at_k(
        top(spark, folder),
        market.question_vectors(spark, folder),
        market.chunk_vectors(spark, folder),
    )


_GOLDEN = f"""WITH best AS (
    SELECT q.question_id, max(round(list_cosine_similarity(q.q::DOUBLE[], e.embedding::DOUBLE[]), 9)) AS score
    FROM embeddings e JOIN ({_QUESTIONS}) q ON true
    WHERE e.vec_id IN (SELECT doc_id FROM labels GROUP BY doc_id
                       HAVING bool_or(quality = 1) AND NOT bool_or(toxic = 1))
      AND e.vec_id NOT IN (SELECT min(vec_id) FROM embeddings GROUP BY label) AND e.label % 3 <> 0 GROUP BY 1),
  golden AS (SELECT question_id, question_id % 3 <> 0 AS expected, question_id % 2 = 0 AS calibrates FROM ({_QUESTIONS})),
  floor AS (SELECT max(score) AS f FROM best JOIN golden USING (question_id) WHERE NOT expected AND calibrates)
  SELECT expected, count(*) AS questions, count(*) FILTER (coalesce(score > f, f IS NULL)) AS found,
         round((count(*) FILTER (expected AND NOT coalesce(score > f, f IS NULL AND score IS NOT NULL)))::DOUBLE / count(*), 4) AS miss_rate,
         round((count(*) FILTER (NOT expected AND coalesce(score > f, f IS NULL AND score IS NOT NULL)))::DOUBLE / count(*), 4)
             AS false_hit_rate
  FROM golden LEFT JOIN best USING (question_id), floor GROUP BY expected"""


@query("golden_misses", _GOLDEN)
def golden_misses(spark, folder):
    """Golden questions of which a third must find nothing: the passages of their topics are not in the index.

    The floor is calibrated on the expected misses with even numbers and judged on all questions.
    """
    questions = market.question_vectors(spark, folder)
    restricted = market.chunk_vectors(spark, folder).filter(F.col("topic") % 3 != 0)
    index = retrieval.approved_documents(
        restricted.withColumnRenamed("chunk_id", "doc_id"), market.document_register(spark, folder)
    ).withColumnRenamed("doc_id", "chunk_id")
    others = index.join(questions.select(F.col("own_chunk_id").alias("chunk_id")), "chunk_id", "left_anti")
    best = retrieval.vector_topk(questions, others, 1)
    path = work_dir(spark, "golden")
    best.write.parquet(path)
    found = spark.read.parquet(path)
    golden = questions.select("question_id", (F.col("question_id") % 3 != 0).alias("expected"))
    floor = retrieval.score_floor(found, golden.filter(F.col("question_id") % 2 == 0)).scalar()
    return retrieval.golden_rates(found, golden, floor)


@query(
    "prompt_context",
    f"""WITH day AS (SELECT * FROM breach WHERE as_of_date = (SELECT max(as_of_date) FROM breach)),
        b AS (SELECT portfolio_id, string_agg(scope_type || ' ' || scope_value || ' breaches '
                     || limit_id, chr(10) ORDER BY limit_id, scope_value) AS txt
              FROM day GROUP BY 1),
        p AS (SELECT t.question_id, string_agg('[' || c.doc_name || '] ' || c.chunk_text, chr(10)
                     ORDER BY t.rank, substr(c.chunk_id, length(c.doc_name) + 2)::INT) AS txt
              FROM ({_TOP}) t JOIN approved_chunk c ON c.doc_id = t.chunk_id GROUP BY 1)
        SELECT q.item_id AS question_id, 'PF_' || q.item_id AS portfolio_id,
               '{INSTRUCTION}' || chr(10) || chr(10) || 'BREACH DATA:' || chr(10)
               || coalesce(b.txt, '') || chr(10) || chr(10) || 'POLICY PASSAGES:' || chr(10)
               || coalesce(p.txt, '') || chr(10) || chr(10) || 'QUESTION: ' || q.text AS prompt
        FROM (SELECT * FROM benchmark WHERE item_id IN (SELECT label FROM embeddings)) q
        LEFT JOIN b ON b.portfolio_id = 'PF_' || q.item_id
        LEFT JOIN p ON p.question_id = q.item_id""",
)
def prompt_context(spark, folder):
    """A prompt per benchmark question that has a vector, about the portfolio of the same number.

    Questions and topics share their numbers. The passages are all chunks, in order, of the approved
    documents found for the question.
    """
    questions = market.table(spark, folder, "benchmark").select(
        F.col("item_id").alias("question_id"),
        F.col("text").alias("question"),
        F.concat(F.lit("PF_"), "item_id").alias("portfolio_id"),
    ).join(market.question_vectors(spark, folder).select("question_id"), "question_id", "left_semi")
    # Written down, as only then its size is known before the texts would be dealt to join it
    found = sinks.written_once(top(spark, folder), work_dir(spark, "prompt-passages"))
    asked = market.documents(spark, folder).join(found.select(F.col("chunk_id").alias("doc_id")), "doc_id", "left_semi")
    allowed = retrieval.approved_documents(asked, market.document_register(spark, folder))
    chunks = retrieval.chunk_documents(allowed)
    line_no = F.substring("chunk_id", F.length("doc_name") + 2, F.length("chunk_id")).cast("int").alias("line_no")
    names = allowed.select(F.col("doc_id").alias("chunk_id"), "doc_name")
    passages = (
        found
        .join(names, "chunk_id")
        .join(chunks.select("doc_name", line_no, "chunk_text"), "doc_name")
        .select("question_id", "rank", "line_no", "doc_name", "chunk_text")
    )
    lines = valuation_plans.newest_breaches(spark, folder).select(
        "portfolio_id",
        "limit_id",
        F.concat("scope_type", F.lit(" "), "scope_value", F.lit(" breaches "), "limit_id").alias(
            "line"
        ),
    )
    return retrieval.prompt_context(questions, passages, lines, INSTRUCTION)
