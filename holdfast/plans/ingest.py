"""Ingest and streaming queries. Inputs are the domain feeds, written out as files first."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.operators import controls, retrieval
from holdfast.plans.history import ASSET_KEY, D1, D2, D3, _STATE1, _next_state, TRACKED
from holdfast.plans.quality import feeds
from holdfast.plans.registry import query
from holdfast.plans.retrieval import approved
from holdfast.session import work_dir
from holdfast.sources import feeds as readers
from holdfast.sources import market, sinks
from holdfast.sources.schemas import SCHEMAS, missing_columns
from holdfast.streaming import ingest as landing
from holdfast.streaming import routing, snapshots

# Fixed values
RUN_TS = "2001-10-31T08:00"
FEED = "investment_transactions"
# Files of one trigger: a backlog is taken, kept and written in batches of this size
MAX_FILES = 16
_COLUMNS = ", ".join(SCHEMAS[FEED].names)


@query(
    "ingest_csv",
    """SELECT portfolio_id, as_of_date, investment_asset_id, quantity,
              NULL::VARCHAR AS _rescued_data FROM holding""",
)
def ingest_csv(spark, folder):
    feed = "investment_holdings_snapshot"
    path = work_dir(spark, "csv")
    market.holdings(spark, folder).select(*SCHEMAS[feed].names).write.option("header", True).csv(
        path
    )
    return readers.read_feed(spark, feed, path)


@query(
    "ingest_stream",
    f"""SELECT {_COLUMNS}, NULL::VARCHAR AS _rescued_data, '{FEED}__{RUN_TS}' AS _batch_id,
               true AS has_ingest_ts, true AS has_source_file FROM txn""",
)
def ingest_stream(spark, folder):
    """Two deliveries and three runs; the last run finds nothing new."""
    root = work_dir(spark, "ingest")
    rows = market.transactions(spark, folder).select(*SCHEMAS[FEED].names)
    early = F.col("transaction_date") < "1999-01-01"
    for delivery in (rows.filter(early), rows.filter(~early)):
        delivery.write.mode("append").json(f"{root}/raw/{FEED}")
        landing.ingest_all(
            spark, f"{root}/raw", f"{root}/tables", f"{root}/checkpoints", RUN_TS, [FEED]
        )
    landing.ingest_all(
        spark, f"{root}/raw", f"{root}/tables", f"{root}/checkpoints", RUN_TS, [FEED]
    )
    stored = spark.read.parquet(f"{root}/tables/raw_{FEED}")
    return stored.select(
        *SCHEMAS[FEED].names,
        "_rescued_data",
        "_batch_id",
        F.col("_ingest_ts").isNotNull().alias("has_ingest_ts"),
        F.col("_source_file").endswith(".json").alias("has_source_file"),
    )


@query(
    "rescue_json",
    f"""SELECT {_COLUMNS},
               CASE WHEN quantity IS NULL THEN '{{"quantity":"n/a"}}' ELSE _rescued_data END
                   AS _rescued_data
        FROM txn""",
)
def rescue_json(spark, folder):
    """Lines with a mistyped quantity and lines with a field the contract does not know."""
    rows = market.transactions(spark, folder)
    good = [F.col(c) for c in SCHEMAS[FEED].names]
    mistyped = [
        F.lit("n/a").alias(c) if c == "quantity" else F.col(c) for c in SCHEMAS[FEED].names
    ]
    fee = F.get_json_object("_rescued_data", "$.fee").alias("fee")
    line = F.when(F.col("quantity").isNull(), F.to_json(F.struct(*mistyped))).otherwise(
        F.to_json(F.struct(*good, fee))
    )
    path = work_dir(spark, "rescue-json")
    rows.select(line.alias("value")).write.text(path)
    return readers.read_feed(spark, FEED, path)


@query(
    "rescue_csv",
    """SELECT portfolio_id, as_of_date, investment_asset_id,
              CASE WHEN quantity >= 49 THEN NULL ELSE quantity END AS quantity,
              CASE WHEN quantity >= 49
                   THEN portfolio_id || ',' || as_of_date || ',' || investment_asset_id || ',n/a'
                   WHEN quantity <= 2
                   THEN portfolio_id || ',' || as_of_date || ',' || investment_asset_id || ','
                        || quantity::VARCHAR || ',extra' END AS _rescued_data
       FROM holding""",
)
def rescue_csv(spark, folder):
    """Large quantities arrive as text, small ones with a column too many."""
    feed = "investment_holdings_snapshot"
    quantity = F.col("quantity")
    amount = F.when(quantity >= 49, "n/a").otherwise(quantity.cast("string"))
    extra = F.when(quantity <= 2, "extra")
    line = F.concat_ws(",", "portfolio_id", "as_of_date", "investment_asset_id", amount, extra)
    path = work_dir(spark, "rescue-csv")
    market.holdings(spark, folder).select(line.alias("value")).write.text(path)
    return readers.read_feed(spark, feed, path, header=False)


@query(
    "rescue_csv_header",
    """SELECT portfolio_id, CASE WHEN quantity >= 40 THEN NULL ELSE as_of_date END AS as_of_date,
              investment_asset_id, CASE WHEN quantity >= 45 THEN NULL ELSE quantity END AS quantity,
              CASE WHEN quantity >= 45 THEN '{"quantity":"n/a"}'
                   WHEN quantity <= 2 THEN '{"note":"small"}' END AS _rescued_data
       FROM holding""",
)
def rescue_csv_header(spark, folder):
    """Files with columns in other orders, one too many, one missing, and mistyped values."""
    feed, path = "investment_holdings_snapshot", work_dir(spark, "rescue-csv-header")
    rows = sinks.written_once(market.holdings(spark, folder), work_dir(spark, "rescue-csv-holdings"))
    quantity = F.col("quantity")
    amount = F.when(quantity >= 45, "n/a").otherwise(quantity.cast("string")).alias("quantity")
    orders = (
        (quantity <= 2, ["investment_asset_id", F.lit("small").alias("note"), amount, "portfolio_id", "as_of_date"]),
        ((quantity > 2) & (quantity < 40), ["as_of_date", "portfolio_id", "investment_asset_id", amount]),
        (quantity >= 40, [amount, "portfolio_id", "investment_asset_id"]),
    )
    for chosen, columns in orders:
        rows.filter(chosen).select(*columns).write.mode("append").option("header", True).csv(path)
    return readers.read_feed(spark, feed, path)


@query(
    "ingest_csv_stream",
    f"""SELECT portfolio_id, CASE WHEN quantity >= 40 THEN NULL ELSE as_of_date END AS as_of_date,
              investment_asset_id, quantity,
              CASE WHEN quantity <= 2 THEN '{{"note":"small"}}' END AS _rescued_data,
              'investment_holdings_snapshot__{RUN_TS}' AS _batch_id, true AS has_source_file FROM holding""",
)
def ingest_csv_stream(spark, folder):
    """Three deliveries of other columns and orders, each landed by a run of its own; a fourth run finds nothing."""
    feed, root = "investment_holdings_snapshot", work_dir(spark, "ingest-csv")
    rows, quantity = market.holdings(spark, folder), F.col("quantity")
    deliveries = (
        (quantity <= 2, ["investment_asset_id", F.lit("small").alias("note"), "quantity", "portfolio_id", "as_of_date"]),
        ((quantity > 2) & (quantity < 40), ["as_of_date", "portfolio_id", "investment_asset_id", "quantity"]),
        (quantity >= 40, ["quantity", "portfolio_id", "investment_asset_id"]),
        (F.lit(False), ["quantity"]),
    )
    for chosen, columns in deliveries:
        rows.filter(chosen).select(*columns).write.mode("append").option("header", True).csv(f"{root}/raw/{feed}")
        landing.ingest_all(spark, f"{root}/raw", f"{root}/tables", f"{root}/checkpoints", RUN_TS, [feed])
    return landing.landed(spark, feed, f"{root}/tables").select(
        *SCHEMAS[feed].names, "_rescued_data", "_batch_id", F.col("_source_file").endswith(".csv").alias("has_source_file")
    )


@query(
    "audit_columns",
    f"""SELECT transaction_id, '{FEED}.json' AS _source_file,
               '{FEED}__{RUN_TS}' AS _batch_id, true AS has_ingest_ts FROM txn""",
)
def audit_columns(spark, folder):
    rows = market.transactions(spark, folder).select("transaction_id")
    audited = readers.with_audit(rows, f"{FEED}.json", readers.batch_id(FEED, RUN_TS))
    return audited.select(
        "transaction_id", "_source_file", "_batch_id",
        F.col("_ingest_ts").isNotNull().alias("has_ingest_ts"),
    )


@query(
    "missing_columns",
    """SELECT 'counterparty_master' AS feed, unnest(['type', 'risk_category', 'country'])
                  AS missing_column, count(*) AS affected_rows FROM counterparty""",
)
def missing_columns_report(spark, folder):
    """Contract columns that a delivered feed lacks, with the rows it affects."""
    report = None
    for name, df in feeds(spark, folder).items():
        lacking = missing_columns(df.columns, SCHEMAS[name].names)
        if lacking:
            rows = df.agg(F.count("*").alias("affected_rows")).select(
                F.lit(name).alias("feed"),
                F.explode(F.array(*[F.lit(c) for c in lacking])).alias("missing_column"),
                "affected_rows",
            )
            report = rows if report is None else report.unionByName(rows)
    return report


def _transaction_stream(spark, folder, root):
    rows = market.transactions(spark, folder)
    rows.write.parquet(f"{root}/landed")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", MAX_FILES).parquet(f"{root}/landed")


def _flagged_stream(spark, folder, root):
    return routing.flag_stream(
        _transaction_stream(spark, folder, root),
        market.portfolios(spark, folder),
        market.assets(spark, folder),
    )


_STREAM_REASON = """nullif(concat_ws('; ',
    CASE WHEN investment_asset_id NOT IN (SELECT investment_asset_id FROM asset)
         THEN 'bad_asset' END,
    CASE WHEN portfolio_id NOT IN (SELECT portfolio_id FROM portfolio) THEN 'bad_portfolio' END,
    CASE WHEN quantity IS NULL OR quantity <= 0 THEN 'bad_quantity' END,
    CASE WHEN transaction_type IS NULL OR transaction_type NOT IN
              ('BUY', 'SELL', 'ACQUISITION', 'DISPOSAL') THEN 'bad_type' END,
    CASE WHEN _rescued_data IS NOT NULL THEN 'schema_drift' END), '')"""


@query(
    "stream_fk_check",
    f"SELECT transaction_id, portfolio_id, {_STREAM_REASON} AS _dq_reason FROM txn",
)
def stream_fk_check(spark, folder):
    root = work_dir(spark, "stream-fk")
    landing.drain(_flagged_stream(spark, folder, root), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").select("transaction_id", "portfolio_id", "_dq_reason")


@query(
    "stream_split",
    f"""SELECT transaction_id, CASE WHEN r IS NULL THEN 'silver' ELSE 'quarantine' END AS route,
               r AS quarantine_reason
        FROM (SELECT transaction_id, {_STREAM_REASON} AS r FROM txn)""",
)
def stream_split(spark, folder):
    root = work_dir(spark, "stream-split")
    routing.route(_flagged_stream(spark, folder, root), f"{root}/tables", f"{root}/checkpoint")
    silver = spark.read.parquet(f"{root}/tables/silver").select(
        "transaction_id", F.lit("silver").alias("route"),
        F.lit(None).cast("string").alias("quarantine_reason"),
    )
    bad = spark.read.parquet(f"{root}/tables/quarantine").select(
        "transaction_id", F.lit("quarantine").alias("route"), "quarantine_reason"
    )
    return silver.unionByName(bad)


@query(
    "expectation_counts",
    f"""SELECT 'has_transaction_id' AS expectation, 'FAIL' AS tier, count(*) AS failed_rows
        FROM txn WHERE transaction_id IS NULL OR transaction_id = ''
        UNION ALL
        SELECT 'has_counterparty', 'WARN', count(*) FROM txn
        WHERE counterparty_id IS NULL AND {_STREAM_REASON} IS NULL""",
)
def expectation_counts(spark, folder):
    root = work_dir(spark, "expectations")
    routing.route(_flagged_stream(spark, folder, root), f"{root}/tables", f"{root}/checkpoint")
    return routing.expectation_counts(spark.read.parquet(f"{root}/tables/expectations"))


@query("stream_dedupe", "SELECT DISTINCT transaction_id FROM txn")
def stream_dedupe(spark, folder):
    """Ids after deduplication against all that landed before, in two runs; nothing is remembered in memory."""
    root = work_dir(spark, "stream-dedupe")
    rows = market.transactions(spark, folder).select("transaction_id", "_ingest_ts")
    once = None
    for part in (F.col("transaction_id") < "T5", ~(F.col("transaction_id") < "T5") | F.col("transaction_id").isNull()):
        rows.filter(part | F.col("transaction_id").endswith("0")).write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", MAX_FILES).parquet(f"{root}/landed")
        once = routing.dedupe_by_table(stream, "transaction_id", f"{root}/once", f"{root}/checkpoint", buckets=16)
    return once.select("transaction_id")


@query(
    "scd2_stream",
    f"""WITH state1 AS ({_STATE1}), state2 AS ({_next_state("state1", "snap2", D2, True)})
        {_next_state("state2", "snap3", D3, True)}""",
)
def scd2_stream(spark, folder):
    """The three snapshots arrive as files: the last and the first before one run, the late second before another."""
    root = work_dir(spark, "scd2-stream")
    for run in ((3, 1), (2,)):
        for version in run:
            rows = market.asset_snapshot(spark, folder, version).withColumn(
                "snapshot_date", F.lit((D1, D2, D3)[version - 1])
            )
            rows.write.mode("append").parquet(f"{root}/snapshots")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/snapshots")
        versions = snapshots.history_stream(
            stream, "snapshot_date", ASSET_KEY, TRACKED, f"{root}/dim", f"{root}/checkpoint", buckets=16
        )
    return versions


@query("chunk_refresh_stream", "SELECT chunk_id, doc_name, chunk_text FROM approved_chunk")
def chunk_refresh_stream(spark, folder):
    """Approved documents arrive in three deliveries; each is chunked and merged by a run of its own.

    A delivery has as many files as tasks wrote it, and a run takes them all as one micro-batch.
    """
    root = work_dir(spark, "chunk-stream")
    documents, chunks = approved(spark, folder), None
    for turn in range(3):
        documents.filter(F.pmod("doc_id", F.lit(3)) == turn).write.mode("append").parquet(f"{root}/documents")
        stream = spark.readStream.schema(documents.schema).parquet(f"{root}/documents")
        chunks = snapshots.merge_stream(
            retrieval.chunk_documents(stream), ["chunk_id"], f"{root}/chunks", f"{root}/checkpoint", buckets=16
        )
    return chunks


@query(
    "event_log_failures",
    """SELECT 'has_counterparty' AS expectation, sum((props->>'$.k')::BIGINT)::BIGINT
                  AS failed_records FROM events WHERE event_type = 'view'
       UNION ALL
       SELECT 'valid_quantity', sum(floor(value)::BIGINT)::BIGINT FROM events
       WHERE event_type = 'view'""",
)
def event_log_failures(spark, folder):
    details = F.format_string(
        '{"flow_progress":{"data_quality":{"expectations":['
        '{"name":"has_counterparty","failed_records":%s},'
        '{"name":"valid_quantity","failed_records":%s}]}}}',
        F.get_json_object("props", "$.k"),
        F.floor("value").cast("string"),
    )
    log = market.table(spark, folder, "events").select(
        F.when(F.col("event_type") == "view", "flow_progress")
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        details.alias("details"),
    )
    return controls.event_log_failures(log)
