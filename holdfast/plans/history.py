"""History queries: upserts, slice replacement, SCD2, snapshot changes, compaction."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.operators import history, valuation
from holdfast.operators.keys import dedupe_latest
from holdfast.plans import valuation as valuation_plans
from holdfast.plans.registry import query
from holdfast.session import work_dir
from holdfast.sources import keyed, market, sinks, tables

# Where the landed data is cut into a first load and a later batch
BATCH_CUT = "1999-01-01 00:00:00"
CORRECTION_FROM = "2000-01-01"
UPSERT_BUCKETS = 16
UPSERT_RATIO = 2.0
TRACKED = ("sector", "issuer_id", "asset_type", "name")
ASSET_KEY = ("investment_asset_id",)
D1, D2, D3 = market.SNAPSHOT_DATES

_ORDER = """ORDER BY _ingest_ts DESC NULLS LAST, transaction_date DESC NULLS LAST,
    portfolio_id DESC NULLS LAST, investment_asset_id DESC NULLS LAST,
    transaction_type DESC NULLS LAST, quantity DESC NULLS LAST, price DESC NULLS LAST,
    counterparty_id DESC NULLS LAST, _rescued_data DESC NULLS LAST"""


@query(
    "upsert",
    f"""WITH first_load AS (
          SELECT * FROM txn WHERE _ingest_ts < TIMESTAMP '{BATCH_CUT}'
          QUALIFY row_number() OVER (PARTITION BY transaction_id {_ORDER}) = 1),
        batch AS (
          SELECT * FROM txn WHERE _ingest_ts >= TIMESTAMP '{BATCH_CUT}'
          QUALIFY row_number() OVER (PARTITION BY transaction_id {_ORDER}) = 1)
        SELECT * FROM batch
        UNION ALL
        SELECT * FROM first_load
        WHERE transaction_id NOT IN (SELECT transaction_id FROM batch)""",
)
def upsert(spark, folder):
    """Create from the first load, upsert the later batch, upsert it again: same table.

    The batch is worked out once for both upserts. As the table is read once, its deltas are merged by that read.
    """
    landed = market.transactions(spark, folder)
    cut = F.lit(BATCH_CUT).cast("timestamp_ntz")
    key = ["transaction_id"]
    first = dedupe_latest(landed.filter(F.col("_ingest_ts") < cut), key, "_ingest_ts")
    batch = dedupe_latest(landed.filter(F.col("_ingest_ts") >= cut), key, "_ingest_ts")
    batch = sinks.written_once(batch, work_dir(spark, "upsert-batch"))
    root = work_dir(spark, "upsert")
    for rows in (first, batch, batch):
        keyed.apply(spark, root, rows, key, buckets=UPSERT_BUCKETS, ratio=UPSERT_RATIO, spread=True)
    return keyed.read(spark, root)


@query(
    "upsert_composite",
    f"""SELECT portfolio_id, investment_asset_id,
               CASE WHEN sector = 'PROMO' AND as_of_date >= '{CORRECTION_FROM}'
                    THEN quantity * 2 ELSE quantity END AS quantity,
               close_price, sector, issuer_id,
               (CASE WHEN sector = 'PROMO' AND as_of_date >= '{CORRECTION_FROM}'
                     THEN market_value * 2 ELSE market_value END)::DOUBLE AS market_value,
               as_of_date
        FROM fact""",
)
def upsert_composite(spark, folder):
    """Corrected holdings are merged by (portfolio, date, asset); other dates stay untouched."""
    fact = valuation_plans.fact(spark, folder).withColumn(
        "market_value", F.col("market_value").cast("decimal(28,8)")
    )
    # The first load, its corrections and the merge all read it
    fact = sinks.written_once(fact, work_dir(spark, "upsert-composite-fact"))
    corrected = (
        fact.filter(F.col("sector") == "PROMO")
        .filter(F.col("as_of_date") >= CORRECTION_FROM)
        .withColumn("quantity", F.col("quantity") * 2)
        .withColumn("market_value", (F.col("market_value") * 2).cast("decimal(28,8)"))
    )
    keys = ["portfolio_id", "as_of_date", "investment_asset_id"]
    path = work_dir(spark, "upsert-composite")
    history.upsert_partitions(spark, fact, path, keys, "as_of_date")
    history.upsert_partitions(spark, corrected, path, keys, "as_of_date")
    return spark.read.schema(fact.schema).parquet(path)


@query(
    "append_merge",
    f"""SELECT transaction_id, portfolio_id, quantity,
               CASE WHEN _ingest_ts >= TIMESTAMP '{BATCH_CUT}' THEN transaction_type END AS transaction_type
        FROM txn WHERE quantity IS NOT NULL""",
)
def append_merge(spark, folder):
    """Two runs: the second brings a column more, in another order, and quantities of a wider type."""
    landed = market.transactions(spark, folder).filter(F.col("quantity").isNotNull())
    early = F.col("_ingest_ts") < F.lit(BATCH_CUT).cast("timestamp_ntz")
    path = work_dir(spark, "append-merge")
    first = landed.filter(early).select("transaction_id", "portfolio_id", F.col("quantity").cast("int").alias("quantity"))
    tables.append_merge(spark, first, path)
    tables.append_merge(spark, landed.filter(~early).select("transaction_type", "quantity", "transaction_id", "portfolio_id"), path)
    return tables.read_merged(spark, path)


@query(
    "holding_slice",
    """SELECT portfolio_id, as_of_date, investment_asset_id, quantity FROM holding
       WHERE as_of_date = (SELECT max(as_of_date) FROM holding WHERE portfolio_id = (SELECT min(portfolio_id) FROM holding))
         AND portfolio_id = (SELECT min(portfolio_id) FROM holding)""",
)
def holding_slice(spark, folder):
    """The last date of the first portfolio, from a table laid out by portfolio and date."""
    rows, path = market.holdings(spark, folder), work_dir(spark, "holding-slice")
    tables.create_clustered(spark, rows, path, ["portfolio_id", "as_of_date"], 64)
    stored = spark.read.schema(rows.schema).parquet(path)
    first = stored.agg(F.min("portfolio_id")).first()[0]
    own = tables.read_clustered(spark, path, rows.schema, portfolio_id=first)
    last = own.agg(F.max("as_of_date")).first()[0]
    return tables.read_clustered(spark, path, rows.schema, portfolio_id=first, as_of_date=last)


@query(
    "replace_slice",
    """SELECT portfolio_id, sector, exposure_pct, as_of_date FROM expo
       WHERE as_of_date <> (SELECT min(as_of_date) FROM expo)""",
)
def replace_slice(spark, folder):
    """Backfill of the last date (same rows) and a rerun of the first that finds no rows."""
    exposures = valuation.exposure(valuation_plans.fact(spark, folder)).select(
        "portfolio_id", "sector", "exposure_pct", "as_of_date"
    )
    path = work_dir(spark, "replace-slice")
    sinks.overwrite(exposures, path, ["as_of_date"])
    stored = spark.read.schema(exposures.schema).parquet(path)
    ends = stored.agg(F.min("as_of_date").alias("a"), F.max("as_of_date").alias("z")).first()
    sinks.replace_slice(exposures, path, "as_of_date", ends.z, "portfolio_id")
    sinks.replace_slice(exposures.filter("false"), path, "as_of_date", ends.a, "portfolio_id")
    return spark.read.schema(exposures.schema).parquet(path)


def _next_state(state: str, snapshot: str, date: str, close_missing: bool) -> str:
    """One step of the dimension as SQL: close what changed, then add what is new."""
    changed = " OR ".join(f"s.{c} IS DISTINCT FROM n.{c}" for c in TRACKED)
    gone = "n.investment_asset_id IS NULL" if close_missing else "false"
    ends = f"s.is_current AND ({gone} OR (n.investment_asset_id IS NOT NULL AND ({changed})))"
    same = " AND ".join(f"s.{c} IS NOT DISTINCT FROM n.{c}" for c in TRACKED)
    return f"""
      SELECT s.investment_asset_id, s.name, s.asset_type, s.issuer_id, s.sector, s.effective_from,
             CASE WHEN {ends} THEN DATE '{date}' ELSE s.effective_to END AS effective_to,
             s.is_current AND NOT ({ends}) AS is_current
      FROM {state} s LEFT JOIN {snapshot} n ON n.investment_asset_id = s.investment_asset_id
      UNION ALL
      SELECT n.investment_asset_id, n.name, n.asset_type, n.issuer_id, n.sector, DATE '{date}',
             DATE '9999-12-31', true
      FROM {snapshot} n WHERE NOT EXISTS (
        SELECT 1 FROM {state} s WHERE s.is_current
           AND s.investment_asset_id = n.investment_asset_id AND {same})"""


_STATE1 = f"""SELECT investment_asset_id, name, asset_type, issuer_id, sector,
    DATE '{D1}' AS effective_from, DATE '9999-12-31' AS effective_to, true AS is_current
    FROM snap1"""


@query("scd2_initial", _STATE1)
def scd2_initial(spark, folder):
    return history.scd2_initial(market.asset_snapshot(spark, folder, 1), D1)


@query(
    "scd2_apply",
    f"""WITH state1 AS ({_STATE1}), state2 AS ({_next_state("state1", "snap2", D2, False)})
        {_next_state("state2", "snap3", D3, False)}""",
)
def scd2_apply(spark, folder):
    """Two batches in a row; keys that a batch does not carry stay current."""
    state = history.scd2_initial(market.asset_snapshot(spark, folder, 1), D1)
    for version, date in ((2, D2), (3, D3)):
        batch = market.asset_snapshot(spark, folder, version)
        state = history.scd2_apply(state, batch, ASSET_KEY, TRACKED, date)
    return state


@query(
    "scd2_snapshots",
    f"""WITH state1 AS ({_STATE1}), state2 AS ({_next_state("state1", "snap2", D2, True)})
        {_next_state("state2", "snap3", D3, True)}""",
)
def scd2_snapshots(spark, folder):
    """The same three snapshots as full snapshots: an omitted key is closed."""
    dated = None
    for version, date in enumerate(market.SNAPSHOT_DATES, start=1):
        rows = market.asset_snapshot(spark, folder, version).withColumn(
            "snapshot_date", F.lit(date)
        )
        dated = rows if dated is None else dated.unionByName(rows)
    return history.scd2_from_snapshots(dated, "snapshot_date", ASSET_KEY, TRACKED)


@query(
    "snapshot_changes",
    """SELECT coalesce(o.investment_asset_id, n.investment_asset_id) AS investment_asset_id,
              CASE WHEN o.investment_asset_id IS NULL THEN 'insert'
                   WHEN n.investment_asset_id IS NULL THEN 'delete' ELSE 'update' END
                  AS change_type
       FROM snap1 o FULL JOIN snap2 n ON o.investment_asset_id = n.investment_asset_id
       WHERE o.investment_asset_id IS NULL OR n.investment_asset_id IS NULL
          OR o.name IS DISTINCT FROM n.name OR o.asset_type IS DISTINCT FROM n.asset_type
          OR o.issuer_id IS DISTINCT FROM n.issuer_id OR o.sector IS DISTINCT FROM n.sector""",
)
def snapshot_changes(spark, folder):
    return history.snapshot_changes(
        market.asset_snapshot(spark, folder, 1), market.asset_snapshot(spark, folder, 2), ASSET_KEY
    )


# Target file size of the compaction query
COMPACT_BYTES = 1 << 20
_CONTENT = """count(*) AS row_count, count(DISTINCT investment_asset_id) AS assets,
              sum(close_price::DECIMAL(18,4))::DOUBLE AS price_sum"""


@query(
    "compact",
    f"""SELECT 'before' AS table_version, {_CONTENT}, true AS within_target FROM price
        UNION ALL SELECT 'after', {_CONTENT}, true FROM price""",
)
def compact(spark, folder):
    """Content before and after rewriting the prices into sorted files of a target size."""
    prices = market.prices(spark, folder)
    root = work_dir(spark, "compact")
    for year in ("A", "B"):
        first_half = F.col("price_date") < "1998-07-01"
        sinks.append(prices.filter(first_half if year == "A" else ~first_half), f"{root}/raw")
    most = 1 + sinks.stored_bytes(spark, f"{root}/raw") // COMPACT_BYTES
    sinks.compact(spark, f"{root}/raw", f"{root}/compacted", "investment_asset_id", COMPACT_BYTES)

    def summary(label, path):
        stored = spark.read.parquet(path)
        few = F.count_distinct("_metadata.file_path") <= most
        return stored.agg(
            F.count("*").alias("row_count"),
            F.count_distinct("investment_asset_id").alias("assets"),
            F.sum(F.col("close_price").cast("decimal(18,4)")).cast("double").alias("price_sum"),
            (few if label == "after" else F.lit(True)).alias("within_target"),
        ).select(F.lit(label).alias("table_version"), "row_count", "assets", "price_sum", "within_target")

    return summary("before", f"{root}/raw").unionByName(summary("after", f"{root}/compacted"))
