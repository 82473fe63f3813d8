"""Domain feeds derived from the warehouse tables.

Every function reads whole tables and returns one feed of the data model as a lazy
DataFrame. Defects that the controls must find (unknown keys, missing prices, bad types,
NULLs, duplicates, drift) come from ordinary column values of the source rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.exact import exact_count_and_sum, rounded


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _id(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column))


def _day(column: str) -> Column:
    return F.col(column).cast("date").cast("string")


def _month_end(column: str) -> Column:
    return F.last_day(F.col(column).cast("date")).cast("string")


# ---- transactions -----------------------------------------------------------------


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Landed transactions with audit columns: repeated ids, NULLs, bad types, drift."""
    tax, discount = F.col("l_tax"), F.col("l_discount")
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        _day("l_shipdate").alias("transaction_date"),
        _id("PF_", "l_suppkey").alias("portfolio_id"),
        _id("AS_", "l_partkey").alias("investment_asset_id"),
        F.when(tax == 0.08, "WUT")
        .when(discount == 0.0, F.lit(None).cast("string"))
        .when(F.col("l_returnflag") == "A", "BUY")
        .when(F.col("l_returnflag") == "N", "SELL")
        .when(F.col("l_linestatus") == "F", "ACQUISITION")
        .otherwise("DISPOSAL")
        .alias("transaction_type"),
        F.when(discount != 0.1, F.col("l_quantity") - 2).alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.when(tax != 0.0, _id("CP_", "l_linenumber")).alias("counterparty_id"),
        F.col("l_shipdate").alias("_ingest_ts"),
        F.lit("investment_transactions.json").alias("_source_file"),
        F.concat(F.lit("investment_transactions__"), _day("l_shipdate")).alias("_batch_id"),
        F.when(
            (tax == 0.07) & (discount == 0.07),
            F.concat(F.lit('{"fee":"'), F.col("l_linenumber"), F.lit('"}')),
        ).alias("_rescued_data"),
    )


# ---- reference data ---------------------------------------------------------------


def portfolios(spark: SparkSession, folder: str) -> DataFrame:
    """Portfolio master: suppliers in credit; the others are unknown portfolios."""
    nation = F.col("s_nationkey")
    return (
        table(spark, folder, "supplier")
        .filter(F.col("s_acctbal") >= 0)
        .select(
            _id("PF_", "s_suppkey").alias("portfolio_id"),
            F.col("s_name").alias("portfolio_name"),
            F.concat(F.lit("pm"), nation).alias("manager"),
            F.when(F.col("s_acctbal") > 5000, "Growth").otherwise("Income").alias("mandate"),
            F.when(nation < 8, "USD").when(nation < 16, "AED").when(nation < 24, "EUR")
            .alias("base_currency"),
        )
    )


def assets(spark: SparkSession, folder: str) -> DataFrame:
    """Asset master: parts below the largest size; the others are unknown assets."""
    return named(asset_rows(spark, folder))


def asset_rows(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`assets` by the number that the id stands for."""
    size = F.col("p_size")
    listed = size <= 35
    return (
        table(spark, folder, "part")
        .filter(size < 50)
        .select(
            F.col("p_partkey").alias("investment_asset_id"),
            F.col("p_name").alias("name"),
            F.when(size <= 25, "LISTED_EQUITY").when(listed, "LISTED_BOND")
            .when(size <= 42, "FUND").otherwise("PRIVATE_COMPANY").alias("asset_type"),
            F.when(listed, _id("IS", "p_partkey")).alias("isin"),
            F.when(listed, _id("T", "p_partkey")).alias("ticker"),
            F.when(~listed, _id("INT-", "p_partkey")).alias("internal_investment_code"),
            F.col("p_brand").alias("issuer_id"),
            F.col("p_type").alias("sector"),
            F.when(size <= 20, "AE").otherwise("US").alias("country"),
            F.when(size <= 20, "AED").otherwise("USD").alias("currency"),
        )
    )


def counterparties(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "nation")
        .filter(F.col("n_regionkey") != 4)
        .select(
            _id("CP_", "n_nationkey").alias("counterparty_id"),
            F.col("n_name").alias("name"),
        )
    )


def limits(spark: SparkSession, folder: str) -> DataFrame:
    """Limits per sector, issuer, portfolio and counterparty.

    "All portfolios" is written both as ``ALL`` and as NULL, and one scope is in lower case,
    because feeds carry all of these forms.
    """
    part = table(spark, folder, "part")
    sector = part.select("p_type").distinct().select(
        _id("LIM_S_", "p_type").alias("limit_id"),
        F.lit("SECTOR").alias("scope_type"),
        F.col("p_type").alias("scope_value"),
        F.lit("ALL").alias("portfolio_id"),
        F.lit(40.0).alias("max_pct"),
    )
    issuer = part.select("p_brand").distinct().select(
        _id("LIM_I_", "p_brand").alias("limit_id"),
        F.lit("ISSUER").alias("scope_type"),
        F.col("p_brand").alias("scope_value"),
        F.lit(None).cast("string").alias("portfolio_id"),
        F.lit(35.0).alias("max_pct"),
    )
    own = (
        table(spark, folder, "supplier")
        .filter(F.col("s_acctbal") > 5000)
        .select(
            _id("LIM_P_", "s_suppkey").alias("limit_id"),
            F.lit("sector").alias("scope_type"),
            F.lit("PROMO").alias("scope_value"),
            _id("PF_", "s_suppkey").alias("portfolio_id"),
            F.lit(20.0).alias("max_pct"),
        )
    )
    counterparty = table(spark, folder, "nation").select(
        _id("LIM_C_", "n_nationkey").alias("limit_id"),
        F.lit("COUNTERPARTY").alias("scope_type"),
        _id("CP_", "n_nationkey").alias("scope_value"),
        F.lit("ALL").alias("portfolio_id"),
        F.lit(15.0).alias("max_pct"),
    )
    return sector.unionByName(issuer).unionByName(own).unionByName(counterparty)


def asset_snapshot(spark: SparkSession, folder: str, version: int) -> DataFrame:
    """Dated full snapshots of the asset master with inserts, changes, NULLs and absences."""
    part = table(spark, folder, "part")
    brand = F.col("p_brand")
    sector = F.col("p_type")
    if version == 1:
        part = part.filter(F.col("p_size") < 45)
    elif version == 2:
        part = part.filter(brand != "Brand#13")
        sector = (
            F.when(brand == "Brand#7", F.concat(sector, F.lit("_NEW")))
            .when(brand != "Brand#11", sector)
        )
    else:
        part = part.filter(brand != "Brand#5")
        sector = F.when(brand == "Brand#7", F.concat(sector, F.lit("_NEW"))).otherwise(sector)
    return part.select(
        _id("AS_", "p_partkey").alias("investment_asset_id"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") <= 25, "LISTED_EQUITY").otherwise("LISTED_BOND").alias("asset_type"),
        brand.alias("issuer_id"),
        sector.alias("sector"),
    )


# Dates on which the three snapshots arrive
SNAPSHOT_DATES = ("2024-01-31", "2024-02-29", "2024-03-31")


# ---- valuation data ---------------------------------------------------------------


_ID_PREFIXES = {"portfolio_id": "PF_", "investment_asset_id": "AS_"}


def named(rows: DataFrame) -> DataFrame:
    """Rows with the ids and dates of the feeds in place of the numbers and days they stand for."""
    texts = {c: _id(prefix, c) for c, prefix in _ID_PREFIXES.items()}
    texts |= {c: F.col(c).cast("string") for c in ("as_of_date", "price_date")}
    return rows.select(*[texts[c].alias(c) if c in texts else F.col(c) for c in rows.columns])


def _month(column: str) -> Column:
    return F.last_day(F.col(column).cast("date"))


def _exact_sum(column: str) -> Column:
    """Sum of a column as ``decimal(18,2)``, exact, as double."""
    return exact_count_and_sum(F.col(column), 2)[1].cast("double")


def holdings(spark: SparkSession, folder: str) -> DataFrame:
    """Month-end holdings, one row per portfolio, date and asset."""
    return named(holding_rows(spark, folder))


def holding_rows(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`holdings` by numbers and days: grouped and joined so, and named afterwards."""
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", _month("l_shipdate").alias("day"), "l_partkey")
        .agg(F.sum("l_quantity").alias("quantity"))
        .select(
            F.col("l_suppkey").alias("portfolio_id"),
            F.col("day").alias("as_of_date"),
            F.col("l_partkey").alias("investment_asset_id"),
            "quantity",
        )
    )


def prices(spark: SparkSession, folder: str) -> DataFrame:
    """Month-end prices: mean traded price; assets traded only in the top tax band have none."""
    return named(price_rows(spark, folder))


def price_rows(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`prices` by numbers and days."""
    return (
        table(spark, folder, "lineitem")
        .filter(F.col("l_tax") != 0.08)
        .groupBy(F.col("l_partkey").alias("investment_asset_id"), _month("l_shipdate").alias("price_date"))
        .agg((_exact_sum("l_extendedprice") / F.sum("l_quantity")).alias("mean_price"))
        .select("price_date", "investment_asset_id", rounded(F.col("mean_price"), 4).alias("close_price"))
    )


def currency_rates(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    # Rates to the base currency
    return (
        table(spark, folder, "orders")
        .select(_month_end("o_orderdate").alias("rate_date"), status)
        .distinct()
        .select(
            "rate_date",
            F.when(status == "F", "AED").when(status == "O", "USD").otherwise("EUR")
            .alias("currency"),
            F.when(status == "F", 0.2723).when(status == "O", 1.0).otherwise(1.08)
            .alias("rate_to_base"),
        )
    )


def private_valuations(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        _id("PE_", "o_custkey").alias("investment_asset_id"),
        _day("o_orderdate").alias("valuation_date"),
        F.col("o_totalprice").alias("fair_value"),
        F.when(F.col("o_orderstatus") == "F", "AED").otherwise("USD").alias("currency"),
    )


def fund_navs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        _id("FUND_", "user_id").alias("investment_asset_id"),
        _day("ts").alias("nav_date"),
        F.col("value").alias("nav_per_unit"),
        F.when(F.col("event_type") == "view", "AED").otherwise("USD").alias("currency"),
    )


# ---- governance and operations ----------------------------------------------------


def result_log(spark: SparkSession, folder: str) -> DataFrame:
    """Result log of controls: one executed check per event."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("ts").alias("check_timestamp"),
        F.when(kind == "error", "bronze_rescued_rows_count")
        .when(kind == "purchase", "transaction_quarantine_rate_pct")
        .when(kind == "signup", "assets_missing_latest_price")
        .when(kind == "click", "transaction_freshness_minutes")
        .otherwise("limit_breach_count")
        .alias("check_name"),
        _id("feed_", "user_id").alias("source_table"),
        F.col("ts").cast("date").alias("business_date"),
        F.concat(F.lit("run_"), _day("ts")).alias("pipeline_run_id"),
        _id("job_", "event_id").alias("job_run_id"),
        F.col("value").alias("metric_value"),
        F.lit(50.0).alias("threshold"),
        (F.col("value") <= 50.0).alias("passed"),
    )


def job_runs(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.lit("ws_1").alias("workspace_id"),
        F.col("user_id").alias("job_id"),
        F.col("event_id").alias("run_id"),
        F.when(kind == "error", "FAILED").when(kind == "view", "TIMED_OUT")
        .otherwise("SUCCEEDED").alias("result_state"),
        F.col("ts").alias("period_start_time"),
        F.when(
            kind != "signup",
            F.expr("timestampadd(SECOND, cast(floor(value) AS int), ts)"),
        ).alias("period_end_time"),
    )


def jobs(spark: SparkSession, folder: str) -> DataFrame:
    """Job register; runs of jobs that are not in it fall back to their id."""
    return (
        table(spark, folder, "customer")
        .filter(F.col("c_mktsegment").isin("MACHINERY", "BUILDING", "HOUSEHOLD"))
        .select(
            F.lit("ws_1").alias("workspace_id"),
            F.col("c_custkey").alias("job_id"),
            F.col("c_name").alias("name"),
        )
    )


def _sku() -> Column:
    flag = F.col("l_returnflag")
    return F.concat(
        F.when(flag == "A", "JOBS_COMPUTE").when(flag == "N", "SERVERLESS_SQL")
        .otherwise("VECTOR_SEARCH"),
        F.lit("_"),
        F.col("l_linestatus"),
    )


def usage(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.lit("ws_1").alias("workspace_id"),
        F.col("l_shipdate").cast("date").alias("usage_date"),
        F.col("l_shipdate").alias("usage_end_time"),
        F.lit("DBU").alias("usage_unit"),
        _sku().alias("sku_name"),
        F.col("l_quantity").alias("usage_quantity"),
        F.struct(
            F.when(F.col("l_tax") != 0.0, F.col("l_suppkey")).alias("job_id"),
            F.when(F.col("l_returnflag") == "N", _id("WH_", "l_linenumber")).alias("warehouse_id"),
        ).alias("usage_metadata"),
    )


def list_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly list prices per SKU from the years in use; the last range is open."""
    year = F.year("l_shipdate")
    per_year = (
        table(spark, folder, "lineitem")
        .select(_sku().alias("sku_name"), year.alias("y"))
        .distinct()
    )
    last = per_year.groupBy("sku_name").agg(F.max("y").alias("last_y"))
    return per_year.join(last, "sku_name").select(
        "sku_name",
        F.lit("DBU").alias("usage_unit"),
        F.make_timestamp_ntz("y", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias(
            "price_start_time"
        ),
        F.when(
            F.col("y") < F.col("last_y"),
            F.make_timestamp_ntz(
                F.col("y") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)
            ),
        ).alias("price_end_time"),
        F.struct(
            F.struct(
                (F.lit(0.10).cast("decimal(18,4)") + (F.col("y") - 1990) / F.lit(100))
                .cast("decimal(18,4)")
                .alias("default")
            ).alias("effective_list")
        ).alias("pricing"),
    )


def audit_log(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    code = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").select(
        F.col("ts").cast("date").alias("event_date"),
        F.col("ts").alias("event_time"),
        F.col("event_id"),
        F.when(kind == "click", "accounts").otherwise("catalog").alias("service_name"),
        F.when(kind == "click", "userLogin").when(kind == "signup", "tokenLogin")
        .when(kind == "purchase", "updateGrants").when(kind == "error", "changePermission")
        .otherwise("getTable").alias("action_name"),
        F.col("props").alias("request_params"),
        F.concat(F.lit("10.0.0."), F.col("user_id")).alias("source_ip_address"),
        F.struct(F.concat(F.lit("u"), F.col("user_id"), F.lit("@example.com")).alias("email"))
        .alias("user_identity"),
        F.struct(
            F.when(code < 50, 200).otherwise(401).alias("status_code"),
            F.when(code >= 90, "locked").alias("error_message"),
        ).alias("response"),
    )


def portfolio_access(spark: SparkSession, folder: str) -> DataFrame:
    """Which user may see which portfolio."""
    return table(spark, folder, "supplier").select(
        F.concat(F.lit("pm"), F.col("s_nationkey"), F.lit("@example.com")).alias("pm_user"),
        _id("PF_", "s_suppkey").alias("portfolio_id"),
    )


# ---- documents --------------------------------------------------------------------


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.concat_ws("/", "source", "doc_id").alias("doc_name"),
        F.col("doc_id"),
        F.col("text"),
    )


def document_register(spark: SparkSession, folder: str) -> DataFrame:
    """Review outcome per document: approved for indexing, restricted, or neither."""
    return table(spark, folder, "labels").select(
        F.col("doc_id"),
        (F.col("quality") == 1).alias("approved"),
        (F.col("toxic") == 1).alias("restricted"),
    )


def chunk_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), F.col("label").alias("topic"), "embedding"
    )


def question_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """One question per topic: the vector of the topic's first chunk, ``own_chunk_id``."""
    return (
        table(spark, folder, "embeddings")
        .groupBy("label")
        .agg(F.min_by("embedding", "vec_id").alias("embedding"), F.min("vec_id").alias("own_chunk_id"))
        .select(F.col("label").alias("question_id"), "embedding", "own_chunk_id")
    )
