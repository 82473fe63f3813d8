"""Row filter, column mask, table functions, audit listings and serving counts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.access import masked, sees_all_rows

BREACHES_FUNCTION = "holdfast_portfolio_breaches"
EXPOSURE_FUNCTION = "holdfast_sector_exposure"


def apply_row_filter(
    df: DataFrame, user: str, groups: Iterable[str], access: DataFrame
) -> DataFrame:
    """Rows the user may see: all for engineers and analysts, else the mapped portfolios."""
    if sees_all_rows(groups):
        return df
    own = access.filter(F.col("pm_user") == user).select("portfolio_id")
    return df.join(own, "portfolio_id", "left_semi")


def apply_column_mask(df: DataFrame, column: str, groups: Iterable[str]) -> DataFrame:
    return df.withColumn(column, masked(F.col(column), groups))


def _table_function(spark: SparkSession, name: str, columns: str, df: DataFrame) -> None:
    """A SQL table function of one portfolio, over a view of ``df``."""
    view = f"{name}_source"
    df.createOrReplaceTempView(view)
    typed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(columns.split()).schema)
    listed = ", ".join(columns.split())
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(target_portfolio STRING) "
        f"RETURNS TABLE ({typed}) RETURN "
        f"SELECT {listed} FROM {view} WHERE portfolio_id = target_portfolio"
    )


def register_portfolio_breaches(spark: SparkSession, breaches: DataFrame) -> None:
    """``holdfast_portfolio_breaches(portfolio)``: sector limit breaches of one portfolio."""
    sector = breaches.filter("scope_type = 'SECTOR'").withColumnRenamed("scope_value", "sector")
    _table_function(
        spark, BREACHES_FUNCTION,
        "sector exposure_pct max_pct breach_by_pct limit_id as_of_date", sector,
    )


def register_sector_exposure(spark: SparkSession, exposures: DataFrame) -> None:
    """``holdfast_sector_exposure(portfolio)``: sector shares of one portfolio."""
    _table_function(spark, EXPOSURE_FUNCTION, "sector exposure_pct as_of_date", exposures)


def for_each_portfolio(spark: SparkSession, portfolios: DataFrame, function: str) -> DataFrame:
    """Call a table function for every portfolio; Spark turns the lateral call into a join."""
    view = f"{function}_portfolios"
    portfolios.select("portfolio_id").createOrReplaceTempView(view)
    return spark.sql(f"SELECT p.portfolio_id, t.* FROM {view} p, LATERAL {function}(p.portfolio_id) t")


def open_breaches(breaches: DataFrame) -> DataFrame:
    """Breaches on the latest date. Counted per date, so the facts are read once."""
    return (
        breaches.groupBy("as_of_date")
        .agg(F.count("*").alias("breach_count"))
        .orderBy(F.col("as_of_date").desc())
        .limit(1)
    )


def permission_changes(audit: DataFrame, since: str, n: int = 200) -> DataFrame:
    """Newest grant and permission changes."""
    action = F.col("action_name")
    return (
        audit.filter(F.col("event_date") >= F.lit(since).cast("date"))
        .filter(action.ilike("%Grant%") | action.ilike("%Permission%"))
        .orderBy(F.col("event_time").desc(), F.col("event_id").desc())
        .limit(n)
        .select(
            "event_time", F.col("user_identity.email").alias("actor"), "service_name",
            "action_name", "request_params",
        )
    )


def failed_logins(audit: DataFrame, since: str, n: int = 200) -> DataFrame:
    """Newest failed logins: a status other than 200 or an error message."""
    status = F.col("response.status_code")
    return (
        audit.filter(F.col("event_date") >= F.lit(since).cast("date"))
        .filter(F.col("action_name").ilike("%login%"))
        .filter((status != 200) | F.col("response.error_message").isNotNull())
        .orderBy(F.col("event_time").desc(), F.col("event_id").desc())
        .limit(n)
        .select(
            "event_time", F.col("user_identity.email").alias("actor"), "source_ip_address",
            "action_name", status.alias("status_code"),
            F.col("response.error_message").alias("error_message"),
        )
    )
