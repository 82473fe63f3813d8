"""Platform analytics: job outcomes and durations, usage, and cost at list price.

``since`` and ``until`` are dates of the report window; None leaves that side open.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.exact import factor, ratio, rounded

# Fixed values
FAILED_STATES = ("FAILED", "TIMED_OUT", "INTERNAL_ERROR")
WEEK_JUMP = 1.5


def _from(df: DataFrame, column: str, since: str | None) -> DataFrame:
    return df if since is None else df.filter(F.col(column) >= F.lit(since).cast("date"))


def with_workflow(df: DataFrame, jobs: DataFrame, job_id: Column) -> DataFrame:
    """Add the job's name, or its id where the register does not know it."""
    register = jobs.select(
        F.col("workspace_id").alias("_workspace"), F.col("job_id").alias("_job"), "name"
    )
    return (
        df.join(
            register,
            (job_id == F.col("_job")) & (F.col("workspace_id") == F.col("_workspace")),
            "left",
        )
        .withColumn("workflow", F.coalesce("name", job_id.cast("string")))
        .drop("_workspace", "_job", "name")
    )


def job_runs_daily(runs: DataFrame, jobs: DataFrame, since: str | None = None) -> DataFrame:
    """Runs and failed runs per day and workflow; counted per job id before the lookup."""
    failed = F.col("result_state").isin(*FAILED_STATES)
    counted = (
        _from(runs, "period_start_time", since)
        .groupBy("workspace_id", "job_id", F.to_date("period_start_time").alias("run_day"))
        .agg(F.count("*").alias("n"), F.count_if(failed).alias("f"))
    )
    return (
        with_workflow(counted, jobs, F.col("job_id"))
        .groupBy("run_day", "workflow")
        .agg(F.sum("n").alias("total_runs"), F.sum("f").alias("failed_runs"))
    )


def job_duration_trend(runs: DataFrame, jobs: DataFrame, since: str | None = None) -> DataFrame:
    """Mean duration in minutes per day and workflow, of finished runs."""
    seconds = F.expr("timestampdiff(SECOND, period_start_time, period_end_time)")
    counted = (
        _from(runs, "period_start_time", since)
        .filter(F.col("period_end_time").isNotNull())
        .groupBy("workspace_id", "job_id", F.to_date("period_start_time").alias("run_day"))
        .agg(F.count("*").alias("n"), F.sum(seconds).alias("s"))
    )
    return (
        with_workflow(counted, jobs, F.col("job_id"))
        .groupBy("run_day", "workflow")
        .agg(rounded(ratio(F.sum("s"), F.sum("n")) / 60, 2).alias("avg_duration_min"))
    )


def failed_runs(
    runs: DataFrame, jobs: DataFrame, since: str | None = None, n: int = 200
) -> DataFrame:
    """Newest failed runs with their workflow; the lookup happens for the kept rows only."""
    failed = F.col("result_state").isin(*FAILED_STATES)
    return recent_runs(_from(runs, "period_start_time", since).filter(failed), jobs, n)


def recent_runs(runs: DataFrame, jobs: DataFrame, n: int = 100) -> DataFrame:
    """Newest runs of any state with their workflow."""
    newest = runs.orderBy(F.col("period_start_time").desc(), F.col("run_id").desc()).limit(n)
    return with_workflow(newest, jobs, F.col("job_id")).select(
        "workflow", "job_id", "run_id", "result_state", "period_start_time", "period_end_time"
    )


def _quantity() -> Column:
    return F.round(F.sum(factor(F.col("usage_quantity"))), 2)


def usage_by(
    usage: DataFrame,
    keys: Sequence[str | Column],
    since: str | None = None,
    sku_patterns: Sequence[str] = (),
) -> DataFrame:
    """Usage per key, of the SKUs matching any of the case-insensitive patterns."""
    chosen = _from(usage, "usage_date", since)
    if sku_patterns:
        chosen = chosen.filter(reduce(or_, [F.col("sku_name").ilike(p) for p in sku_patterns]))
    return chosen.groupBy(*keys).agg(_quantity().alias("dbus"))


def usage_by_workflow(usage: DataFrame, jobs: DataFrame, since: str | None = None) -> DataFrame:
    """Usage per workflow and SKU, of rows that belong to a job or to a job SKU."""
    job_id = F.col("usage_metadata.job_id")
    per_job = (
        _from(usage, "usage_date", since)
        .filter(job_id.isNotNull() | F.col("sku_name").ilike("%JOBS%"))
        .groupBy("workspace_id", job_id.alias("job_id"), "sku_name")
        .agg(F.sum(factor(F.col("usage_quantity"))).alias("q"))
    )
    return (
        with_workflow(per_job, jobs, F.col("job_id"))
        .groupBy("workflow", "sku_name")
        .agg(F.round(F.sum("q"), 2).alias("total_dbus"))
    )


def usage_week_change(usage: DataFrame, until: str) -> DataFrame:
    """SKU weeks whose usage is more than 50% above the week before.

    Week 0 ends on ``until``; every earlier week is reported too. Each weekly sum is offered
    once as itself and once as "the week before" of the next, so no week is joined to another.
    """
    weeks_ago = F.floor(F.datediff(F.lit(until).cast("date"), F.col("usage_date")) / 7)
    weekly = (
        usage.filter(F.col("usage_date") <= F.lit(until).cast("date"))
        .groupBy("sku_name", weeks_ago.cast("int").alias("weeks_ago"))
        .agg(F.sum(factor(F.col("usage_quantity"))).alias("q"))
    )
    nothing = F.lit(None).cast("decimal(28,8)")
    offered = weekly.select(
        "sku_name",
        F.explode(
            F.array(
                F.struct(F.col("weeks_ago"), F.col("q").alias("last"), nothing.alias("prev")),
                F.struct(
                    (F.col("weeks_ago") - 1).alias("weeks_ago"),
                    nothing.alias("last"),
                    F.col("q").alias("prev"),
                ),
            )
        ).alias("w"),
    )
    last, prev = F.col("last"), F.col("prev")
    return (
        offered.groupBy("sku_name", F.col("w.weeks_ago").alias("weeks_ago"))
        .agg(F.max("w.last").alias("last"), F.max("w.prev").alias("prev"))
        .filter(last > F.coalesce(prev, F.lit(0)) * F.lit(WEEK_JUMP).cast("decimal(3,1)"))
        .select(
            "sku_name",
            "weeks_ago",
            F.round(last, 2).alias("last_7"),
            F.round(prev, 2).alias("prev_7"),
            rounded(ratio(last - prev, prev) * 100, 1).alias("pct_change"),
        )
    )


def price_usage(usage: DataFrame, prices: DataFrame, since: str, until: str) -> DataFrame:
    """Cost of each (job, SKU, end time) at the list price valid at that time.

    A validity range is opened into the months it covers, clipped to the months in which the
    chosen usage ends, and joined on SKU, unit and month; the exact bounds stay as a filter. A SKU that holds much
    of the usage is thereby spread over its months, and no pair of rows outside a month is
    ever formed. Usage is summed per end time before the join.
    """
    low, high = F.lit(since).cast("date"), F.lit(until).cast("date")
    chosen = usage.filter(
        F.col("usage_date").between(low, high) & F.col("usage_metadata.job_id").isNotNull()
    )
    used = (
        chosen
        .groupBy(
            "workspace_id", F.col("usage_metadata.job_id").alias("job_id"), "sku_name",
            "usage_unit", "usage_end_time",
        )
        .agg(F.sum(factor(F.col("usage_quantity"))).alias("quantity"))
        .withColumn("month", F.trunc(F.col("usage_end_time").cast("date"), "month"))
    )
    # An end time may lie far from its usage date: the months come from the usage itself
    ends = chosen.agg(
        F.min("usage_end_time").cast("date").alias("low"), F.max("usage_end_time").cast("date").alias("high")
    )
    earliest, latest = ends.select("low").scalar(), ends.select("high").scalar()
    first = F.trunc(F.greatest(F.col("price_start_time").cast("date"), earliest), "month")
    last = F.trunc(F.least(F.coalesce(F.col("price_end_time").cast("date"), latest), latest), "month")
    opened = (
        prices.filter(first <= last)
        .select(
            "sku_name", "usage_unit", "price_start_time", "price_end_time",
            F.col("pricing.effective_list.default").alias("unit_price"),
            F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("month"),
        )
    )
    end = F.col("usage_end_time")
    return (
        used.join(opened, ["sku_name", "usage_unit", "month"])
        .filter(end >= F.col("price_start_time"))
        .filter(F.col("price_end_time").isNull() | (end < F.col("price_end_time")))
        .withColumn("cost", F.col("quantity") * F.col("unit_price"))
    )


def top_cost(
    usage: DataFrame, prices: DataFrame, jobs: DataFrame, since: str, until: str, n: int = 20
) -> DataFrame:
    """The ``n`` most expensive workflows."""
    per_job = (
        price_usage(usage, prices, since, until)
        .groupBy("workspace_id", "job_id")
        .agg(F.sum("cost").alias("cost"))
    )
    return (
        with_workflow(per_job, jobs, F.col("job_id"))
        .groupBy("workflow")
        .agg(F.round(F.sum("cost"), 2).alias("cost_usd"))
        .orderBy(F.col("cost_usd").desc(), "workflow")
        .limit(n)
    )
