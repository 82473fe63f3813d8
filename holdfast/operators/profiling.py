"""Table profile and run-to-run drift of a fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.exact import MONEY_DIGITS, exact_count_and_sum, money, ratio, rounded

# Of the sketch that brackets a quantile: ranks are right to this part of all values
_ACCURACY = 10_000


def _moments(column: str) -> tuple[Column, Column, Column]:
    value = money(F.col(column))
    return F.count(column), F.sum(value), F.sum(value * value)


def _mean_stddev(n: Column, s: Column, s2: Column) -> tuple[Column, Column]:
    """Mean and sample deviation from exact sums."""
    count, total, squares = n.cast("double"), s.cast("double"), s2.cast("double")
    variance = F.try_divide(squares - total * total / F.nullif(count, F.lit(0.0)), count - 1)
    return (
        rounded(F.try_divide(total, count), 4),
        rounded(F.sqrt(F.greatest(variance, F.lit(0.0))), 4),
    )


def profile_table(df: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> DataFrame:
    """One row per column: rows, NULLs, distinct values, bounds, mean and deviation.

    The statistics come from one pass. Distinct values are counted exactly in two steps,
    (column, value) first, so a column with many values is spread over all tasks.
    """
    names = [*numeric, *text]
    stats = []
    for c in names:
        value = F.col(c)
        moments = _moments(c) if c in numeric else (F.count(c), F.lit(None), F.lit(None))
        number = value.cast("double") if c in numeric else F.lit(None).cast("double")
        letters = value if c in text else F.lit(None).cast("string")
        stats.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count("*").alias("row_count"),
                moments[0].alias("n"),
                moments[1].cast("decimal(38,4)").alias("s"),
                moments[2].cast("decimal(38,8)").alias("s2"),
                F.min(number).alias("min_number"),
                F.max(number).alias("max_number"),
                F.min(letters).alias("min_text"),
                F.max(letters).alias("max_text"),
            )
        )
    one_pass = df.agg(F.array(*stats).alias("a")).select(F.explode("a").alias("p")).select("p.*")
    melted = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"))
                    for c in names
                ]
            )
        ).alias("x")
    ).select("x.*")
    distinct = (
        melted.filter(F.col("v").isNotNull())
        .distinct()
        .groupBy("column_name")
        .agg(F.count("*").alias("distinct_count"))
    )
    mean, stddev = _mean_stddev(F.col("n"), F.col("s"), F.col("s2"))
    is_number = F.col("column_name").isin(*numeric)
    return one_pass.join(distinct, "column_name", "left").select(
        "column_name",
        "row_count",
        (F.col("row_count") - F.col("n")).alias("null_count"),
        F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"),
        "min_number",
        "max_number",
        "min_text",
        "max_text",
        F.when(is_number, mean).alias("mean"),
        F.when(is_number, stddev).alias("stddev"),
    )


def _around(df: DataFrame, numeric: Sequence[str], points: Sequence[float]) -> DataFrame:
    """(column_name, place, v, n, below, target): the values near each point, with their counts.

    A sketch of bounded size brackets each point; the values below a bracket are only counted.
    A bracket that the exact counts do not confirm is left out, and all values are kept.
    """
    value = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in numeric]
    values = df.select(F.explode(F.array(*value)).alias("x")).select("x.*").filter(F.col("v").isNotNull())
    shares = [min(max(p + d * 3 / _ACCURACY, 0.0), 1.0) for p in points for d in (-1, 1)]
    sketch = values.groupBy("column_name").agg(
        F.count("*").alias("total"), F.percentile_approx("v", shares, _ACCURACY).alias("q")
    ).collect()
    counted = values.groupBy("column_name", "v").agg(F.count("*").alias("n"))
    brackets = [
        (r["column_name"], i, r["total"], r["q"][2 * i], r["q"][2 * i + 1]) for r in sketch for i in range(len(points))
    ]
    is_of = lambda c: F.col("column_name") == c
    sums = [
        F.count_if(is_of(c) & (F.col("v") < F.lit(low))) for c, _, _, low, _ in brackets
    ] + [F.count_if(is_of(c) & (F.col("v") <= F.lit(high))) for c, _, _, _, high in brackets]
    exact = values.agg(*sums).first() if brackets else ()
    places = []
    for k, (c, i, total, low, high) in enumerate(brackets):
        target, below, through = F.ceil(F.lit(total) * F.lit(points[i])), exact[k], exact[len(brackets) + k]
        holds = (target > below) & (target <= through)
        near = is_of(c) & (~holds | (F.col("v") >= F.lit(low)) & (F.col("v") <= F.lit(high)))
        places.append(F.when(near, F.struct(
            F.lit(i).alias("place"), F.when(holds, F.lit(below)).otherwise(0).cast("bigint").alias("below"), target.alias("target")
        )))
    if not places:
        return counted.select("column_name", F.lit(0).alias("place"), "v", "n", F.lit(0).alias("below"), F.lit(0).alias("target"))
    return counted.select("column_name", "v", "n", F.explode(F.array_compact(F.array(*places))).alias("at")).select(
        "column_name", "at.place", "v", "n", "at.below", "at.target"
    )


def exact_quantiles(df: DataFrame, numeric: Sequence[str], points: Sequence[float]) -> DataFrame:
    """Per numeric column the smallest value that the share ``point`` of all values reaches.

    Equal values are counted before the shuffle; only those near a point, about one in 1,600 for
    each, are sorted, in a window that spills. ``df`` is read three times.
    """
    near = _around(df, numeric, points)
    running = Window.partitionBy("column_name", "place").orderBy("v")
    reached = near.withColumn("reached", F.col("below") + F.sum("n").over(running)).filter("reached >= target")
    at = lambda i: F.min(F.when(F.col("place") == i, F.col("v")))
    return reached.groupBy("column_name").agg(*[at(i).alias(f"p{round(p * 100)}") for i, p in enumerate(points)])


def profile_quantiles(
    df: DataFrame, numeric: Sequence[str], points: Sequence[float], accuracy: int = 10000
) -> DataFrame:
    """Approximate quantiles per numeric column; memory per task is bounded by ``accuracy``."""
    parts = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.percentile_approx(F.col(c).cast("double"), list(points), accuracy).alias("q"),
        )
        for c in numeric
    ]
    rows = df.agg(F.array(*parts).alias("a")).select(F.explode("a").alias("p"))
    named = [F.col("p.q")[i].alias(f"p{round(point * 100)}") for i, point in enumerate(points)]
    return rows.select("p.column_name", *named)


def profile_slices(df: DataFrame, slice_column: str, numeric: Sequence[str]) -> DataFrame:
    """Row count, NULLs and mean per slice (a run, a date) and column.

    All columns are added up in one row per slice, which is then opened into a row for each column.
    """
    sums = {c: exact_count_and_sum(F.col(c), MONEY_DIGITS) for c in numeric}
    parts = [f(c).alias(f"{name}{i}") for i, c in enumerate(numeric) for name, f in (
        ("_n", lambda c: sums[c][0]), ("_s", lambda c: sums[c][1]))]
    columns = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("row_count"),
            (F.col("row_count") - F.col(f"_n{i}")).alias("null_count"),
            rounded(ratio(F.col(f"_s{i}"), F.col(f"_n{i}")), 4).alias("mean"),
        )
        for i, c in enumerate(numeric)
    ]
    added = df.groupBy(slice_column).agg(F.count("*").alias("row_count"), *parts)
    return added.select(slice_column, F.explode(F.array(*columns)).alias("x")).select(slice_column, "x.*")


def profile_drift(profiles: DataFrame, slice_column: str) -> DataFrame:
    """Change of each metric against the slice before; one row per slice and column."""
    before = Window.partitionBy("column_name").orderBy(slice_column)
    earlier_mean = F.lag("mean").over(before)
    return profiles.select(
        slice_column,
        "column_name",
        (F.col("row_count") - F.lag("row_count").over(before)).alias("row_count_change"),
        (F.col("null_count") - F.lag("null_count").over(before)).alias("null_count_change"),
        rounded(ratio(F.col("mean") - earlier_mean, earlier_mean) * 100, 2).alias(
            "mean_change_pct"
        ),
    )
