"""The query register: name -> (Spark builder, optional oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from holdfast.functions.exact import plain_numbers
from holdfast.plans.oracle_views import with_views

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a builder; ``sql`` may use the names defined in the oracle views."""

    def register(build: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain_numbers(build(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return register
