"""The list of queries: each has a Spark form and, where SQL can say it, the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from segue.session import ship_package

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        def shipped(spark: SparkSession, sf: str) -> DataFrame:
            ship_package(spark)
            return run(spark, sf)

        QUERIES[name] = Query(shipped, sql)
        return shipped

    return add
