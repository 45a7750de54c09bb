"""`@query(name, sql)` registration and lazy access to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from harborline.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """`t.orders` is the orders table of one scale factor."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = prepare(spark), root.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, root: build(Tables(spark, root))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register
