"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables below a folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._dir}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register fn(tables) under a name, with its SQL where SQL can express it."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return fn

    return register
