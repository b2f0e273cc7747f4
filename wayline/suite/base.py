"""Registry of bound queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Data:
    """The driver's tables as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of `Data` under the operator's name, with its SQL check."""

    def register(fn: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Data(spark, sf_dir))
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return register
