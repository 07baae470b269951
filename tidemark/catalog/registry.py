"""Registration of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver's tables of one scale, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)  # asked for again: same DataFrame, no second look at the footers
        return table

    def stream(self, name: str) -> DataFrame:
        """The same table as a file stream."""
        schema = getattr(self, name).schema
        # A glob, because a file stream takes a folder or a pattern but not one file's name.
        return self.spark.readStream.schema(schema).parquet(f"{self.folder}/{name}.parque[t]")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name`` with the SQL that gives the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
