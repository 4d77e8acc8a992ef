"""Registry of queries over the driver tables and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks import portable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Driver tables as attributes: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        # read once per query: every read opens the file for its schema
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


def check(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with the SQL that must give the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: portable.frame(name, fn(Tables(spark, folder)))
        if sql:
            ORACLE[name] = portable.sql(name, sql)
        return fn

    return register


def dec(col: str, scale: int = 2) -> str:
    """SQL text of an exact money value."""
    return f"CAST({col} AS DECIMAL(18,{scale}))"


def dsum(col: str) -> str:
    """SQL text of an exact money sum as a double."""
    return f"CAST(sum({dec(col)}) AS DOUBLE)"
