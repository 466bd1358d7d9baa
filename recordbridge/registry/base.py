"""Query registration and the table loader."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The test tables of one folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name`` with its equivalent SQL."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(tune(spark), folder))

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return fn

    return register


def nullif(column: str, value) -> Column:
    return F.nullif(F.col(column), F.lit(value))


def money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")
