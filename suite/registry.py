"""Registered queries: a Spark callable and, where SQL can say it, the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.scratch import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORK_DB = "stratalake_suite"


class Tables:
    """The given tables by attribute: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)  # the footer is read once per query
        return table

    def work_db(self) -> str:
        """A database kept in the shared scratch folder."""
        if not self.spark.catalog.databaseExists(WORK_DB):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {WORK_DB} LOCATION '{scratch_dir(self.spark)}'")
        return WORK_DB


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables`` under its own name."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return wrap


def money(c: Column) -> Column:
    return F.round(c, 2)


def dated(df: DataFrame, column: str) -> DataFrame:
    """Add integer ``year`` and ``month``."""
    return df.withColumns({"year": F.year(column), "month": F.month(column)})


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so that summation order does not show."""
    return df.withColumns({n: F.round(F.col(n), digits) for n, kind in df.dtypes if kind == "double"})
