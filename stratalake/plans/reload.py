"""Reloading of batches that failed earlier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.intervals import pending_intervals
from stratalake.operators.joins import pending
from stratalake.sources.scratch import store
from stratalake.sources.writers import append_table


def pending_rows(requested: DataFrame, loaded: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batches that were requested and are not loaded yet.

    The list of open batches is stored first. It is short, and a stored list of
    known size is broadcast, so the rows are filtered where they are read.
    """
    todo = store(pending(requested.select(*keys).distinct(), loaded, keys), "open_batches")
    return rows.join(todo, list(keys), "left_semi")


def reload_pending(
    requested: DataFrame, rows: DataFrame, keys: Sequence[str], db: str, table: str
) -> DataFrame:
    """Append the still-pending batches to a table and return it; running it again adds nothing."""
    spark = rows.sparkSession
    full = f"{db}.{table}"
    if spark.catalog.tableExists(full):
        rows = pending_rows(requested, spark.table(full), rows, keys)
    else:
        rows = rows.join(requested.select(*keys).distinct(), list(keys), "left_semi")
    return append_table(rows, db, table)


def next_requests(
    requested: DataFrame, loaded: DataFrame, attempts: DataFrame, keys: Sequence[str], start: str = "interval_start", end: str = "interval_end"
) -> DataFrame:
    """The intervals to ask for next: what no load covers of those requests whose key has not been given up.

    ``attempts`` are the states of :func:`stratalake.streaming.retries.attempt_states`, their ``key`` being the only one of ``keys``.
    """
    (key,) = keys
    over = attempts.filter(F.col("status") == "gave up").select(F.col("key").alias(key))
    return pending_intervals(pending(requested, over, [key]), loaded, [key], start, end)
