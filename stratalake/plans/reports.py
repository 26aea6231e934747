"""Reporting extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stratalake.operators.clean import filter_pairs
from stratalake.sources.writers import overwrite_table


def report_extract(df: DataFrame, columns: Sequence[str], place: str, places: Sequence) -> DataFrame:
    """The asked columns for the asked places."""
    return filter_pairs(df, [place], [(p,) for p in places]).select(*columns)


def publish_extract(df: DataFrame, columns: Sequence[str], place: str, places: Sequence, db: str, table: str) -> DataFrame:
    """Write an extract as a table and return it."""
    return overwrite_table(report_extract(df, columns, place, places), db, table)
