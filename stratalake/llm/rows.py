"""Whole input rows carried along as one struct column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """A column by its plain name, which may hold dots, blanks or backquotes."""
    return F.col(f"`{name.replace('`', '``')}`")


def row_struct(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A struct ``row`` of the named columns, all by default; of a NULL if there are none."""
    names = df.columns if columns is None else columns
    return F.struct(*([quoted(c).alias(c) for c in names] or [F.lit(None).cast("int").alias("nothing")])).alias("row")


def unpacked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named fields of ``row`` as columns."""
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns])
