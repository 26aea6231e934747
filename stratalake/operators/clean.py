"""Projection, normalisation, imputation and filters."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.text import blank, decimal_comma, recode
from stratalake.sources.literal import literal_dim


def _require(df: DataFrame, columns: Sequence[str]) -> None:
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns: {unknown}")


# ---- projection -----------------------------------------------------------

def project_renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the listed columns under their new names, in the order given."""
    _require(df, list(names))
    return df.select([F.col(f"`{old}`").alias(new) for old, new in names.items()])


def project_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the wanted columns that exist; names the frame lacks are ignored."""
    return df.select([c for c in wanted if c in df.columns])


# ---- value normalisation --------------------------------------------------

def normalize_values(df: DataFrame, column: str, mapping: Mapping) -> DataFrame:
    return normalize_columns(df, {column: mapping})


def normalize_columns(df: DataFrame, mappings: Mapping[str, Mapping]) -> DataFrame:
    """Recode several columns in one projection."""
    _require(df, list(mappings))
    return df.withColumns({c: recode(F.col(c), m) for c, m in mappings.items()})


def decimal_comma_cast(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Read decimal-comma text as doubles; listed columns that are absent are skipped."""
    return df.withColumns({c: decimal_comma(F.col(c)) for c in columns if c in df.columns})


# ---- missing values -------------------------------------------------------

def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL or NaN in any of the columns (all by default)."""
    return df.dropna(subset=list(columns) if columns is not None else None)


def complete_row(df: DataFrame) -> Column:
    """The predicate behind ``drop_nulls``: no column is NULL or NaN."""
    tests = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        ok = c.isNotNull()
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            ok = ok & ~F.isnan(c)
        tests.append(ok)
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def fill_numeric(df: DataFrame, value: float = 0) -> DataFrame:
    """Replace NULL and NaN in numeric columns; text columns are untouched."""
    return df.fillna(value)


def _of_kind(df: DataFrame, columns: Sequence[str] | None, kind: type[T.DataType]) -> tuple[list[str], list[str]]:
    """(wanted columns of a kind, wanted ones of other kinds); all of the kind where none are named. An unknown name raises."""
    if not isinstance(df, DataFrame):
        raise TypeError(f"no DataFrame: {df!r}")
    if columns is not None:
        _require(df, columns)
    wanted = df.columns if columns is None else [c for c in df.columns if c in set(columns)]
    fitting = [c for c in wanted if isinstance(df.schema[c].dataType, kind)]
    return fitting, [] if columns is None else [c for c in wanted if c not in fitting]


def impute_numeric(df: DataFrame, value: float = 999.0, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace NULL in columns of any numeric type with a constant.

    Without ``columns`` every numeric column is imputed. A listed column that is
    not numeric is skipped with a warning; a listed name that does not exist raises, and so does a constant that is no number.
    """
    if type(value) not in (int, float):
        raise TypeError(f"no number to impute: {value!r}")
    numbers, others = _of_kind(df, columns, T.NumericType)
    if others:
        warnings.warn(f"not numeric, left as they are: {sorted(others)}", stacklevel=2)
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(value)) for c in numbers})


def impute_string(df: DataFrame, value: str = "Desconocido", columns: Sequence[str] | None = None) -> DataFrame:
    """Replace NULL and empty text with a constant.

    Without ``columns`` every string column is imputed. Listed columns of other
    types are cast to string first.
    """
    texts, others = _of_kind(df, columns, T.StringType)
    as_text = {c: F.col(f"`{c}`").cast("string") for c in [*texts, *others]}
    return df.withColumns({c: F.when(blank(t), F.lit(value)).otherwise(t) for c, t in as_text.items()})


# ---- filters --------------------------------------------------------------

def filter_pairs(df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple]) -> DataFrame:
    """Keep rows whose column tuple is listed, by a semi-join with the list as a literal dimension.

    The list is code, not data: ``literal_dim`` refuses more than it should hold, and longer lists belong in a table.
    """
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in columns])
    return df.join(literal_dim(df.sparkSession, pairs, schema), list(columns), "left_semi")


def filter_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(F.col(column).startswith(prefix))


def reject_split(df: DataFrame, well_formed: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy the test, rows that do not). A NULL test rejects the row."""
    ok = F.coalesce(well_formed, F.lit(False))
    return df.filter(ok), df.filter(~ok)
