"""Text and value-recoding expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal_comma(text: Column) -> Column:
    """``"1,5"`` to 1.5; codes such as ``"Ip"`` give NULL."""
    return F.translate(text, ",", ".").try_cast("double")


def locale_decimal(text: Column, strict: bool = False) -> Column:
    """``"1.234,5"`` to 1234.5: points are separators where there is a comma. With ``strict`` other text is an error."""
    plain = F.when(F.contains(text, F.lit(",")), F.translate(text, ",.", ".")).otherwise(text)
    return plain.cast("double") if strict else plain.try_cast("double")


def recode(value: Column, mapping: Mapping) -> Column:
    """Replace listed values; everything else, NULL included, passes through."""
    branches = None
    for old, new in mapping.items():
        test = value == F.lit(old)
        branches = F.when(test, F.lit(new)) if branches is None else branches.when(test, F.lit(new))
    return value if branches is None else branches.otherwise(value)


def blank(text: Column) -> Column:
    """True where the text is NULL or empty."""
    return text.isNull() | (text == "")


def row_id(*columns: str) -> Column:
    """Repeatable 64-bit row id from the identifying columns."""
    return F.xxhash64(*columns)
