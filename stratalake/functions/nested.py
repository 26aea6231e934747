"""JSON and array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_matching(items: Column, field: str, value, out: str) -> Column:
    """Field ``out`` of the first array element whose ``field`` equals ``value``; NULL when none does."""
    hits = F.filter(items, lambda item: item[field] == F.lit(value))
    return F.get(hits, F.lit(0))[out]


def parse_json(text: Column, schema: str) -> Column:
    """Parse a JSON string; a malformed document gives NULL."""
    return F.from_json(text, schema)


def parse_json_renamed(text: Column, exact_schema: str, unique_schema: str) -> Column:
    """Parse JSON whose keys differ only in case.

    The parser matches ``exact_schema`` case by case; the cast then renames the
    fields by position, so no session-wide case setting is needed.
    """
    return F.from_json(text, exact_schema).cast(unique_schema)


def document(*columns: str | Column) -> Column:
    """Serialise columns to one JSON document."""
    return F.to_json(F.struct(*columns))
