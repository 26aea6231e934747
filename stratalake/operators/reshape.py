"""Unions, period expansion, interval and array explosion."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union by column name; with ``allow_missing`` absent columns become NULL."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def expand_quarter_to_month(
    df: DataFrame, month: str, measures: Sequence[str], sentinel=-99, quarter_ends: Sequence[int] = (3, 6, 9, 12)
) -> DataFrame:
    """Emit the two months before each quarter end as well, with the measures set to a sentinel.

    Rows of other months pass once. One scan, no shuffle.
    """
    source = F.col(month)
    months = F.when(source.isin(list(quarter_ends)), F.sequence(source - 2, source)).otherwise(F.array(source))
    spread = df.withColumn("_month", F.explode(months))
    filled = (F.col("_month") != source) & F.col("_month").isNotNull()
    return spread.withColumns(
        {c: F.when(filled, F.lit(sentinel).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c in measures}
        | {month: F.col("_month")}
    ).drop("_month")


def copy_period(
    df: DataFrame, year: str, month: str, source: tuple[int, int], target_months: Sequence[int]
) -> DataFrame:
    """Repeat the rows of one (year, month) under further months of that year."""
    hit = (F.col(year) == source[0]) & (F.col(month) == source[1])
    kind = df.schema[month].dataType
    months = F.array(*[F.lit(m).cast(kind) for m in (source[1], *target_months)])
    return df.withColumn(month, F.explode(F.when(hit, months).otherwise(F.array(F.col(month)))))


def explode_keep(df: DataFrame, items: str, out: str) -> DataFrame:
    """One row per array element; a parent with a NULL or empty array stays once with NULL."""
    return df.withColumn(out, F.explode_outer(F.col(items)))


def date_intervals(
    spans: DataFrame, start: str, end: str, days: int = 15, pattern: str = "yyyy-MM-dd'T'HH:mm:ss'UTC'"
) -> DataFrame:
    """Cut each [start, end] row into consecutive intervals of ``days`` days, the last one clipped.

    Adds ``interval_start`` and ``interval_end`` (dates, both ends included) and
    the same bounds as formatted text.
    """
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    starts = F.when(first <= last, F.sequence(first, last, F.expr(f"INTERVAL {int(days)} DAY")))
    cut = spans.withColumn("interval_start", F.explode(starts)).withColumn(
        "interval_end", F.least(F.date_add("interval_start", days - 1), last)
    )
    return cut.withColumns(
        {
            "start_text": F.date_format("interval_start", pattern),
            "end_text": F.date_format("interval_end", pattern),
        }
    )
