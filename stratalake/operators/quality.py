"""Data-quality report, coverage and period bounds per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.clock import months_spanned
from stratalake.operators.clean import filter_pairs
from stratalake.sources.literal import literal_dim


def _wanted_frame(df: DataFrame, keys: Sequence[str], wanted: Sequence) -> tuple[DataFrame, list[tuple]]:
    rows = [w if isinstance(w, tuple) else (w,) for w in wanted]
    schema = T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys])
    return literal_dim(df.sparkSession, rows, schema), rows


def _period(year: str, month: str) -> Column:
    """Year and month as one number. Spark hash-aggregates numbers, but sorts rows to take the least struct."""
    return F.col(year).cast("long") * 100 + F.col(month)


def _bounds(first: str, last: str) -> dict[str, Column]:
    """The numbered first and last period as separate integers."""
    return {
        "first_year": F.floor(F.col(first) / 100).cast("int"),
        "first_month": (F.col(first) % 100).cast("int"),
        "last_year": F.floor(F.col(last) / 100).cast("int"),
        "last_month": (F.col(last) % 100).cast("int"),
    }


def _summarise(monthly: DataFrame, keys: list[str], wanted: Sequence | None) -> DataFrame:
    """From one row per (key, period) with before/after counts to one row per key."""
    period = F.when(F.col("_after") > 0, _period("_year", "_month"))
    per_key = monthly.groupBy(*keys).agg(
        F.sum("_before").alias("rows_before"),
        F.sum("_after").alias("rows_after"),
        # one input row per period here, so counting rows counts distinct months
        F.count(period).alias("months_present"),
        F.min(period).alias("_first"),
        F.max(period).alias("_last"),
    )
    if wanted is not None:
        listed, _ = _wanted_frame(monthly, keys, wanted)
        # both inputs were cut to the wanted keys, so per_key is no longer than that list
        per_key = listed.join(F.broadcast(per_key), keys, "left")
    counted = per_key.fillna(0, subset=["rows_before", "rows_after", "months_present"])
    bounds = _bounds("_first", "_last")
    expected = F.coalesce(months_spanned(*bounds.values()), F.lit(0)).cast("long")
    return counted.select(
        *keys,
        "rows_before",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_dropped"),
        "rows_after",
        "months_present",
        expected.alias("months_expected"),
        (expected - F.col("months_present")).alias("months_missing"),
        *[c.alias(name) for name, c in bounds.items()],
        F.when(F.col("rows_after") > 0, "ok").otherwise("no data").alias("status"),
    )


def quality_report(
    before: DataFrame,
    after: DataFrame,
    keys: str | Sequence[str],
    year: str,
    month: str,
    wanted: Sequence | None = None,
) -> DataFrame:
    """Rows before and after cleaning, months present, expected and missing, per key.

    Both sides are counted down to (key, period) in one aggregation before
    anything is grouped by key alone, so a key that holds most of the rows costs
    no more than its number of periods. Normalise key names in ``before`` first.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)

    def tagged(df: DataFrame, is_after: int) -> DataFrame:
        if wanted is not None:
            df = filter_pairs(df, keys, [w if isinstance(w, tuple) else (w,) for w in wanted])
        return df.select(
            *keys,
            F.col(year).alias("_year"),
            F.col(month).alias("_month"),
            F.lit(1 - is_after).alias("_b"),
            F.lit(is_after).alias("_a"),
        )

    monthly = (
        tagged(before, 0)
        .unionByName(tagged(after, 1))
        .groupBy(*keys, "_year", "_month")
        .agg(F.sum("_b").alias("_before"), F.sum("_a").alias("_after"))
    )
    return _summarise(monthly, keys, wanted)


def quality_report_marked(
    df: DataFrame, kept: Column, keys: str | Sequence[str], year: str, month: str, wanted: Sequence | None = None
) -> DataFrame:
    """The same report from one scan, where ``kept`` says which rows survive cleaning."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    marked = df.withColumn("_kept", F.coalesce(kept, F.lit(False)).cast("int"))
    if wanted is not None:
        marked = filter_pairs(marked, keys, [w if isinstance(w, tuple) else (w,) for w in wanted])
    monthly = marked.groupBy(*keys, F.col(year).alias("_year"), F.col(month).alias("_month")).agg(
        F.count(F.lit(1)).alias("_before"), F.sum("_kept").alias("_after")
    )
    return _summarise(monthly, keys, wanted)


def coverage_check(df: DataFrame, key: str, wanted: Sequence) -> DataFrame:
    """Row count per wanted key, with 0 and ``has_data = false`` for absent ones."""
    listed, rows = _wanted_frame(df, [key], wanted)
    counts = filter_pairs(df, [key], rows).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return (
        listed.join(F.broadcast(counts), key, "left")
        .select(key, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.col("n_rows").isNotNull().alias("has_data"))
    )


def first_last_period(df: DataFrame, keys: str | Sequence[str], year: str, month: str) -> DataFrame:
    """First and last (year, month) per key, without a sort."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    period = _period(year, month)
    found = df.groupBy(*keys).agg(F.min(period).alias("_first"), F.max(period).alias("_last"))
    return found.select(*keys, *[c.alias(name) for name, c in _bounds("_first", "_last").items()])


def distinct_periods(df: DataFrame, keys: str | Sequence[str], year: str, month: str) -> DataFrame:
    """Number of distinct months per key; grouped by period first so a hot key stays small."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.select(*keys, year, month).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n_periods"))
