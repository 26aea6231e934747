"""What of requested date intervals is not loaded yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.joins import spread_join
from stratalake.sources.scratch import store

#: Days of a bucket, one bit each of a 64-bit number.
BUCKET_DAYS = 64


def _bits(first: Column, last: Column) -> Column:
    """The bits ``first`` to ``last`` (0 to 63, both included) of a long."""
    return F.call_function("shiftleft", F.lit(-1).cast("long"), first).bitwiseAND(
        F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), F.lit(BUCKET_DAYS - 1) - last)
    )


def interval_masks(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row per bucket of 64 days that [start, end] touches: ``_bucket`` and the touched days as bits of ``_mask``.

    Buckets are fixed (numbered from 1970-01-01), so intervals of different rows meet in equal buckets. A row with a NULL end, or that ends before it
    starts, touches none.
    """
    first, last = (F.unix_date(F.col(f"`{c}`").cast("date")) for c in (start, end))
    bucket = lambda day: F.floor(day / F.lit(BUCKET_DAYS)).cast("int")
    buckets = F.when(first <= last, F.sequence(bucket(first), bucket(last)))
    cut = df.select("*", first.alias("_first"), last.alias("_last"), F.explode(buckets).alias("_bucket"))
    base = F.col("_bucket") * BUCKET_DAYS
    low, high = F.greatest(F.col("_first") - base, F.lit(0)), F.least(F.col("_last") - base, F.lit(BUCKET_DAYS - 1))
    return cut.withColumn("_mask", _bits(low, high)).drop("_first", "_last")


def _runs(mask: Column) -> Column:
    """``(low, high)`` of every unbroken run of bits, ascending."""
    places = F.sequence(F.lit(0), F.lit(BUCKET_DAYS - 1))
    bit = lambda i: F.call_function("getbit", mask, i) == 1
    lows = F.filter(places, lambda i: bit(i) & ((i == 0) | ~bit(F.greatest(i - 1, F.lit(0)))))
    highs = F.filter(places, lambda i: bit(i) & ((i == BUCKET_DAYS - 1) | ~bit(F.least(i + 1, F.lit(BUCKET_DAYS - 1)))))
    return F.arrays_zip(lows.alias("low"), highs.alias("high"))


def pending_intervals(
    requested: DataFrame, loaded: DataFrame, keys: Sequence[str], start: str = "interval_start", end: str = "interval_end"
) -> DataFrame:
    """The requested rows, cut to the days that no loaded interval of the same key covers.

    ``start`` and ``end`` are dates, both ends included, in both frames. A row whose interval is covered goes; one that is partly covered comes once for each
    longest stretch of days left, with ``start`` and ``end`` set to it. Equal requests count once. A request with a NULL key is never covered; one with a
    NULL end, or an end before its start, asks for nothing.

    Intervals meet in fixed buckets of 64 days. What is loaded is one 64-bit number per key and bucket, put together by a bitwise or with map-side
    combining, so overlapping, repeated and hot loads cost one row each; requests take away its bits in an equality join, in which a hot key can be
    split. Only buckets of one request are put in order, to join stretches that go on in the next bucket.
    """
    keys = list(keys)
    covered = interval_masks(loaded.select(*keys, start, end), start, end).groupBy(*keys, "_bucket").agg(F.bit_or("_mask").alias("_covered"))
    asked = requested.distinct()
    pieces = interval_masks(asked, start, end)
    joined = spread_join(pieces, store(covered, "covered"), [*keys, "_bucket"], "left")
    free = F.col("_mask").bitwiseAND(F.bitwise_not(F.coalesce("_covered", F.lit(0).cast("long"))))
    runs = joined.withColumn("_free", free).where("_free != 0").withColumn("_run", F.explode(_runs(F.col("_free"))))
    days = {f"_{side}": F.col("_bucket") * BUCKET_DAYS + F.col(f"_run.{side}") for side in ("low", "high")}
    runs = runs.withColumns(days).select(*[F.col(f"`{c}`") for c in requested.columns], "_low", "_high")
    own = Window.partitionBy(*[F.col(f"`{c}`") for c in requested.columns]).orderBy("_low")
    begins = F.coalesce(F.col("_low") != F.lag("_high").over(own) + 1, F.lit(True))
    stretch = F.sum(begins.cast("int")).over(own.rowsBetween(Window.unboundedPreceding, 0))
    grouped = runs.withColumn("_stretch", stretch).groupBy(*[F.col(f"`{c}`") for c in requested.columns], "_stretch")
    merged = grouped.agg(F.min("_low").alias("_low"), F.max("_high").alias("_high"))
    ends = {start: F.date_from_unix_date("_low"), end: F.date_from_unix_date("_high")}
    return merged.select(*[ends[c].cast(requested.schema[c].dataType).alias(c) if c in ends else F.col(f"`{c}`") for c in requested.columns])
