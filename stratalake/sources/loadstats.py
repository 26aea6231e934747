"""Statistics stored with every load, which answer for all loads without reading their rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: log2 of the registers of a distinct sketch: a standard error of 1.04 / 64 = 1.6 %.
DISTINCT_LOG_REGISTERS = 12
#: Size parameter of a quantile sketch: ranks are right to about 0.7 % of the rows.
QUANTILE_SIZE = 400


def record_load(
    rows: DataFrame,
    load: str,
    path: str,
    by: Sequence[str] = (),
    distinct: Sequence[str] = (),
    numbers: Sequence[str] = (),
    day: str | None = None,
    log_registers: int = DISTINCT_LOG_REGISTERS,
    size: int = QUANTILE_SIZE,
) -> None:
    """Store a load's entries below ``path``: one per ``by`` group (a month, say), or one.

    An entry has ``n_rows``, ``first_day`` and ``last_day`` of the ``day`` column, for each ``distinct`` column a HyperLogLog sketch and for each of
    ``numbers`` a KLL sketch (NULL and NaN left out). Both kinds are put together from partial sketches of the tasks, and can be merged with those of other loads. A
    load that is recorded again replaces its entries; recording needs no other load's rows or entries. A load without rows has no entries (one with ``n_rows`` 0
    where there are no groups).
    """
    number = lambda c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))
    columns = [F.count(F.lit(1)).alias("n_rows")]
    if day is not None:
        columns += [F.min(F.col(f"`{day}`").cast("date")).alias("first_day"), F.max(F.col(f"`{day}`").cast("date")).alias("last_day")]
    columns += [F.hll_sketch_agg(f"`{c}`", log_registers).alias(f"distinct_{c}") for c in distinct]
    columns += [F.kll_sketch_agg_double(number(c), F.lit(size)).alias(f"quantiles_{c}") for c in numbers]
    rows.groupBy(*by).agg(*columns).write.mode("overwrite").parquet(f"{path}/load={load}")


def load_entries(spark: SparkSession, path: str) -> DataFrame:
    """All stored entries with their ``load``."""
    entries = spark.read.option("mergeSchema", "true").parquet(path)
    return entries.withColumn("load", F.col("load").cast("string"))


def load_totals(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """Of all loads together, per ``by`` group: ``n_loads, n_rows, first_day, last_day`` and ``<column>_estimate`` of different values.

    A value that several loads hold counts once; a row that several loads hold counts as often in ``n_rows``.
    """
    entries = load_entries(spark, path)
    columns = [F.countDistinct("load").alias("n_loads"), F.sum("n_rows").alias("n_rows")]
    if "first_day" in entries.columns:
        columns += [F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")]
    sketches = [c for c in entries.columns if c.startswith("distinct_")]
    columns += [F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"{c.removeprefix('distinct_')}_estimate") for c in sketches]
    return entries.groupBy(*by).agg(*columns)


def merged_quantiles(spark: SparkSession, path: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``column_name, prob, value, n`` of all loads together, per ``by`` group: sketched quantiles and how many numbers they are of.

    A group without numbers has no rows.
    """
    entries = load_entries(spark, path)
    sketches = [c for c in entries.columns if c.startswith("quantiles_")]
    merged = entries.groupBy(*by).agg(*[F.kll_merge_agg_double(c).alias(c) for c in sketches])

    def rows(sketch: str, prob: float) -> Column:
        known = F.kll_sketch_get_n_double(sketch) > 0
        value = F.when(known, F.kll_sketch_get_quantile_double(sketch, F.lit(float(prob))))
        name = F.lit(sketch.removeprefix("quantiles_")).alias("column_name")
        return F.struct(name, F.lit(float(prob)).alias("prob"), value.alias("value"), F.kll_sketch_get_n_double(sketch).alias("n"))

    return merged.select(*by, F.inline(F.array(*[rows(s, p) for s in sketches for p in probs]))).where("n > 0")
