"""Exact batches of a fixed number of rows, written once each."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.sources.scratch import _files, discard, store

#: Rows that one task numbers.
ROWS_PER_RANGE = 500_000


def _numbered(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str, ranges: int | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """What :func:`dense_numbers` returns, and the stored tables it reads."""
    by, order = list(by), list(order)
    columns = [F.col(f"`{c}`") for c in df.columns]
    ranges = ranges or max(1, ceil(df.count() / ROWS_PER_RANGE))
    keys = [*by, *order, F.xxhash64(*columns)]
    dealt = df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    # The id is the partition's number and, in the lowest 33 bits, the row's place in it.
    dealt = store(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    placed = dealt.withColumn("_range", F.shiftrightunsigned("_at", 33))
    held = placed.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_held"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    shift = F.coalesce(F.sum("_held").over(earlier), F.lit(0)) - F.col("_first")
    offsets = store(held.select(*by, "_range", shift.alias("_shift")), "offsets")
    same = reduce(lambda a, b: a & b, [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*by, "_range")])
    numbered = placed.alias("r").join(offsets.alias("o"), same)
    numbered = numbered.select(*[F.col(f"r.`{c}`") for c in df.columns], (F.col("_at") + F.col("_shift")).cast("long").alias(out))
    return numbered, [dealt, offsets]


def dense_numbers(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str, ranges: int | None = None) -> DataFrame:
    """Number the rows of each ``by`` group from 0 without gaps in the order given, ties by a hash of the whole row.

    Rows are dealt out by ranges of group and order, one range for every ``ROWS_PER_RANGE`` rows; every range is sorted and written once, each row with its place, and
    starts after what earlier ranges hold of the group. So a group of any size is many tasks, and a small one part of a task. Equal rows
    are interchangeable. NULLs are a group of their own, and come first in the order. The frame is read to count it, to choose the ranges and to deal it out.
    """
    return _numbered(df, by, order, out, ranges)[0]


def _batch_of(number: str, size: int) -> Column:
    return F.floor(F.col(number) / F.lit(size)).cast("int")


def _check_size(size: int) -> None:
    if size < 1:
        raise ValueError("a batch holds a row at least")


def number_batches(df: DataFrame, by: Sequence[str], order: Sequence[str], size: int, out: str = "batch") -> DataFrame:
    """Add the row's batch: ``size`` rows of a group make one, numbered from 0; only a group's last batch is smaller."""
    _check_size(size)
    return dense_numbers(df, by, order, "_number").withColumn(out, _batch_of("_number", size)).drop("_number")


def read_ledger(spark: SparkSession, path: str, schema) -> DataFrame:
    """The last entry of each batch: group, ``batch, n_rows, digest, load``; empty before the first load."""
    fs, at = _files(spark, f"{path}/ledger")
    if not fs.exists(at):
        return spark.createDataFrame([], schema)
    entries = spark.read.schema(schema).parquet(f"{path}/ledger")
    names = [c for c in entries.columns if c not in ("n_rows", "digest", "load")]
    last = F.max_by(F.struct("n_rows", "digest", "load"), "load").alias("last")
    return entries.groupBy(*names).agg(last).select(*names, "last.*")


def load_batches(df: DataFrame, by: Sequence[str], order: Sequence[str], size: int, path: str) -> DataFrame:
    """Write the frame as batches below ``path`` and return the ledger entries of the batches this run wrote.

    Batches are folders ``rows/<group>/batch=<n>``, with a file from each task that holds rows of the batch; ``ledger`` says of each how many rows it holds and the sum of their hashes. A batch that the ledger has with that sum
    is not written again, so repeating a load adds nothing; one whose rows have changed, as late rows of its group shift those after them, replaces its folder. The ledger is
    written after the batches: a run that stops between the two writes the same folders again, and no row is stored twice. Batches beyond
    the end of a group that has shrunk are not taken away.
    """
    spark, by = df.sparkSession, list(by)
    _check_size(size)
    rows, stored = _numbered(df, by, order, "_number")
    rows = rows.withColumn("batch", _batch_of("_number", size)).drop("_number")
    names = [*by, "batch"]
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    found = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(row).cast("decimal(38,0)").alias("digest"))
    schema = found.withColumn("load", F.lit(0).cast("long")).schema
    for field in schema.fields:
        field.nullable = True
    ledger = read_ledger(spark, path, schema)
    load = (ledger.agg(F.max("load")).first()[0] or 0) + 1
    same = reduce(lambda a, b: a & b, [F.col(f"f.{c}").eqNullSafe(F.col(f"l.{c}")) for c in (*names, "digest", "n_rows")])
    fresh = found.alias("f").join(ledger.alias("l"), same, "left_anti").select("f.*")
    fresh = store(fresh.withColumn("load", F.lit(load).cast("long")), "fresh")
    # The folder names carry the group; its columns are written under names of their own and so keep their type and NULLs.
    keyed = rows.withColumns({f"in_{c}": F.col(f"`{c}`") for c in by})
    match = reduce(lambda a, b: a & b, [F.col(f"k.{c}").eqNullSafe(F.col(f"n.{c}")) for c in names])
    new = keyed.alias("k").join(fresh.select(*names).alias("n"), match, "left_semi")
    folders = [f"in_{c}" for c in by] + ["batch"]
    # The stored ranges are in this order already, so they need not be dealt out once more.
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(f"{path}/rows")
    fresh.write.mode("append").parquet(f"{path}/ledger")
    discard(*stored)
    return fresh


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All stored rows with their ``batch``."""
    stored = spark.read.parquet(f"{path}/rows")
    return stored.select(*[F.col(f"`{c}`") for c in stored.columns if not c.startswith("in_")])
