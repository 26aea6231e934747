"""Table writers: overwrite, append, upsert, partitioned layout and run metadata."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.clock import parse_date
from stratalake.operators.joins import spread_join
from stratalake.sources.scratch import discard, store


def table_exists(spark: SparkSession, db: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{db}.{table}")


def _table_writer(df: DataFrame, fmt: str, mode: str, partition_by: Sequence[str]):
    if partition_by:
        # rows of one folder together; adaptive execution splits a crowded folder and merges small ones
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


#: Formats of plain files, which have no transactions of their own.
PLAIN_FORMATS = ("parquet", "orc", "json", "csv", "avro", "text")


def _rename(spark: SparkSession, old: str, new: str) -> None:
    """Rename a table; some catalogs leave its partitions at the old place, so they are looked up anew."""
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
    if partition_columns(spark, new):
        spark.sql(f"MSCK REPAIR TABLE {new} SYNC PARTITIONS")


def _finish_swap(spark: SparkSession, db: str, table: str) -> None:
    """Complete a swap that stopped after the old table gave up its name; the new one was whole by then."""
    if not table_exists(spark, db, table):
        for copy in (f"{table}__next", f"{table}__old"):
            if table_exists(spark, db, copy):
                _rename(spark, f"{db}.{copy}", f"{db}.{table}")
                return


def _swap(df: DataFrame, db: str, table: str, fmt: str, partition_by: Sequence[str]) -> DataFrame:
    """Write a second table that then takes the name; the old one is dropped last, so a failed write leaves it as it was."""
    spark, full = df.sparkSession, f"{db}.{table}"
    spark.sql(f"DROP TABLE IF EXISTS {full}__next")
    spark.sql(f"DROP TABLE IF EXISTS {full}__old")
    try:
        _table_writer(df, fmt, "errorifexists", partition_by).saveAsTable(f"{full}__next")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {full}__next")
        raise
    if table_exists(spark, db, table):
        _rename(spark, full, f"{full}__old")
    _rename(spark, f"{full}__next", full)
    spark.sql(f"DROP TABLE IF EXISTS {full}__old")
    return spark.table(full)


def overwrite_table(
    df: DataFrame, db: str, table: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Create the database if needed, replace the table and return it. If the write fails, the old table stays.

    Plain files are written beside the old ones and take the name when they are whole; other formats replace in one step.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    if fmt in PLAIN_FORMATS:
        _finish_swap(spark, db, table)
        return _swap(df, db, table, fmt, partition_by)
    writer = df.writeTo(f"{db}.{table}").using(fmt)
    (writer.partitionedBy(*[F.col(c) for c in partition_by]) if partition_by else writer).createOrReplace()
    return spark.table(f"{db}.{table}")


def append_table(
    df: DataFrame, db: str, table: str, fmt: str = "parquet", partition_by: Sequence[str] = (), add_columns: bool = False
) -> DataFrame:
    """Append by column name, creating the table when it is missing.

    A column that the table does not have is an error, or with ``add_columns`` is added to it, NULL in older rows.
    A column that only the table has is NULL in the new rows.
    """
    spark, full = df.sparkSession, f"{db}.{table}"
    if not table_exists(spark, db, table):
        return overwrite_table(df, db, table, fmt, partition_by)
    target = spark.table(full)
    new = [f for f in df.schema.fields if f.name not in target.columns]
    if new and not add_columns:
        raise ValueError(f"{full} has no columns {[f.name for f in new]}")
    if new:
        spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
        target = spark.table(full)
    rows = df.select([F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    _table_writer(rows, fmt, "append", partition_by or partition_columns(spark, full)).saveAsTable(full)
    return spark.table(full)


def partition_columns(spark: SparkSession, full: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(full) if c.isPartition]


def table_location(spark: SparkSession, db: str, table: str) -> DataFrame:
    """One row with the physical location of a table."""
    return (
        spark.sql(f"DESCRIBE FORMATTED {db}.{table}")
        .filter(F.col("col_name") == "Location")
        .select(F.col("data_type").alias("location"))
    )


def load_summary(df: DataFrame, db: str, table: str) -> DataFrame:
    """Overwrite a table and report ``rows`` and ``table`` for the load."""
    stored = overwrite_table(df, db, table)
    return stored.agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(f"{db}.{table}"))


# ---- upsert ---------------------------------------------------------------

def upsert_merge(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` after a merge: matched rows take the source, unmatched source rows are added.

    NULL keys never match, so such source rows are added. A source key that
    occurs twice and matches a target row is an error, raised when the plan runs.
    The target is read once and joined with one row per source key, which says both whether
    a row is replaced and whether that is ambiguous; a key that is hot in the target can be split.
    """
    keys = list(keys)
    usable = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = source.filter(usable).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    clash = F.raise_error(F.lit("upsert: several source rows match one target row")).cast("boolean")
    untouched = spread_join(target, counts, keys, "left").filter(F.when(F.col("_n") > 1, clash).otherwise(F.col("_n").isNull()))
    return untouched.select(target.columns).unionByName(source.select(target.columns))


def _upsert_partitions(source: DataFrame, full: str, keys: Sequence[str], parts: list[str]) -> None:
    """Rewrite only the partitions that source rows go to or that hold a row they replace."""
    spark = source.sparkSession
    target = spark.table(full)
    hit = target.join(source.select(*keys).distinct(), list(keys), "left_semi")
    touched = store(source.select(*parts).union(hit.select(*parts)).distinct(), "touched")
    same = reduce(lambda a, b: a & b, [F.col(f"t.{c}").eqNullSafe(F.col(f"p.{c}")) for c in parts])
    old = target.alias("t").join(touched.alias("p"), same, "left_semi")
    merged = store(upsert_merge(old, source, keys), "merged")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        merged.select(target.columns).hint("rebalance", *parts).write.insertInto(full, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    left = merged.select(*parts).distinct()
    same = reduce(lambda a, b: a & b, [F.col(f"p.{c}").eqNullSafe(F.col(f"m.{c}")) for c in parts])
    for row in touched.alias("p").join(left.alias("m"), same, "left_anti").collect():  # partitions that lost all rows
        spec = ", ".join(f"`{c}` = " + ("NULL" if row[c] is None else f"'{row[c]}'") for c in parts)
        spark.sql(f"ALTER TABLE {full} DROP IF EXISTS PARTITION ({spec})")
    discard(touched, merged)


def upsert_table(source: DataFrame, db: str, table: str, keys: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Merge a frame into a stored table, creating it when missing (``fmt`` counts only then).

    Formats with row-level operations get a MERGE statement. Plain files cannot
    be merged or read while overwritten: of a partitioned table the touched partitions are written anew; of another one all rows go
    to a second table that then takes the name, and the old one is dropped last. A run that stopped
    in between is completed by the next one, so no step loses data.
    """
    spark = source.sparkSession
    _finish_swap(spark, db, table)
    if not table_exists(spark, db, table):
        return overwrite_table(source, db, table, fmt)
    full = f"{db}.{table}"
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {full}").collect()}
    provider = about.get("Provider", fmt).lower()
    if provider not in PLAIN_FORMATS:
        on = " AND ".join(f"target.`{k}` = source.`{k}`" for k in keys)
        spark.sql(
            f"MERGE INTO {full} AS target USING {{source}} AS source ON {on} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *",
            source=source,
        )
    elif parts := partition_columns(spark, full):
        _upsert_partitions(source, full, keys, parts)
    else:
        _swap(upsert_merge(spark.table(full), source, keys), db, table, provider, ())
    return spark.table(full)


# ---- partitioned layout ---------------------------------------------------

def with_year_month(df: DataFrame, date_column: str, pattern: str | None = None) -> DataFrame:
    """Add ``year`` and ``month``; ``pattern`` parses a text date first."""
    day = parse_date(F.col(date_column), pattern) if pattern else F.col(date_column)
    return df.withColumns({"year": F.year(day), "month": F.month(day)})


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("year", "month"),
    max_rows_per_file: int = 5_000_000,
    mode: str = "overwrite",
) -> DataFrame:
    """Write ``by=`` folders of files with a bounded number of rows and return the stored table."""
    _table_writer(df, "parquet", mode, list(by)).option("maxRecordsPerFile", max_rows_per_file).save(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---- run metadata and rejects ---------------------------------------------

def batch_metadata(df: DataFrame, entity: str, date_column: str) -> DataFrame:
    """One row: record count, distinct entities and date span of a batch."""
    return df.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.countDistinct(entity).alias("n_entities"),
        F.min(F.col(date_column).cast("date")).alias("first_date"),
        F.max(F.col(date_column).cast("date")).alias("last_date"),
    )


def write_batch(df: DataFrame, path: str, entity: str, date_column: str) -> DataFrame:
    """Write a batch as JSON lines with its metadata beside it; returns the metadata."""
    df.write.mode("overwrite").json(f"{path}/data")
    meta = batch_metadata(df, entity, date_column)
    meta.write.mode("overwrite").json(f"{path}/metadata")
    return df.sparkSession.read.schema(meta.schema).json(f"{path}/metadata")


def log_rejects(rejects: DataFrame, path: str, mode: str = "append") -> None:
    """Write failed rows to a log of JSON lines that ``read_rejects`` reads back; ``overwrite`` keeps only this run's."""
    rejects.write.mode(mode).option("ignoreNullFields", False).json(path)
