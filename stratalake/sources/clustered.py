"""Files clustered by an order of their rows, with an index of each file's least and greatest value."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a file.
ROWS_PER_FILE = 5_000_000


def write_clustered(df: DataFrame, path: str, order: Sequence[str], rows_per_file: int = ROWS_PER_FILE, files: int | None = None) -> DataFrame:
    """Write the frame sorted by ``order`` within files that hold a range of it each, and return the index that is stored beside them.

    Rows are dealt out by ranges of the order and sorted inside their task, so no task sees more than its file. The index, ``file, n_rows, least, greatest`` of the first
    column of the order, comes from reading that column back, where Spark finds it by file. ``files`` sets their number; else it follows
    from the rows. NULLs stand first, and a file of NULLs alone has no least value. What ``path`` held is replaced.
    """
    spark, first = df.sparkSession, order[0]
    files = files or max(1, ceil(df.count() / rows_per_file))
    df.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{path}/rows")
    stored = spark.read.schema(df.schema).parquet(f"{path}/rows")
    named = stored.select(F.col("_metadata.file_path").alias("file"), F.col(f"`{first}`").alias("v"))
    index = named.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.min("v").alias("least"), F.max("v").alias("greatest"))
    index.write.mode("overwrite").parquet(f"{path}/index")
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def files_between(spark: SparkSession, path: str, low, high) -> list[str]:
    """The files that hold a value from ``low`` to ``high``, as the index says; as many as Spark lists for a read."""
    hit = read_index(spark, path).filter((F.col("greatest") >= F.lit(low)) & (F.col("least") <= F.lit(high)))
    return [row["file"] for row in hit.select("file").orderBy("file").collect()]


def read_clustered(spark: SparkSession, path: str, column: str, low, high) -> DataFrame:
    """Rows whose ``column``, the first of the order, is from ``low`` to ``high``; other files are not opened."""
    schema = spark.read.parquet(f"{path}/rows").schema
    files = files_between(spark, path, low, high)
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return rows.filter(F.col(f"`{column}`").between(F.lit(low), F.lit(high)))


def disorder(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``file, n_rows, n_disordered``: rows that are smaller than the row before them in their file."""
    rows = spark.read.parquet(f"{path}/rows")
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("i"), F.col(f"`{column}`").alias("v"))
    before = F.lag("v").over(Window.partitionBy("file").orderBy("i"))  # a file's rows
    marked = rows.withColumn("worse", (F.col("v").isNull() & before.isNotNull()) | (F.col("v") < before))
    return marked.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("worse").alias("n_disordered"))
