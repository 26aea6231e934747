"""Daily downloads as an incremental file stream.

Each run picks up the files that arrived since the last one and stops. The
stream's checkpoint remembers what was loaded, so a failed run is simply repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratalake.sources.writers import upsert_table

Sink = Callable[[DataFrame, int], None]


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    sink: Sink,
    checkpoint: str,
    fmt: str = "json",
    max_files_per_batch: int = 10_000,
    **options: str,
) -> None:
    """Feed new files of a landing folder to the sink in batches, then return."""
    stream = (
        spark.readStream.format(fmt)
        .schema(schema)
        .options(**options)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .load(source)
    )
    query = (
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def append_sink(path: str) -> Sink:
    """Write every batch to its own folder; a repeated batch replaces itself, so no row is stored twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def upsert_sink(db: str, table: str, keys: Sequence[str]) -> Sink:
    """Merge every batch into a table; repeating a batch changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch, db, table, keys)

    return write
