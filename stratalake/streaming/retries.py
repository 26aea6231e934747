"""Attempts per key over deliveries of load results, given up after a number of failures."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stratalake.streaming.incremental import append_sink

#: The state store that keeps keys on disk, with changes only in its checkpoints.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PENDING, LOADED, GAVE_UP = "pending", "loaded", "gave up"
STATE = "attempts int, status string"


class Attempts(StatefulProcessor):
    """Counts a key's failures until it is loaded or has failed ``limit`` times; what comes later changes nothing.

    Of a delivery only the first success and the ``limit`` first failures can matter, so no more than these are held, however many rows a key has.
    """

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("attempts", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        attempts, status = self.state.get() if self.state.exists() else (0, PENDING)
        if status != PENDING:
            return
        failures, success = [], None
        for some in rows:
            good = some.loc[some["ok"], "seq"]
            if len(good):
                success = int(good.min()) if success is None else min(success, int(good.min()))
            failures = heapq.nsmallest(self.limit, [*failures, *some.loc[~some["ok"], "seq"].astype("int64").tolist()])
        before = [f for f in failures if success is None or f < success]
        attempts = min(attempts + len(before), self.limit)
        status = GAVE_UP if attempts >= self.limit else PENDING if success is None else LOADED
        self.state.update((attempts, status))
        yield pd.DataFrame({"known": [bool(key[0])], "text": [key[1]], "attempts": pd.array([attempts], "int32"), "status": [status]})

    def close(self) -> None:
        pass


def track_attempts(spark: SparkSession, source: str, schema: T.StructType, limit: int, path: str, fmt: str = "json", max_files_per_batch: int = 10_000) -> None:
    """Take new files of results ``key, seq, ok`` from ``source`` into the keys' state and return.

    ``seq`` orders a key's results within a batch of files; batches are in the order the files arrived. The state and which files were read lie in
    ``path/checkpoint``: a run that stops is continued by the next one, which repeats its batch on the state from before it. Changes go to ``path/changes``, one folder
    per batch, which a repeated batch replaces. A NULL key is a key; a NULL result is none.
    """
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, STATE_STORE)
    try:
        results = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files_per_batch).load(source)
        # Grouped by the key's text and whether there is one: with a NULL among the grouping keys, groups of its task get lost.
        known, text = F.col("key").isNotNull().alias("known"), F.coalesce(F.col("key").cast("string"), F.lit("")).alias("text")
        kept = results.where("ok IS NOT NULL AND seq IS NOT NULL").select(known, text, "seq", "ok")
        out = T._parse_datatype_string(f"known boolean, text string, {STATE}")
        changes = kept.groupBy("known", "text").transformWithStateInPandas(Attempts(limit), out, "Update", "None")
        changes = changes.select(F.when(F.col("known"), F.col("text").cast(schema["key"].dataType)).alias("key"), "attempts", "status")
        query = changes.writeStream.foreachBatch(append_sink(f"{path}/changes")).outputMode("update")
        query.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(setting, before)


def attempt_states(spark: SparkSession, path: str) -> DataFrame:
    """``key, attempts, status`` as of the last change of each key."""
    changes = spark.read.parquet(f"{path}/changes")
    last = F.max_by(F.struct("attempts", "status"), "batch_id").alias("last")
    return changes.groupBy("key").agg(last).select("key", "last.attempts", "last.status")
