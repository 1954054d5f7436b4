"""Sinks of micro-batches.

Every handler writes below a folder named after its batch id and replaces it, so a
batch that runs twice after a failure leaves the same files.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.operators import recovery
from paylens.operators.dedup import latest_per_key
from paylens.session import scratch_path
from paylens.sources.writers import merge_insert, write_run_metadata


def drain(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> int:
    """Process everything that has arrived, then stop; returns how many rows came too late for their window.

    Spark counts them after a batch's partial sums, so late rows of one window and batch may count once.
    """
    dropped, started = {}, []

    def note(progress) -> None:
        if progress is not None:
            states = json.loads(progress.json)["stateOperators"]
            dropped[progress.batchId] = max(dropped.get(progress.batchId, 0), sum(s.get("numRowsDroppedByWatermark", 0) for s in states))

    def handled(batch: DataFrame, batch_id: int) -> None:
        # Spark keeps the progress of the newest batches only, so each is noted when the next one comes.
        for running in started:
            note(running.lastProgress)
        handle(batch, batch_id)

    query = (
        stream.writeStream.outputMode(mode).foreachBatch(handled).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    started.append(query)
    query.awaitTermination()
    for progress in query.recentProgress:
        note(progress)
    return sum(dropped.values())


def store_updates(path: str) -> Callable[[DataFrame, int], None]:
    """Keep the rows of each batch; the newest batch holds a key's final value."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return handle


def collect_windows(spark: SparkSession, windows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Run a windowed stream to its end and read the final value of every window.

    Rows beyond the stream's lateness, if it has one, are in no window; their number is
    kept below ``late`` beside the rows, so that it can be watched.
    """
    out = scratch_path(spark, label)
    late = drain(windows, store_updates(f"{out}/rows"), f"{out}/checkpoint", "update")
    write_run_metadata(spark, {"stream": label, "late_rows": late}, f"{out}/late")
    return latest_per_key(spark.read.parquet(f"{out}/rows"), keys, [F.desc("batch_id")]).drop("batch_id")


def upsert_into(spark: SparkSession, target: str, key: str, order: list[Column], run: str) -> Callable[[DataFrame, int], None]:
    """Insert-only merge of each batch into the target folder."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        merge_insert(batch.sparkSession, batch, target, key, order, f"{run}-{batch_id}")

    return handle


def repair_and_split(path: str) -> Callable[[DataFrame, int], None]:
    """Repair each batch and write clean and rejected rows in one pass, side by side."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        judged = recovery.repair(batch).withColumn("reason", F.coalesce(recovery.reject_reason(), F.lit("")))
        marked = judged.withColumn("outcome", F.when(F.col("reason") == "", "clean").otherwise("quarantine"))
        rows = marked.withColumn("batch_id", F.lit(batch_id))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("outcome", "batch_id").parquet(path)

    return handle
