"""Windowed sums of a stream whose late rows are kept, not dropped.

Two forms. ``drain_windows`` sums each micro-batch by window with Spark's own functions and
stores the sums, so no state is held between batches; rows of windows that closed before
the batch go to a side table as they are. ``timed_windows`` holds the sums in keyed state
with a timer for each window: a window is passed on when its timer fires and its state is
dropped; rows that come later are passed on as they are.

In both a window is closed for a batch if it ended ``lateness`` seconds or more before the
newest row of all earlier batches, so a batch that runs twice decides as it did before.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from paylens.functions.dates import epoch
from paylens.session import scratch_path
from paylens.sources.readers import read_or_skip
from paylens.streaming.sinks import drain

#: How late a row of a live feed may come, in seconds.
LATENESS = 31 * 86_400

_MARKS = "batch_id long, newest long"


def _windows_of(rows: DataFrame, ts: str, width: int, slide: int) -> DataFrame:
    """Rows with ``second`` and a ``bucket`` for each window (``width`` long, one every ``slide``) that holds them."""
    second = epoch(F.col(ts))
    last = F.floor(second / slide).cast("long") * slide
    starts = F.array(*[last - i * slide for i in range(-(-width // slide))])
    spread = rows.withColumn("second", second).withColumn("bucket", F.explode(F.filter(starts, lambda s: s + width > second)))
    return spread


def window_sums(rows: DataFrame, keys: list[str], amount: Column | None) -> DataFrame:
    """Count, sum and newest second of rows (``bucket``, ``second``) by window and keys."""
    measures = [F.count(F.lit(1)).alias("n"), F.max("second").alias("newest_epoch")]
    if amount is not None:
        measures.append(F.sum(amount).alias("amount"))
    return rows.groupBy("bucket", *keys).agg(*measures)


def merged(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of several batches, or of closed windows and their late rows, as one."""
    measures = [F.sum("n").alias("n"), F.max("newest_epoch").alias("newest_epoch")]
    if "amount" in sums.columns:
        measures.append(F.sum("amount").alias("amount"))
    return sums.groupBy("bucket", *keys).agg(*measures)


def drain_windows(
    spark: SparkSession, stream: DataFrame, ts: str, width: int, label: str, amount: Column | None = None, slide: int | None = None,
    keys: list[str] | None = None, lateness: int = LATENESS,
) -> tuple[DataFrame, DataFrame]:
    """Run a stream to its end; returns the sums of windows (bucket, keys, n, newest_epoch, amount) and the late rows.

    A late row is in the side table once for each closed window that it belongs to, with
    that window's ``bucket`` and the ``batch_id`` it came in. Rows without a time are in no window.
    """
    keys, out = keys or [], scratch_path(spark, label)

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        marks, _ = read_or_skip(session, f"{out}/marks")
        earlier = None if marks is None else marks.where(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
        rows = _windows_of(batch, ts, width, slide or width)
        if earlier is not None:
            closed = F.col("bucket") + width <= earlier - lateness
            rows.where(closed).write.mode("overwrite").parquet(f"{out}/late/batch_id={batch_id}")
            rows = rows.where(~closed)
        window_sums(rows, keys, amount).write.mode("overwrite").parquet(f"{out}/sums/batch_id={batch_id}")
        newest = session.read.parquet(f"{out}/sums/batch_id={batch_id}").agg(F.lit(batch_id).cast("long").alias("batch_id"), F.max("newest_epoch").alias("newest"))
        newest.write.mode("overwrite").parquet(f"{out}/marks/of_batch={batch_id}")

    drain(stream, handle, f"{out}/checkpoint")
    sums, _ = read_or_skip(spark, f"{out}/sums")
    empty = _windows_of(spark.createDataFrame([], stream.schema), ts, width, slide or width)
    totals = merged(window_sums(empty, keys, amount) if sums is None else sums, keys)
    late, _ = read_or_skip(spark, f"{out}/late")
    return totals, empty.withColumn("batch_id", F.lit(0)) if late is None else late


def complete_windows(
    spark: SparkSession, stream: DataFrame, ts: str, width: int, label: str, amount: Column | None = None, slide: int | None = None,
    keys: list[str] | None = None, lateness: int = LATENESS,
) -> DataFrame:
    """Sums of all windows with their late rows added: those of a batch job, in whatever order files came."""
    totals, late = drain_windows(spark, stream, ts, width, label, amount, slide, keys, lateness)
    return merged(totals.unionByName(window_sums(late, keys or [], amount)), keys or [])


class WindowTotals(StatefulProcessor):
    """Sums of one window (its key) in state, dropped when the window's timer fires."""

    def __init__(self, width: int):
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "n long, cents long, newest long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        end = (key[0] + self.width) * 1000
        if end <= timerValues.getCurrentWatermarkInMs():
            for part in rows:
                yield pd.DataFrame({"kind": "late", "bucket": key[0], "n": 1, "cents": part["cents"], "newest": part["second"]})
            return
        n, cents, newest = self.sums.get() if self.sums.exists() else (0, 0, None)
        if not n:
            self.handle.registerTimer(end)
        for part in rows:
            last = int(part["second"].max())
            n, cents, newest = n + len(part), cents + int(part["cents"].sum()), last if newest is None else max(newest, last)
        self.sums.update((n, cents, newest))
        yield pd.DataFrame({"kind": ["open"], "bucket": [key[0]], "n": [n], "cents": [cents], "newest": [newest]})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        n, cents, newest = self.sums.get()
        self.sums.clear()
        yield pd.DataFrame({"kind": ["closed"], "bucket": [key[0]], "n": [n], "cents": [cents], "newest": [newest]})

    def close(self) -> None:
        pass


def timed_windows(stream: DataFrame, ts: str, width: int, cents: Column, lateness: int = LATENESS) -> DataFrame:
    """``kind, bucket, n, cents, newest``: sums of open windows as they change, of closed ones once, and late rows one by one.

    The state store must be able to hold timers: see ``timer_store``.
    """
    second = epoch(F.col(ts))
    marked = stream.withColumn("_at", F.timestamp_seconds(second)).withWatermark("_at", f"{lateness} seconds")
    # Without the watermark's own column Spark passes late rows on to the processor, which tells them apart.
    rows = marked.select((F.floor(second / width) * width).cast("long").alias("bucket"), second.alias("second"), F.coalesce(cents, F.lit(0)).cast("long").alias("cents"))
    return rows.groupBy("bucket").transformWithStateInPandas(
        WindowTotals(width), "kind string, bucket long, n long, cents long, newest long", "Update", "EventTime"
    )


@contextmanager
def timer_store(spark: SparkSession):
    """State stores with timers and named columns, for streams started inside."""
    name, kind = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name, None)
    spark.conf.set(name, kind)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
