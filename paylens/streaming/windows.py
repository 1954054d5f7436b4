"""Windowed aggregates; they work on streams and on batches alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions.dates import epoch


#: How late a row of a live feed may come; state is dropped beyond it. A given table is read without a bound, as its files come in any order.
LATENESS = "31 days"


def with_lateness(stream: DataFrame, ts: str, lateness: str | None) -> DataFrame:
    """Bound the state by a watermark: windows that end longer ago than ``lateness`` before the newest row are closed.

    Without one no row is ever too late: right for a backfill whose files come in any order.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, lateness) if lateness else timed


def windowed(
    stream: DataFrame, ts: str, width: str, amount: Column | None = None, slide: str | None = None,
    keys: list[str] | None = None, lateness: str | None = LATENESS,
) -> DataFrame:
    """Count, sum and newest time per window, with the window's start as epoch seconds."""
    measures = [F.count(F.lit(1)).alias("n"), F.max(ts).alias("newest")]
    if amount is not None:
        measures.append(F.sum(amount).alias("amount"))
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    grouped = with_lateness(stream, ts, lateness).groupBy(window.alias("w"), *(keys or [])).agg(*measures)
    return grouped.withColumn("bucket", epoch(F.col("w.start"))).drop("w")


def without_replays(stream: DataFrame, key: str, ts: str, retention: str = "7 days") -> DataFrame:
    """First copy of every key; keys are remembered for as long as the source can replay."""
    return with_lateness(stream, ts, retention).dropDuplicatesWithinWatermark([key])
