"""Alarms over windowed counts.

A window without rows gives no row; the alarms look at the gaps between the rows there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.functions.numeric import pct
from paylens.operators import silence
from paylens.operators.joins import side_by_side

# Alarm limits.
DELAYED_AFTER, CRITICAL_FROM = 600, 900
DIVERGENCE_PCT = 5.0


def zero_load(counts: DataFrame, seconds: int = 300, periods: int = 2) -> DataFrame:
    """Periods that close ``periods`` empty ones in a row, each with ``alarm``.

    One row for each such period; ``silence.alarm_spans`` has one for each run of them.
    """
    spans = silence.alarm_spans(silence.low_runs(counts, "bucket", seconds), seconds, periods)
    return silence.each_bucket(spans, "bucket", seconds).withColumn("alarm", F.lit(True))


def divergence(source: DataFrame, target: DataFrame, limit: float = DIVERGENCE_PCT) -> DataFrame:
    """Share of rows the target lacks per period, and whether it exceeds ``limit``."""
    both = side_by_side(source, target, "bucket", ("sent", "loaded"))
    lost = pct(F.col("sent") - F.col("loaded"), F.col("sent"))
    return both.withColumn("divergence_pct", lost).withColumn("alarm", F.coalesce(F.col("divergence_pct") > limit, F.lit(False)))


def freshness(counts: DataFrame, seconds: int = 300) -> DataFrame:
    """Age of the newest row at the end of every period, and its status."""
    spans = silence.status_spans(counts, "bucket", "newest_epoch", seconds, DELAYED_AFTER, CRITICAL_FROM)
    each = silence.each_bucket(spans, "bucket", seconds)
    return each.select("bucket", (F.col("bucket") + seconds - F.col("newest")).alias("age_seconds"), "status")


def spikes(counts: DataFrame, above: int) -> DataFrame:
    return counts.where(F.col("n") > above)
