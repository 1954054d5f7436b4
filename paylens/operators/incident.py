"""What an outage cost: the failure window, the records missing in it and who must be told.

Loads are counted by hour. What an hour should bring is the mean of the same hour of the
week over a stated history. An hour is short if it brings less than a share of that; the
failure window is the longest loss: of all maximal runs of short hours the one that
misses most records. Hours without any row are hours like others, as both the history
and the checked time are stated and not taken from the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylens.functions.dates import bucket_start, epoch_label

HOUR = 3600
WEEK = 7 * 24 * HOUR
# Hours until a merchant must be told.
NOTIFY_WITHIN = 2


def hourly(df: DataFrame, ts: str, amount: Column, keys: Sequence[str] = ()) -> DataFrame:
    """``hour`` (epoch seconds), keys, ``n`` and ``amount``."""
    return df.groupBy(bucket_start(F.col(ts), HOUR).alias("hour"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("amount"))


def _grid(spark: SparkSession, since: int, until: int) -> DataFrame:
    """Hours of a stated time, as many as it has."""
    return spark.range(since, until, HOUR).select(F.col("id").alias("hour"))


def weekly_baseline(history: DataFrame, since: int, until: int, keys: Sequence[str] = ()) -> DataFrame:
    """``slot`` (second of the week), keys, ``expected_n`` and ``expected_amount``.

    ``history`` is hourly. A slot is divided by how often it occurs in [since, until), so
    hours without rows count as zeros.
    """
    slots = history.sparkSession.range(since, until, HOUR).groupBy((F.col("id") % WEEK).alias("slot")).agg(F.count(F.lit(1)).alias("times"))
    past = history.where((F.col("hour") >= since) & (F.col("hour") < until)).groupBy((F.col("hour") % WEEK).alias("slot"), *keys).agg(
        F.sum("n").alias("n"), F.sum("amount").alias("amount")
    )
    return past.join(slots, "slot").select(
        "slot", *keys, (F.col("n") / F.col("times")).alias("expected_n"), (F.col("amount").cast("double") / F.col("times")).alias("expected_amount")
    )


def hourly_shortfall(loaded: DataFrame, baseline: DataFrame, since: int, until: int, share: float = 0.5) -> DataFrame:
    """``hour, n, expected_n, missing, short`` of every hour in [since, until)."""
    grid = _grid(loaded.sparkSession, since, until)
    joined = grid.join(loaded.select("hour", "n"), "hour", "left").join(
        baseline.select("slot", "expected_n"), F.col("hour") % WEEK == F.col("slot"), "left"
    )
    n, expected = F.coalesce("n", F.lit(0)), F.coalesce("expected_n", F.lit(0.0))
    return joined.select("hour", n.alias("n"), expected.alias("expected_n"), F.greatest(expected - n, F.lit(0.0)).alias("missing"), (n < expected * share).alias("short"))


def failure_windows(hours: DataFrame) -> DataFrame:
    """``start, end`` (exclusive), ``hours`` and ``records_missing`` of every maximal run of short hours.

    The window function sees the hours of the checked time, which the caller bounds.
    """
    short = hours.where("short")
    number = F.row_number().over(Window.orderBy("hour"))
    runs = short.withColumn("island", F.col("hour") - number * HOUR).groupBy("island")
    return runs.agg(
        F.min("hour").alias("start"), (F.max("hour") + HOUR).alias("end"), F.count(F.lit(1)).alias("hours"), F.round(F.sum("missing"), 2).alias("records_missing")
    ).drop("island")


def worst_window(windows: DataFrame) -> DataFrame:
    """The window that misses most records, the first of equals; no row without any."""
    return windows.orderBy(F.desc("records_missing"), F.asc("start")).limit(1)


def merchant_losses(loaded: DataFrame, baseline: DataFrame, window: DataFrame, key: str) -> DataFrame:
    """``key, missing_amount, missing_n`` inside the window, for keys that miss anything.

    Both sides are hourly and by key. The window's hours are joined to a slot of the week
    each, so only the slots concerned are read from the baseline; a loss is the sum of
    what each hour misses of its own expectation.
    """
    hours = window.select(F.explode(F.sequence("start", F.col("end") - HOUR, F.lit(HOUR).cast("long"))).alias("hour"))
    due = hours.join(baseline, F.col("hour") % WEEK == F.col("slot")).select("hour", key, "expected_n", "expected_amount")
    came = loaded.join(hours, "hour").select("hour", F.col(key).alias("_key"), "n", F.col("amount").cast("double").alias("amount"))
    both = due.join(came, (due["hour"] == came["hour"]) & (due[key] == came["_key"]), "left").select(
        key, F.greatest(F.col("expected_n") - F.coalesce("n", F.lit(0)), F.lit(0.0)).alias("missing_n"),
        F.greatest(F.col("expected_amount") - F.coalesce("amount", F.lit(0.0)), F.lit(0.0)).alias("missing_amount"),
    )
    lost = both.groupBy(key).agg(
        F.round(F.sum(F.col("missing_amount").cast("decimal(28,6)")), 2).cast("double").alias("missing_amount"),
        F.round(F.sum(F.col("missing_n").cast("decimal(28,6)")), 2).cast("double").alias("missing_n"),
    )
    return lost.where("missing_amount > 0")


def notifications(losses: DataFrame, contracts: DataFrame, window: DataFrame, key: str, within: int = NOTIFY_WITHIN) -> DataFrame:
    """Merchants whose loss exceeds their contract's threshold, and when they must have been told.

    The loss is known when the window ends; the time runs from then.
    """
    end = window.select("end").scalar()
    return losses.join(contracts, key).where(F.col("missing_amount") > F.col("threshold")).select(
        key, "missing_amount", "threshold", epoch_label(end + within * HOUR).alias("notify_by")
    )


def incident_row(window: DataFrame, losses: DataFrame, told: DataFrame, key: str, named: int = 5) -> DataFrame:
    """One row: records and value missing, the window, who lost, who breaches, and the ``named`` largest breaches by name.

    ``breaches`` has them all; the row only names the largest. Without a failure window
    there is no row.
    """
    lost = losses.agg(F.round(F.sum(F.col("missing_amount").cast("decimal(28,2)")).cast("double"), 2).alias("gap"), F.count(F.lit(1)).alias("n"))
    breaches = told.agg(F.count(F.lit(1)).alias("n"), F.max("notify_by").alias("by"))
    top = told.orderBy(F.desc("missing_amount"), key).limit(named).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("missing_amount")).alias("m"), F.col(key).cast("string").alias("k")))), lambda s: s["k"]), ",").alias("names")
    )
    return window.select(
        "records_missing", F.coalesce(lost.select("gap").scalar(), F.lit(0.0)).alias("gmv_gap"), epoch_label(F.col("start")).alias("window_start"),
        epoch_label(F.col("end")).alias("window_end"), lost.select("n").scalar().alias("merchants_affected"), breaches.select("n").scalar().alias("sla_breaches"),
        F.coalesce(top.select("names").scalar(), F.lit("")).alias("notify_first"), breaches.select("by").scalar().alias("notify_by"),
    )
