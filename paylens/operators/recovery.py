"""Incident work: hourly loads, gaps, breaches, merges, summaries."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions.dates import hour_label, iso_from_day_first, strict_date, wall_clock
from paylens.functions.numeric import total
from paylens.functions.text import blank_to_null, first_present, is_blank
from paylens.operators import silence

SPIKE_ABOVE = 1000


def hourly_load(df: DataFrame, ts: str, amount: Column, as_of: datetime.datetime, hours: int) -> DataFrame:
    """Count and value per hour over the last ``hours`` before ``as_of``."""
    recent = df.where(F.col(ts) >= wall_clock(as_of - datetime.timedelta(hours=hours)))
    return recent.groupBy(hour_label(F.col(ts)).alias("hour_utc")).agg(
        F.count(F.lit(1)).alias("tx_count"),
        total(amount).alias("gmv"),
        F.min(ts).alias("first_loaded"),
        F.max(ts).alias("last_loaded"),
    )


def window_totals(df: DataFrame, by: str, lo: str, hi: str) -> DataFrame:
    return df.where(F.col(by).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))).agg(
        F.count(F.lit(1)).alias("rows_loaded"), total(F.col("amount")).alias("gmv_loaded")
    )


def ingest_flag(n: Column, spike: int = SPIKE_ABOVE) -> Column:
    return F.when(n > spike, "SPIKE").when(n == 0, "ZERO").otherwise("")


def gmv_gap(history: DataFrame, window: DataFrame, history_days: int, window_days: int) -> DataFrame:
    """Expected value at the historical daily rate, less what was loaded, per merchant."""
    base = history.groupBy("merchant_id").agg(F.sum("amount").alias("past"))
    actual = window.groupBy("merchant_id").agg(F.sum("amount").alias("now"))
    zero = F.lit(0).cast("decimal(28,2)")
    expected = F.coalesce("past", zero).cast("double") / history_days * window_days
    loaded = F.coalesce("now", zero).cast("double")
    return base.join(actual, "merchant_id", "full").select(
        "merchant_id",
        F.round(expected, 2).alias("expected_gmv"),
        loaded.alias("loaded_gmv"),
        F.round(expected - loaded, 2).alias("missing_gmv"),
    )


def sla_breaches(gap: DataFrame, contracts: DataFrame) -> DataFrame:
    """Merchants whose missing value exceeds their own contract's threshold."""
    return (
        gap.join(contracts, "merchant_id")
        .where(F.col("missing_gmv") > F.col("threshold"))
        .select("merchant_id", "missing_gmv", "threshold", F.lit(True).alias("notify"))
    )


def repair(records: DataFrame) -> DataFrame:
    """Undo the two known upstream changes: the renamed field and the day-first date."""
    fixed = records.withColumn("merchant_name", first_present(records, ["merchant_name", "merchant_nm"]))
    fixed = fixed.withColumn("transaction_date", iso_from_day_first(F.col("transaction_date")))
    return fixed.drop("merchant_nm")


def reject_reason(amount: str = "amount") -> Column:
    """First reason a repaired record cannot be loaded, null if it can.

    A missing amount counts as zero; text that is no finite number is invalid, and so is a
    date that is not on the calendar.
    """
    text = blank_to_null(F.col(amount).cast("string"))
    number = F.trim(text).try_cast("double")
    return F.coalesce(
        F.when(is_blank(F.col("transaction_id")), "null_transaction_id"),
        F.when(is_blank(F.col("merchant_name")), "null_merchant_name"),
        F.when(text.isNull() | (number <= 0), "zero_or_negative_amount"),
        F.when(number.isNull() | F.isnan(number) | (F.abs(number) == float("inf")), "invalid_amount"),
        F.when(strict_date(F.col("transaction_date")).isNull(), "invalid_date"),
    )


def split_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired records that can be loaded, and the rest with their reason."""
    judged = repair(records).withColumn("_quarantine_reason", reject_reason())
    good = judged.where("_quarantine_reason IS NULL").drop("_quarantine_reason")
    return good, judged.where("_quarantine_reason IS NOT NULL")


def change_then_silence(changes: DataFrame, series: DataFrame, bucket: str, seconds: int = 300) -> DataFrame:
    """Per change event, the first empty bucket at or after it.

    ``changes`` has ``change_id`` and ``bucket``; ``series`` has counts ``n``, with or
    without rows for empty buckets.
    """
    edges = series.where("n > 0")
    empty = series.where("n = 0").select(F.col(bucket).alias("start"), F.col(bucket).alias("end"))
    runs = silence.low_runs(edges, bucket, seconds).select("start", "end").unionByName(empty)
    return silence.first_gap(changes, runs, bucket, seconds).select("change_id", bucket, "first_gap")


def incident_summary(gap: DataFrame, breaches: DataFrame, load: DataFrame) -> DataFrame:
    """One row: what was lost, who is affected and what the replay did."""
    lost = gap.where(F.col("missing_gmv") > 0).agg(
        F.round(F.sum("missing_gmv"), 2).alias("gmv_gap"), F.count(F.lit(1)).alias("merchants_affected")
    )
    broken = breaches.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = {c: load.select(c).scalar() for c in ("rows_read", "rows_loaded", "rows_skipped", "rows_quarantined")}
    return lost.select("*", broken.alias("sla_breaches"), *[v.alias(c) for c, v in counts.items()])
