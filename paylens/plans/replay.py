"""Recovery after an incident: one batch job from Bronze to the target table."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.dates import wall_clock
from paylens.functions.text import is_blank
from paylens.operators import recovery
from paylens.session import written
from paylens.sources.writers import merge_insert


def recover(spark: SparkSession, bronze: DataFrame, target: str, since: datetime.datetime, run: str) -> DataFrame:
    """Replay records from ``since`` on; returns read, loaded, skipped, quarantined.

    Records are repaired and judged once and written; the clean ones are merged by id, so
    running the recovery again loads nothing. loaded + skipped + quarantined = read.
    """
    window = bronze.where(F.col("ingestion_timestamp") >= wall_clock(since))
    judged = written(recovery.repair(window).withColumn("_reason", recovery.reject_reason()), "replay")
    clean = judged.where("_reason IS NULL").drop("_reason")
    order = [F.desc("ingestion_timestamp"), F.asc("k"), F.asc("amount")]
    counts = merge_insert(spark, clean, target, "transaction_id", order, run)
    rejected = judged.where("_reason IS NOT NULL").agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.select(
        (F.col("rows_attempted") + rejected).alias("rows_read"), "rows_loaded", "rows_skipped", rejected.alias("rows_quarantined")
    )


def verify(spark: SparkSession, target: str, run: str, load: DataFrame) -> DataFrame:
    """Whether the target holds exactly the rows the load reported."""
    stored = spark.read.parquet(target).where(F.col("batch") == run).agg(
        F.count(F.lit(1)).alias("rows_found"), F.count(F.when(is_blank(F.col("transaction_id")), 1)).alias("rows_without_id")
    )
    expected = load.select("rows_loaded").scalar()
    return stored.withColumn("rows_expected", expected).withColumn("verified", F.col("rows_found") == F.col("rows_expected"))
