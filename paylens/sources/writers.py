"""Writing files and tables. Every write can be repeated without harm."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.masking import hash_id
from paylens.sources.keyed import merge_insert, own_folder  # noqa: F401  (the merge is a sink like the others)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet", gather: bool = True) -> None:
    """Overwrite exactly the partitions that ``df`` has; the others stay.

    Rebalancing gathers a partition's rows into files of sensible size and lets adaptive
    execution split a partition that is much larger than the rest. It moves every row once
    more; without ``gather`` each task writes a file for each of its partitions.
    """
    rows = df.hint("rebalance", *by) if gather else df
    packed = rows.write.option("compression", "zstd") if fmt == "parquet" else rows.write
    packed.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).format(fmt).save(path)


def write_hourly_json(df: DataFrame, ts: str, path: str) -> None:
    """JSON below one folder per day and hour of ``ts``."""
    stamped = df.withColumn("dt", F.date_format(ts, "yyyy-MM-dd")).withColumn("hour", F.hour(ts))
    replace_partitions(stamped, path, ["dt", "hour"], "json")


def quarantine(df: DataFrame, reason: Column, source: str, at: Column, path: str, run_id: str) -> None:
    """Keep rejected rows with reason, source and time, below a folder per run and day.

    A repeated run replaces its own folder and no other, also where it rejects nothing.
    """
    kept = df.select(
        "*", reason.alias("quarantine_reason"), F.lit(source).alias("quarantine_source"), at.alias("quarantined_at"),
        F.date_format(at, "yyyy-MM-dd").alias("quarantine_date"),
    )
    kept.write.mode("overwrite").partitionBy("quarantine_date").parquet(own_folder(path, "run_id", run_id))


def partner_feeds(rows: DataFrame, partner: Column, customer: str, path: str) -> None:
    """One folder per partner, with customer ids replaced by hashes."""
    masked = rows.withColumn(customer, hash_id(F.col(customer))).withColumn("partner_id", partner)
    replace_partitions(masked.where(F.col("partner_id").isNotNull()), path, ["partner_id"])


def write_run_metadata(spark: SparkSession, facts: dict, path: str) -> None:
    """One JSON record per run; ``facts`` holds its counts, status and times."""
    columns = [F.lit(v).alias(k) for k, v in facts.items()]
    spark.range(1).select(*columns).coalesce(1).write.mode("overwrite").json(path)


def materialise(df: DataFrame, name: str, kind: str, path: str | None = None) -> DataFrame:
    """Register a model: ``view`` for staging, ``table`` (files at ``path``) for marts."""
    if kind == "table":
        df.write.mode("overwrite").parquet(path)
        df = df.sparkSession.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
