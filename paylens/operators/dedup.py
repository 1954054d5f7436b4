"""Duplicate handling.

``row_number() == 1`` is planned with a group limit before the shuffle, so every
task sends at most one row per key however many copies a key has. Counting uses
map-side partial sums. No operator gathers all copies of a key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``order``, which should be total."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key under ``order``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def excess_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: all rows, rows with a key, distinct keys and the excess.

    ``excess`` is COUNT(*) - COUNT(DISTINCT key): rows without a key count as excess.
    """
    has_key = F.lit(True)
    for key in keys:
        has_key = has_key & F.col(key).isNotNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.when(has_key, F.lit(1))).alias("distinct_keys"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.when(has_key, F.lit(1)))).alias("excess"),
    )


def flag_duplicates(df: DataFrame, key: Column, flag: str = "is_duplicate") -> DataFrame:
    """Mark every copy of a repeated key, rows without a key being one group.

    The repeated keys are counted first and joined back by a shuffle of their own; a hot
    key then lies on the probe side of a left join, which adaptive execution splits,
    where a window would have put the whole group into one task. The group of rows without a key never
    enters the join: one scalar tells whether there are at least two of them.
    """
    from paylens.operators.joins import splittable

    keyed = df.withColumn("_dup_key", key)
    counts = keyed.groupBy("_dup_key").agg(F.count(F.lit(1)).alias("_copies"))
    repeated = counts.where("_copies > 1 AND _dup_key IS NOT NULL").select("_dup_key", F.lit(True).alias("_rep"))
    repeated = splittable(repeated, "_dup_key")
    missing = keyed.where("_dup_key IS NULL").agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return (
        keyed.join(repeated, "_dup_key", "left")
        .withColumn(
            flag,
            F.when(F.col("_dup_key").isNull(), missing > 1).otherwise(F.coalesce(F.col("_rep"), F.lit(False))),
        )
        .drop("_dup_key", "_rep")
    )
