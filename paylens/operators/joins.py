"""Joins.

No side carries a broadcast hint by default: Spark broadcasts a side whose size it
has proven to lie under ``spark.sql.autoBroadcastJoinThreshold``, at planning time
from file sizes or at run time from shuffle sizes, and otherwise shuffles and splits
skewed partitions. It splits only where both sides arrive by a plain shuffle; see
``splittable`` for a side that would not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def splittable(side: DataFrame, key: str) -> DataFrame:
    """Give the unique side of a join a shuffle of its own.

    A side grouped by the join key is already partitioned by it, and Spark joins it where
    it lies; a hot key of the other side then stays in one task. Under an equal but new
    expression of the key the side is shuffled once more, which is cheap as its keys are
    unique, and adaptive execution can split the hot side.
    """
    same = F.concat(F.col(key), F.lit("")) if dict(side.dtypes)[key] == "string" else F.col(key) + F.lit(0)
    return side.withColumn(key, same.cast(side.schema[key].dataType))


def enrich(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join that keeps unmatched facts and flags them.

    The flag looks at the dimension's own key: the fact's key is never null after
    the join.
    """
    marked = dim.withColumn("_dim_key", F.col(key))
    return (
        fact.join(marked, key, "left")
        .withColumn("quality_flag", F.when(F.col("_dim_key").isNull(), "UNMATCHED").otherwise("CLEAN"))
        .drop("_dim_key")
    )


def latest_child(child: DataFrame, key: str, order: Sequence[Column], fields: Sequence[str]) -> DataFrame:
    """One row per parent: the child that comes first under ``order``."""
    from paylens.operators.dedup import latest_per_key

    return latest_per_key(child, [key], order).select(key, *fields)


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Facts whose key is given but missing from the dimension."""
    return fact.where(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti")


def not_yet_loaded(source: DataFrame, loaded: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Rows still to replay: ids already loaded and repeats in the batch go away.

    Rows without an id stay, all of them: the quality gate sends them to quarantine.
    """
    from paylens.operators.dedup import latest_per_key

    has_id = F.coalesce(F.trim(F.col(key)) != "", F.lit(False))
    with_id = latest_per_key(source.where(has_id), [key], order)
    fresh = with_id.join(loaded.select(key), key, "left_anti")
    return fresh.unionByName(source.where(~has_id))


def reconcile(
    ledger: DataFrame, gateway: DataFrame, key: str, amount: str, by: str, tolerance: float = 1.0
) -> DataFrame:
    """Ledger against settlement file: matched, disputed, missing or unknown.

    Both sides carry ``key``, ``amount`` and ``by`` (the gateway). A row present only in
    the gateway file is shown too, as ``gateway_only``.
    """
    left = ledger.select(key, by, F.col(amount).alias("ledger_amount"))
    right = gateway.select(key, by, F.col(amount).alias("gateway_amount"))
    gap = F.abs(F.col("ledger_amount") - F.col("gateway_amount"))
    return left.join(right, [key, by], "full").withColumn(
        "outcome",
        F.when(F.col("gateway_amount").isNull(), "missing")
        .when(F.col("ledger_amount").isNull(), "gateway_only")
        .when(gap > tolerance, "disputed")
        .otherwise("matched"),
    )


def side_by_side(left: DataFrame, right: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    """Full join of two small series on ``key``; a side without the key counts 0.

    Both frames have the columns ``key`` and ``n``.
    """
    a = left.select(key, F.col("n").alias(names[0]))
    b = right.select(key, F.col("n").alias(names[1]))
    return a.join(b, key, "full").select(
        key,
        F.coalesce(F.col(names[0]), F.lit(0)).alias(names[0]),
        F.coalesce(F.col(names[1]), F.lit(0)).alias(names[1]),
    )
