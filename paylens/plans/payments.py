"""Payments warehouse models: staging, intermediate, dimensions, facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions.dates import years_between
from paylens.functions.masking import hash_id
from paylens.functions.text import is_blank
from paylens.operators.dedup import latest_per_key


def stage(raw: DataFrame, columns: list[str], key: str | None, loaded_at: Column) -> DataFrame:
    """Chosen columns of rows that have a key, stamped with the run's load time."""
    rows = raw if key is None else raw.where(F.col(key).isNotNull())
    return rows.select(*columns, loaded_at.alias("_loaded_at"))


def without_test_merchants(df: DataFrame, prefix: str = "TEST") -> DataFrame:
    """Drop ids like ``TEST_1``; the underscore stands for any one character."""
    return df.where(~F.col("merchant_id").like(f"{prefix}_%"))


def fact_transactions(txn: DataFrame, customers: DataFrame, merchants: DataFrame) -> DataFrame:
    who = customers.select("customer_id", F.col("tier").alias("customer_tier"))
    where = merchants.select("merchant_id", "merchant_name", "category")
    contribution = F.when(F.col("status") == "COMPLETED", F.col("amount")).otherwise(F.lit(0).cast("decimal(18,2)"))
    return txn.join(who, "customer_id", "left").join(where, "merchant_id", "left").select(
        "transaction_id", "transaction_date", "customer_id", "customer_tier", "merchant_id", "merchant_name", "category",
        F.col("amount").cast("double").alias("amount"), "status", contribution.cast("double").alias("gmv_contribution"),
        F.col("ingestion_timestamp").alias("_loaded_at"),
    )


def customer_dimension(customers: DataFrame, as_of: Column) -> DataFrame:
    """Active customers with hashes in place of personal fields."""
    return customers.where(F.col("is_active")).select(
        "customer_id", "tier",
        F.date_trunc("month", F.col("date_of_birth")).cast("date").alias("birth_month"),
        years_between(F.col("date_of_birth"), as_of).alias("age_years"),
        hash_id(F.col("customer_name")).alias("name_hash"),
    )


def merchant_dimension(merchants: DataFrame, performance: DataFrame) -> DataFrame:
    """Merchants with their rolling tier; those without activity are BRONZE."""
    tiers = performance.select("merchant_id", "merchant_tier", "gmv_30d", "avg_failure_rate_pct")
    return merchants.join(tiers, "merchant_id", "left").select(
        "merchant_id", "merchant_name", "category", "city",
        F.coalesce("merchant_tier", F.lit("BRONZE")).alias("current_tier"),
        F.coalesce("gmv_30d", F.lit(0.0)).alias("gmv_30d"),
        F.coalesce("avg_failure_rate_pct", F.lit(0.0)).alias("failure_rate_30d_pct"),
    )


def incremental(source: DataFrame, this: DataFrame, key: str, loaded_at: str) -> DataFrame:
    """The table after adding the rows newer than its newest, replacing equal keys.

    The high-water mark is a scalar subquery. New rows win; among themselves the
    latest does, ties by the whole row. Only they are ranked; ``this`` has a row for each
    key. ``sources.keyed.replace_newer`` keeps such a table in files.
    """
    mark = this.agg(F.max(loaded_at)).scalar()
    fresh = source.where(F.col(loaded_at) > mark)
    columns = this.columns
    order = [F.desc(loaded_at), *[F.asc(c) for c in columns if c not in (key, loaded_at)]]
    newest = latest_per_key(fresh.select(*columns), [key], order)
    return this.join(newest.select(key), key, "left_anti").select(*columns).unionByName(newest)


def insert_only(source: DataFrame, target: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Rows of source to append: one per key, keys already in target left out.

    The target's keys are first cut down to those the source has. A batch is small beside
    its target, so Spark broadcasts the batch's keys and then the few keys met, and the
    target is scanned but not shuffled. A large batch is joined by shuffles as usual.
    """
    named = source.where(~is_blank(F.col(key).cast("string")))
    met = target.select(key).join(named.select(key), key, "left_semi")
    return latest_per_key(named, [key], order).join(met, key, "left_anti")
