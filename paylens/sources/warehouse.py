"""The driver's tables seen as a payments warehouse.

A line item is a transaction, a supplier a merchant, a customer a customer. Ids of
line items repeat in the raw table, so ``transactions`` keeps the latest copy of
each and ``transactions_raw`` keeps them all.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.numeric import money
from paylens.operators.dedup import latest_per_key


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _as_transactions(lines: DataFrame, orders: DataFrame) -> DataFrame:
    status = F.when(F.col("l_returnflag") == "A", "COMPLETED").when(F.col("l_returnflag") == "R", "FAILED")
    priority = F.col("o_orderpriority")
    method = F.when(priority.isin("1-URGENT", "2-HIGH"), "CREDIT_CARD").when(priority == "3-MEDIUM", "DEBIT_CARD")
    head = orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    return lines.join(head, lines.l_orderkey == head.o_orderkey).select(
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("transaction_id"),
        money(F.col("l_extendedprice")).alias("amount"),
        status.otherwise("PENDING").alias("status"),
        F.col("l_suppkey").cast("string").alias("merchant_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_shipdate").cast("date").alias("transaction_date"),
        method.otherwise("UPI").alias("payment_method"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"),
        F.col("l_shipdate").alias("ingestion_timestamp"),
        "l_partkey", "l_quantity", "l_discount", "l_tax",
    )


def transactions_raw(spark: SparkSession, folder: str) -> DataFrame:
    return _as_transactions(table(spark, folder, "lineitem"), table(spark, folder, "orders"))


def transactions(spark: SparkSession, folder: str, since: datetime.date | Column | None = None) -> DataFrame:
    """Latest copy per transaction, from day ``since`` on.

    The copies go before the join with orders: each task first keeps its latest copy of a
    key, so a huge order is cut down before the shuffle, and the join then moves fewer
    rows. The latest copy is the one with the greatest date, so a lower bound may go
    before the dedup, down to the scan; an upper bound must not.
    """
    order = [
        F.desc("l_shipdate"), "l_partkey", "l_suppkey", "l_extendedprice",
        "l_quantity", "l_discount", "l_tax", "l_returnflag",
    ]
    copies = table(spark, folder, "lineitem").drop("l_linestatus")
    if since is not None:
        copies = copies.where(F.col("l_shipdate") >= (since if isinstance(since, Column) else F.lit(since)))
    lines = latest_per_key(copies, ["l_orderkey", "l_linenumber"], order)
    return _as_transactions(lines, table(spark, folder, "orders"))


def merchants(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    kind = F.col("s_nationkey") % 5
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").cast("string").alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        F.when(kind == 0, "Food Delivery")
        .when(kind == 1, "E-Commerce")
        .when(kind == 2, "Entertainment")
        .when(kind == 3, "Travel")
        .otherwise("Grocery")
        .alias("category"),
        F.col("n_name").alias("city"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(balance >= 6000, "GOLD").when(balance >= 2000, "SILVER").otherwise("BRONZE").alias("tier"),
        "c_nationkey", "c_mktsegment", "c_acctbal",
    )


def transactions_dirty(spark: SparkSession, folder: str) -> DataFrame:
    """Raw transactions as strings with a fixed pattern of damage.

    The given tables have no nulls, negatives or bad dates, so the quality operators
    read every raw row through these expressions.
    """
    k = F.col("k")
    day = F.col("transaction_date").cast("string")
    amount = F.col("amount").cast("string")
    day_first = F.concat_ws("-", F.substring(day, 9, 2), F.substring(day, 6, 2), F.substring(day, 1, 4))
    return transactions_raw(spark, folder).select(
        "k",
        F.when(k % 23 == 0, "").when(k % 23 == 1, F.lit(None)).otherwise(F.col("transaction_id")).alias("transaction_id"),
        F.when(k % 29 == 0, "").when(k % 29 == 1, F.concat(F.lit("-"), amount)).when(k % 29 == 2, "abc")
        .otherwise(amount).alias("amount"),
        F.when(k % 31 == 0, "99-99-9999").when(k % 31 == 1, day_first).otherwise(day).alias("transaction_date"),
        F.when(k % 37 == 0, "XYZ").otherwise("INR").alias("currency"),
        F.when(k % 41 == 0, "MXXX").otherwise(F.col("merchant_id")).alias("merchant_id"),
        F.when(k % 43 == 0, F.concat(F.lit("  "), F.col("status"), F.lit(" "))).otherwise(F.col("status")).alias("status"),
        "customer_id", "payment_method", "ingestion_timestamp",
    )
