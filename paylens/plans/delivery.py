"""Delivery warehouse: user behaviour, deliveries, users without personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.dates import minutes_between, years_between
from paylens.functions.masking import hash_id
from paylens.functions.numeric import count_when, mean_of, money, total, when_sum
from paylens.operators.aggregates import row_count, mode_per_key
from paylens.sources.warehouse import table


def user_behaviour(orders: DataFrame, ratings: DataFrame) -> DataFrame:
    """Per user: counts, averages, distinct outlets, the most frequent type, the mean rating.

    ``ratings`` has at most one row per event. The mode comes from counts per
    (user, type), which are few.
    """
    orders = orders.join(ratings, "event_id", "left")
    rows = orders.withColumns(
        {"amount": money(F.col("value")), "outlet_id": F.get_json_object("props", "$.k").try_cast("long")}
    )
    per = rows.groupBy("user_id").agg(
        F.count("event_id").alias("total_orders"),
        mean_of(total(F.col("amount")), row_count()).alias("avg_order_value"),
        F.max("ts").alias("last_order_at"),
        F.count_distinct("outlet_id").alias("unique_outlets"),
        F.round(F.avg(F.hour("ts")), 4).alias("avg_order_hour"),
        count_when(F.col("event_type") == "error").alias("cancelled_orders"),
        when_sum(F.col("event_type") == "signup", F.col("amount")).alias("total_discount"),
        F.avg("rating").alias("avg_rating_given"),
    )
    mode = mode_per_key(orders, ["user_id"], "event_type").select("user_id", F.col("event_type").alias("preferred_type"))
    return per.join(mode, "user_id")


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as deliveries: outlet joined inner, rating joined left."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    outlets = table(spark, folder, "part").select("p_partkey", F.col("p_type").alias("cuisine_type"))
    ratings = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("food_rating"))
    placed, delivered = F.col("o_orderdate"), F.col("l_shipdate")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        outlets, lines.l_partkey == outlets.p_partkey
    )
    return joined.join(ratings, F.col("l_orderkey") == F.col("doc_id"), "left").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.to_date(placed).alias("order_date"),
        F.col("o_custkey").alias("user_id"),
        "cuisine_type",
        money(F.col("l_extendedprice")).alias("final_amount"),
        minutes_between(placed, delivered).alias("fulfilment_mins"),
        F.col("o_orderstatus").alias("order_status"),
        F.coalesce("food_rating", F.lit(0)).alias("food_rating"),
    )


def users(customers: DataFrame, behaviour: DataFrame, first_seen: DataFrame, as_of: Column) -> DataFrame:
    """User dimension: personal fields hashed or left out, behaviour joined left."""
    return (
        customers.join(first_seen, "user_id", "left")
        .join(behaviour, "user_id", "left")
        .select(
            "user_id",
            F.datediff(as_of, F.col("signup_date")).alias("account_age_days"),
            years_between(F.col("signup_date"), as_of).alias("age_approx"),
            "total_orders", "avg_order_value", "avg_order_hour", "cancelled_orders",
            F.col("preferred_type").alias("most_used"),
            hash_id(F.col("customer_name")).alias("email_hash"),
        )
    )
