"""Staff warehouse: workforce, pay ledger, reviews.

The driver's customers stand for employees, their orders for monthly pay, and the
conversations for reviews.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.dates import years_between
from paylens.functions.masking import hash_id
from paylens.functions.numeric import count_when, money
from paylens.operators.joins import latest_child, splittable
from paylens.sources.warehouse import table


def workforce(spark: SparkSession, folder: str) -> DataFrame:
    """One row per employee with the first and last pay date."""
    bal = F.col("c_acctbal")
    pay = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("joining_date"), F.max("o_orderdate").cast("date").alias("last_pay_date")
    )
    people = table(spark, folder, "customer")
    return people.join(pay, people.c_custkey == pay.o_custkey, "left").select(
        F.col("c_custkey").alias("emp_id"),
        F.col("c_name").alias("emp_code"),
        F.col("c_nationkey").alias("department_id"),
        F.col("c_mktsegment").alias("work_location"),
        F.when(bal < 0, "CONTRACT").otherwise("PERMANENT").alias("employment_type"),
        F.when(bal >= 6000, "G3").when(bal >= 2000, "G2").otherwise("G1").alias("grade_band"),
        "joining_date",
        F.col("last_pay_date").isNotNull().alias("is_active"),
    )


def headcount(people: DataFrame, as_of: Column) -> DataFrame:
    days = F.datediff(as_of, F.col("joining_date"))
    return people.groupBy("department_id", "work_location", "employment_type", "grade_band").agg(
        F.count("emp_id").alias("headcount"),
        count_when(F.col("is_active")).alias("active_count"),
        F.round(F.sum(days).cast("double") / F.nullif(F.count(days).cast("double"), F.lit(0.0)), 4).alias("avg_tenure_days"),
        count_when(F.col("employment_type") == "CONTRACT").alias("contractor_count"),
    )


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Several reviews per employee: one per order, graded by its priority."""
    rating = F.substring("o_orderpriority", 1, 1)
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("review_id"),
        F.col("o_custkey").alias("emp_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("review_cycle"),
        rating.alias("final_rating"),
        (rating == "1").alias("promotion_recommended"),
    )


def people_dimension(people: DataFrame, review: DataFrame, as_of: Column) -> DataFrame:
    """Employees without personal data, with the rating of the latest review cycle."""
    latest = latest_child(
        review, "emp_id", [F.desc("review_cycle"), F.desc("review_id")], ["final_rating", "promotion_recommended"]
    )
    return people.join(latest, "emp_id", "left").select(
        "emp_id", "department_id", "work_location", "employment_type", "grade_band", "joining_date", "is_active",
        years_between(F.col("joining_date"), as_of).alias("tenure_years"),
        F.datediff(as_of, F.col("joining_date")).alias("tenure_days"),
        F.coalesce("final_rating", F.lit("NOT_REVIEWED")).alias("latest_rating"),
        F.coalesce("promotion_recommended", F.lit(False)).alias("promotion_flag"),
        hash_id(F.col("emp_code")).alias("email_hash"),
    )


def monthly_payroll(spark: SparkSession, folder: str) -> DataFrame:
    gross = money(F.col("o_totalprice"))
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("payroll_id"),
        F.col("o_custkey").alias("emp_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("payroll_month"),
        gross.alias("gross_earnings"),
        F.when(F.col("o_orderstatus") == "F", "PAID").otherwise("PENDING").alias("payment_status"),
        F.col("o_orderdate").alias("_loaded_at"),
    )


def payroll_ledger(payroll: DataFrame, people: DataFrame, pay_bands: DataFrame) -> DataFrame:
    """Pay rows with the employee (inner) and the pay band (left).

    Both are one row per employee and joined with each other first: one join with the
    many pay rows remains, and a hot employee can be split in it.
    """
    who = people.select("emp_id", "department_id", "work_location", "employment_type")
    known = who.join(pay_bands.select("emp_id", "grade_band"), "emp_id", "left")
    return payroll.join(splittable(known, "emp_id"), "emp_id")
