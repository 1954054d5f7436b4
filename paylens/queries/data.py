"""Frames the queries share; the SQL views of the same names are in ``sqlbase``."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.operators.joins import enrich
from paylens.plans.medallion import valid_rows
from paylens.sources.warehouse import (  # noqa: F401  (re-exported for the query modules)
    customers,
    merchants,
    table,
    transactions,
    transactions_dirty,
    transactions_raw,
)

AS_OF_DAY = datetime.date(2001, 11, 5)
EVENTS_AS_OF = datetime.datetime(2024, 1, 31)
EVENTS_HALF = datetime.datetime(2024, 1, 16)


def as_of():
    return F.lit(AS_OF_DAY)


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions of which a few name a merchant that does not exist."""
    return transactions(spark, sf).withColumn(
        "merchant_id", F.when(F.col("k") % 41 == 0, "MXXX").otherwise(F.col("merchant_id"))
    )


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return enrich(valid_rows(bronze(spark, sf)), merchants(spark, sf), "merchant_id")


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return valid_rows(transactions(spark, sf), "staging")
