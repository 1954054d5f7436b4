"""Hook for a model of the user's own: an Arrow-batched function over a column."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def column_model(predict: Callable[[pd.Series], pd.Series], returns: str):
    """A scalar pandas UDF around ``predict``; built-in expressions remain the first choice."""

    def call(values: pd.Series) -> pd.Series:
        return predict(values)

    call.__annotations__ = {"values": pd.Series, "return": pd.Series}
    return F.pandas_udf(call, returnType=returns)


def register_model(spark: SparkSession, name: str, predict: Callable[[pd.Series], pd.Series], returns: str):
    """Make a column model callable from SQL under ``name``."""
    return spark.udf.register(name, column_model(predict, returns))
