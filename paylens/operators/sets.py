"""Set operations and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def concat_feeds(feeds: dict[str, DataFrame], label: str = "feed") -> DataFrame:
    """Rows of all feeds, columns matched by name, missing ones null."""
    out = None
    for name, df in feeds.items():
        tagged = df.withColumn(label, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def rows_missing_from(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of source, with their multiplicity, that target lacks."""
    return source.select(*columns).exceptAll(target.select(*columns))


def value_difference(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values that only one side has, per column, from one pass over each side."""
    a = distinct_values(left, columns).withColumn("in_left", F.lit(True))
    b = distinct_values(right, columns).withColumn("in_right", F.lit(True))
    both = a.join(b, ["column_name", "value"], "full")
    side = F.when(F.col("in_right").isNull(), "left_only").when(F.col("in_left").isNull(), "right_only")
    return both.withColumn("side", side).where("side IS NOT NULL").select("column_name", "value", "side")


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(pairs)).where("value IS NOT NULL").distinct()


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def bounded(df: DataFrame, order: Sequence[Column], max_rows: int) -> tuple[DataFrame, DataFrame]:
    """The first ``max_rows`` rows, and a one-row frame telling whether more existed.

    Only ``max_rows + 1`` rows leave the tasks.
    """
    probe = df.orderBy(*order).limit(max_rows + 1)
    return probe.limit(max_rows), probe.agg((F.count(F.lit(1)) > max_rows).alias("truncated"))
