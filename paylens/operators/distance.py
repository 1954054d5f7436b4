"""How far two samples of a column lie apart.

Numbers: the largest gap of the two cumulative distributions (Kolmogorov-Smirnov) and the
area between them (earth mover's distance). Labels: the chi-square distance and the total
variation of their shares. All come from counts of values, which are added up before any
shuffle; the running counts are taken inside ranges of sorted values and then moved by the
sums of the ranges before, so no task holds a column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.functions.numeric import to_number
from paylens.functions.text import blank_to_null
from paylens.session import written

#: Factor of the critical value of the two-sample test at 5 %.
CRITICAL = 1.358


def _counts(left: DataFrame, right: DataFrame, columns: Sequence[str], cell) -> DataFrame:
    """``column_name, v, a, b``: how often each side has a value."""
    def side(df: DataFrame, a: int, b: int) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("column_name"), cell(F.col(c)).alias("v")) for c in columns]
        return df.select(F.inline(F.array(*pairs)), F.lit(a).alias("a"), F.lit(b).alias("b"))

    both = side(left, 1, 0).unionByName(side(right, 0, 1)).where("v IS NOT NULL")
    return both.groupBy("column_name", "v").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def running_counts(counts: DataFrame) -> DataFrame:
    """``counts`` with ``below_a``, ``below_b`` (up to and with the value) and the ``next`` value of the column."""
    ranged = counts.repartitionByRange("column_name", "v").withColumn("part", F.spark_partition_id())
    placed = written(ranged, "ranges")
    sums = placed.groupBy("column_name", "part").agg(F.sum("a").alias("sa"), F.sum("b").alias("sb"), F.min("v").alias("first"))
    before = Window.partitionBy("column_name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    along = Window.partitionBy("column_name").orderBy("part")
    moved = sums.select(
        "column_name", "part", F.coalesce(F.sum("sa").over(before), F.lit(0)).alias("oa"), F.coalesce(F.sum("sb").over(before), F.lit(0)).alias("ob"),
        F.lead("first").over(along).alias("behind"),
    )
    inside = Window.partitionBy("column_name", "part").orderBy("v")
    return placed.join(moved, ["column_name", "part"]).select(
        "column_name", "v", "a", "b", (F.sum("a").over(inside) + F.col("oa")).alias("below_a"), (F.sum("b").over(inside) + F.col("ob")).alias("below_b"),
        F.coalesce(F.lead("v").over(inside), F.col("behind")).alias("next"),
    )


def _number(value: Column) -> Column:
    number = to_number(value.cast("string"))
    return F.when(~F.isnan(number), number)


def number_distances(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, n_left, n_right, ks, ks_limit, drifted, earth_mover`` for numeric columns; a side without numbers has nulls."""
    running = running_counts(_counts(left, right, columns, _number))
    sizes = running.groupBy("column_name").agg(F.sum("a").alias("n_left"), F.sum("b").alias("n_right"))
    share = F.abs(F.col("below_a") / F.nullif(F.col("n_left"), F.lit(0)) - F.col("below_b") / F.nullif(F.col("n_right"), F.lit(0)))
    each = running.join(sizes, "column_name").withColumn("gap", share)
    limit = F.round(CRITICAL * F.sqrt((F.col("n_left") + F.col("n_right")) / F.nullif((F.col("n_left") * F.col("n_right")).cast("double"), F.lit(0.0))), 6)
    found = each.groupBy("column_name", "n_left", "n_right").agg(
        F.round(F.max("gap"), 6).alias("ks"), F.round(F.sum(F.col("gap") * (F.col("next") - F.col("v"))), 4).alias("earth_mover")
    )
    return found.select("column_name", "n_left", "n_right", "ks", limit.alias("ks_limit"), (F.col("ks") > limit).alias("drifted"), F.coalesce("earth_mover", F.when(F.col("ks").isNotNull(), F.lit(0.0))).alias("earth_mover"))


def label_distances(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, n_left, n_right, labels, chi_square, total_variation`` for columns of labels; a side without labels has nulls."""
    counts = _counts(left, right, columns, lambda c: blank_to_null(c.cast("string")))
    sizes = counts.groupBy("column_name").agg(F.sum("a").alias("n_left"), F.sum("b").alias("n_right"), F.count(F.lit(1)).alias("labels"))
    p = F.col("a") / F.nullif(F.col("n_left"), F.lit(0))
    q = F.col("b") / F.nullif(F.col("n_right"), F.lit(0))
    each = counts.join(sizes, "column_name").select("column_name", "n_left", "n_right", "labels", p.alias("p"), q.alias("q"))
    return each.groupBy("column_name", "n_left", "n_right", "labels").agg(
        F.round(F.sum((F.col("p") - F.col("q")) * (F.col("p") - F.col("q")) / (F.col("p") + F.col("q"))) / 2, 6).alias("chi_square"),
        F.round(F.sum(F.abs(F.col("p") - F.col("q"))) / 2, 6).alias("total_variation"),
    )
