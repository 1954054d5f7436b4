"""Window operators, all over pre-aggregated or bounded groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.functions.dates import epoch
from paylens.functions.numeric import pct


def day_on_day(daily: DataFrame, day: str, value: str) -> DataFrame:
    """Change and growth against the row before; ``daily`` has one row per day.

    The window has no partition: its input is bounded by the number of days.
    """
    before = F.lag(value).over(Window.orderBy(day))
    change = F.col(value) - before
    return daily.withColumn("day_on_day_change", F.round(change, 2)).withColumn(
        "growth_pct", pct(change, before)
    )


def running_total(df: DataFrame, order: str, value: str, name: str, parts: int | None = None) -> DataFrame:
    """Running sum of ``value`` in ``order`` over a table of any size.

    Rows fall into buckets between approximate quantiles, of which at most ``parts``
    numbers reach the driver; as many as there are shuffle partitions if not given. Sums within a bucket and the sums of all earlier buckets
    add up to the total, exactly, wherever the cuts lie.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = [i / parts for i in range(1, parts)]
    column = F.col(order).cast("double")
    cuts = df.agg(F.percentile_approx(column, wanted, 1_000).alias("c")).first()["c"] or []
    bucket = _bucket(column, sorted(set(cuts)))
    bucketed = df.withColumn("_bucket", bucket)
    sums = bucketed.groupBy("_bucket").agg(F.sum(value).alias("_s"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_bucket", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_bucket").orderBy(order)
    return (
        bucketed.join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.sum(value).over(inside) + F.col("_offset"))
        .drop("_bucket", "_offset")
    )


def _bucket(value: Column, cuts: list[float], first: int = 0) -> Column:
    """Number of ``cuts`` below ``value``, by halving."""
    if not cuts:
        return F.lit(first)
    mid = len(cuts) // 2
    below, above = _bucket(value, cuts[:mid], first), _bucket(value, cuts[mid + 1 :], first + mid + 1)
    return F.when(value <= cuts[mid], below).otherwise(above)


def rolling_sum(
    df: DataFrame, key: str, ts: str, value: Column, seconds: int, name: str, threshold: float | None = None, block: int | None = None
) -> DataFrame:
    """Rolling sum per key over the last ``seconds``, at second resolution.

    Rows are summed per key and second first. A key's seconds are then cut into blocks of
    time (four times ``seconds`` long if not given), each with the last ``seconds`` of the
    block before as a halo, so a task holds a block and never a key's history.
    """
    block = block or 4 * seconds
    per_second = df.groupBy(key, epoch(F.col(ts)).alias("second")).agg(F.sum(value).alias("amount"))
    own = F.floor(F.col("second") / block)
    reach = F.floor((F.col("second") + seconds) / block)
    dealt = per_second.withColumn("_block", F.explode(F.sequence(own, reach)))
    window = Window.partitionBy(key, "_block").orderBy("second").rangeBetween(-seconds, 0)
    summed = dealt.withColumn(name, F.sum("amount").over(window)).where(F.col("_block") == own).drop("_block")
    return summed if threshold is None else summed.withColumn("breach", F.col(name) > threshold)


def above_average(df: DataFrame, column: str, factor: float) -> DataFrame:
    """Rows whose value exceeds ``factor`` times the mean; the mean is one scalar."""
    mean = df.agg((F.sum(column).cast("double") / F.count(column)).alias("m")).scalar()
    return df.where(F.col(column).cast("double") > mean * factor)
