"""Silence in counted time, from gaps between neighbouring buckets.

A feed's counts are a row for each bucket that has rows. What is missing lies between two
neighbours, so a run of empty buckets is one row however long it is: work and memory
follow the rows that are there, not the time they span. Only a report that wants a row
for each bucket is spread out, and that over a stated window.

Times are epoch seconds; a bucket is named by its start. Neighbours are found inside
blocks of time, and the ends of blocks are then compared with each other, so no task
sorts all buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets that one task compares with each other.
BLOCK = 4096
#: Buckets of a run that are spread out at once.
CHUNK = 10_000


def within(counts: DataFrame, bucket: str, since: int, until: int) -> DataFrame:
    """Buckets that start in [since, until)."""
    return counts.where((F.col(bucket) >= since) & (F.col(bucket) < until))


def window_report(counts: DataFrame, bucket: str, since: int, until: int) -> DataFrame:
    """One row: rows inside the checked window, before it and after it, with the least and largest bucket of all.

    A clock that is wrong by years shows up here and leaves the alarms alone.
    """
    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    at = F.col(bucket)
    return counts.agg(
        rows((at >= since) & (at < until)).alias("rows_inside"), rows(at < since).alias("rows_before"), rows(at >= until).alias("rows_after"),
        F.min(bucket).alias("first_bucket"), F.max(bucket).alias("last_bucket"),
    )


def carried(points: DataFrame, at: str, value: Column, name: str, width: int, ahead: bool, inclusive: bool) -> DataFrame:
    """``points`` with the least ``value`` at or after each point (``ahead``), or the largest at or before it.

    ``width`` is the length of a block; ``inclusive`` counts values at the point itself.
    Points of one time see the same values, so their order makes no difference.
    """
    pick, best = (F.min, F.least) if ahead else (F.max, F.greatest)
    blocked = points.withColumns({"_value": value, "_block": F.floor(F.col(at) / width)})
    others = Window.orderBy(F.desc("_block") if ahead else F.asc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    outside = blocked.groupBy("_block").agg(pick("_value").alias("_own")).withColumn("_outside", pick("_own").over(others)).drop("_own")
    # A range frame up to the point itself takes in all points of the same time.
    order = F.col(at) if not ahead else -F.col(at)
    frame = Window.partitionBy("_block").orderBy(order)
    inside = frame.rangeBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return blocked.join(outside, "_block").withColumn(name, best(pick("_value").over(inside), F.col("_outside"))).drop("_value", "_block", "_outside")


def low_runs(counts: DataFrame, bucket: str, seconds: int, below: int = 1) -> DataFrame:
    """``start, end, buckets``: every maximal run of buckets with fewer than ``below`` rows.

    ``counts`` has ``bucket`` and ``n``, a row for each bucket that has any; what lies
    before the first and behind the last of them is not judged. A run is bounded by the
    neighbouring buckets that have enough rows.
    """
    edges = counts.agg(F.min(bucket).alias("lo"), F.max(bucket).alias("hi")).select(
        F.explode(F.array(F.col("lo") - seconds, F.col("hi") + seconds)).alias(bucket)
    )
    enough = counts.where(F.col("n") >= below).select(bucket).unionByName(edges.where(F.col(bucket).isNotNull()))
    following = carried(enough, bucket, F.col(bucket), "_next", BLOCK * seconds, ahead=True, inclusive=False)
    return following.where(F.col("_next") - F.col(bucket) > seconds).select(
        (F.col(bucket) + seconds).alias("start"), (F.col("_next") - seconds).alias("end"),
        ((F.col("_next") - F.col(bucket)) / seconds - 1).cast("long").alias("buckets"),
    )


def alarm_spans(runs: DataFrame, seconds: int, periods: int = 2) -> DataFrame:
    """``start, end`` of the buckets that close ``periods`` low ones in a row."""
    return runs.where(F.col("buckets") >= periods).select((F.col("start") + (periods - 1) * seconds).alias("start"), "end")


def each_bucket(spans: DataFrame, bucket: str, seconds: int) -> DataFrame:
    """A row for each bucket of the spans (start, end), with their other columns.

    Spread out in pieces of bounded size; how many rows that gives is up to the window
    that the spans were taken from.
    """
    piece = CHUNK * seconds
    pieces = spans.withColumn("_from", F.explode(F.sequence("start", "end", F.lit(piece).cast("long"))))
    last = F.least(F.col("end"), F.col("_from") + piece - seconds)
    return pieces.withColumn(bucket, F.explode(F.sequence("_from", last, F.lit(seconds).cast("long")))).drop("_from", "start", "end")


def status_spans(counts: DataFrame, bucket: str, newest: str, seconds: int, delayed_after: int, critical_from: int) -> DataFrame:
    """``start, end, newest, status``: how old the newest row was, in spans of equal status.

    The age at the end of a bucket grows until the next bucket that has rows, so each
    bucket with rows opens at most three spans.
    """
    edge = counts.agg((F.max(bucket) + seconds).alias(bucket)).where(F.col(bucket).isNotNull())
    points = counts.select(bucket, F.col(newest).alias("newest")).unionByName(edge.withColumn("newest", F.lit(None).cast("long")))
    following = carried(points, bucket, F.col(bucket), "_next", BLOCK * seconds, ahead=True, inclusive=False).where("newest IS NOT NULL")
    held = ((F.col("_next") - F.col(bucket)) / seconds).cast("long")
    shift = F.col("newest") - F.col(bucket)
    critical = F.greatest(F.lit(0), F.least(held, F.ceil((shift + critical_from) / seconds) - 1)).cast("long")
    delayed = F.greatest(F.lit(0), F.least(critical, F.floor((shift + delayed_after) / seconds))).cast("long")

    def span(first: Column, end: Column, status: str) -> Column:
        return F.struct(
            (F.col(bucket) + first * seconds).alias("start"), (F.col(bucket) + (end - 1) * seconds).alias("end"), F.lit(status).alias("status")
        )

    zero = F.lit(0).cast("long")
    spans = F.array(span(zero, delayed, "OK"), span(delayed, critical, "DELAYED"), span(critical, held, "CRITICAL"))
    return following.select("newest", F.inline(spans)).where(F.col("start") <= F.col("end")).select("start", "end", "newest", "status")


def first_gap(changes: DataFrame, runs: DataFrame, bucket: str, seconds: int) -> DataFrame:
    """``changes`` with ``first_gap``: the first empty bucket at or after the change's, null if there is none.

    Each bucket that has changes is looked up once; the changes join it afterwards.
    """
    moments = changes.select(F.col(bucket).alias("_at")).distinct().withColumns({"start": F.lit(None).cast("long"), "end": F.lit(None).cast("long")})
    points = moments.unionByName(runs.select(F.col("start").alias("_at"), "start", "end"))
    width = BLOCK * seconds
    found = carried(points, "_at", F.col("start"), "_next", width, ahead=True, inclusive=True)
    found = carried(found, "_at", F.col("end"), "_open_to", width, ahead=False, inclusive=True).where("start IS NULL")
    gap = F.when(F.col("_open_to") >= F.col("_at"), F.col("_at")).otherwise(F.col("_next"))
    return changes.join(found.select(F.col("_at").alias(bucket), gap.alias("first_gap")), bucket)
