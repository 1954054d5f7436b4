"""Replay from a load ledger: which ids were loaded in which hour.

Every load notes its ids below a folder for each hour. A replay reads the hours since the
failure began and leaves those ids out before it repairs or judges anything; the keyed
merge behind it is the second guard. Hours beyond the stream's retention are dropped, as
nothing older can be replayed.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.dates import wall_clock
from paylens.functions.text import is_blank
from paylens.plans.replay import recover
from paylens.session import written
from paylens.sources.keyed import own_folder
from paylens.sources.readers import read_or_skip

# How far back a stream can be replayed.
RETENTION = datetime.timedelta(days=7)
_SCHEMA = "id string, hour string, run string"


class ReplayRefused(RuntimeError):
    """A condition for replaying is not met; nothing was read or written."""


def hour_name(at: datetime.datetime) -> str:
    return at.strftime("%Y-%m-%dT%H")


def note_load(rows: DataFrame, key: str, ledger: str, at: datetime.datetime, run: str) -> None:
    """Note the ids of ``rows`` under the load's hour; a repeated run replaces its own note."""
    ids = rows.where(~is_blank(F.col(key).cast("string"))).select(F.col(key).cast("string").alias("id")).distinct()
    ids.write.mode("overwrite").parquet(own_folder(own_folder(ledger, "hour", hour_name(at)), "run", run))


def loaded_since(spark: SparkSession, ledger: str, start: datetime.datetime) -> DataFrame:
    """Ids noted in the hour of ``start`` or later; folders of other hours are not opened."""
    if read_or_skip(spark, ledger)[0] is None:
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).parquet(ledger).where(F.col("hour") >= hour_name(start))


def expire(spark: SparkSession, ledger: str, now: datetime.datetime, keep: datetime.timedelta = RETENTION) -> list[str]:
    """Drop the hours that lie wholly beyond the retention; returns them."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(ledger)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    oldest, gone = hour_name(now - keep), []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("hour=") and name[5:] < oldest:
            files.delete(status.getPath(), True)
            gone.append(name[5:])
    return sorted(gone)


def check_replay(start: datetime.datetime, now: datetime.datetime, cause_fixed: bool, keep: datetime.timedelta = RETENTION) -> None:
    """Raise unless the cause is fixed and the stream still holds the records."""
    if not cause_fixed:
        raise ReplayRefused("the cause of the failure is not fixed: a replay would fail again")
    if start > now:
        raise ReplayRefused(f"the failure would begin in the future: {start}")
    if now - start > keep:
        raise ReplayRefused(f"records from {start} are older than the {keep.days} days that the stream keeps")


def replay(
    spark: SparkSession, stream: DataFrame, target: str, ledger: str, start: datetime.datetime, now: datetime.datetime, run: str, cause_fixed: bool,
    key: str = "transaction_id", arrived: str = "ingestion_timestamp",
) -> DataFrame:
    """Load what arrived since ``start`` and was not loaded since; returns one row of counts.

    rows_read = duplicates_skipped + rows_loaded + rows_skipped + rows_quarantined:
    skipped by the ledger, loaded, skipped by the merge, rejected. The ids loaded are
    noted at ``now``; running the same replay again under another name loads nothing.
    """
    check_replay(start, now, cause_fixed)
    window = stream.where(F.col(arrived) >= wall_clock(start))
    known = loaded_since(spark, ledger, start).where(F.col("run") != run).select(F.col("id").alias(key)).distinct()
    fresh = written(window.join(known, key, "left_anti"), "replayed")
    read = window.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = recover(spark, fresh, target, start, run)
    note_load(spark.read.parquet(own_folder(target, "batch", run)), key, ledger, now, run)
    return counts.select(
        read.alias("rows_read"), (read - F.col("rows_read")).alias("duplicates_skipped"), "rows_loaded", "rows_skipped", "rows_quarantined"
    )
