"""Late rows are kept: in a side table, or passed on by a processor with timers."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from paylens.functions.dates import epoch
from paylens.session import scratch_path
from paylens.streaming import late, sinks
from paylens.streaming.ingest import file_stream

EVENTS = "event_id long, ts timestamp_ntz, user_id long, value double"
START = datetime.datetime(2024, 1, 1)


@pytest.fixture
def newest_first(spark):
    """Files of 14 days each over 70 days, read from the newest to the oldest, one a batch."""
    path, rng, rows = scratch_path(spark, "late"), random.Random(1), []
    os.makedirs(f"{path}/in")
    for k in range(5):
        day = START + datetime.timedelta(days=14 * (4 - k))
        part = [(100 * k + i, day + datetime.timedelta(minutes=rng.randrange(14 * 1440)), i % 3, float(i % 5)) for i in range(40)]
        rows += part
        spark.createDataFrame(part, EVENTS).coalesce(1).write.parquet(f"{path}/{k}")
        name = next(n for n in os.listdir(f"{path}/{k}") if n.endswith(".parquet"))
        os.link(f"{path}/{k}/{name}", f"{path}/in/{k}.parquet")
        os.utime(f"{path}/in/{k}.parquet", (1_700_000_000 + 60 * k,) * 2)
    return path, spark.createDataFrame(rows, EVENTS)


def seconds(at):
    return int((at - datetime.datetime(1970, 1, 1)).total_seconds())


def plain_sums(df, width, slide, keys):
    out = {}
    for r in df.collect():
        s = seconds(r.ts)
        for b in range(s // slide * slide, s - width, -slide):
            key = (b, *[r[k] for k in keys])
            n, newest, amount = out.get(key, (0, 0, 0.0))
            out[key] = (n + 1, max(newest, s), amount + r.value)
    return out


def shown(df, keys):
    return {(r.bucket, *[r[k] for k in keys]): (r.n, r.newest_epoch, r.amount) for r in df.collect()}


@pytest.mark.parametrize("width,slide,keys", [(3600, 3600, []), (4 * 3600, 3600, ["user_id"]), (5400, 3600, [])])
def test_totals_and_side_table_make_the_whole(spark, newest_first, width, slide, keys):
    path, df = newest_first
    stream = file_stream(spark, f"{path}/in", EVENTS, files_per_batch=1)
    totals, side = late.drain_windows(spark, stream, "ts", width, "t", F.col("value"), slide, keys, lateness=15 * 86_400)
    side = side.cache()
    assert 0 < side.count() and totals.count() > 0
    newest = {}  # of the batches before
    for r in side.select("bucket", "batch_id").collect():
        files = df.where(F.col("event_id") < 100 * r.batch_id)
        mark = newest.setdefault(r.batch_id, seconds(files.agg(F.max("ts")).first()[0]))
        assert r.bucket + width <= mark - 15 * 86_400
    whole = late.merged(totals.unionByName(late.window_sums(side, keys, F.col("value"))), keys)
    assert shown(whole, keys) == plain_sums(df, width, slide, keys)
    again = late.complete_windows(spark, stream, "ts", width, "t", F.col("value"), slide, keys, lateness=86_400)
    assert shown(again, keys) == plain_sums(df, width, slide, keys)


def test_nothing_is_late_within_the_lateness(spark, newest_first):
    path, _ = newest_first
    stream = file_stream(spark, f"{path}/in", EVENTS, files_per_batch=1)
    _, side = late.drain_windows(spark, stream, "ts", 3600, "t", lateness=100 * 86_400)
    assert side.count() == 0


def test_rows_without_a_time_and_empty_streams(spark):
    path = scratch_path(spark, "empty")
    spark.createDataFrame([(1, None, 1, 1.0)], EVENTS).write.parquet(path)
    totals, side = late.drain_windows(spark, file_stream(spark, path, EVENTS), "ts", 60, "t", F.col("value"))
    assert totals.count() == side.count() == 0


def test_timers_drop_state_and_late_rows_are_passed_on(spark, newest_first):
    path, df = newest_first
    out = scratch_path(spark, "timed")
    stream = file_stream(spark, f"{path}/in", EVENTS, files_per_batch=1)
    with late.timer_store(spark):
        timed = late.timed_windows(stream, "ts", 3600, (F.col("value") * 100).cast("long"), lateness=15 * 86_400)
        held = []

        def handle(batch, batch_id):
            sinks.store_updates(f"{out}/rows")(batch, batch_id)

        query = timed.writeStream.outputMode("update").foreachBatch(handle).option("checkpointLocation", f"{out}/cp").trigger(availableNow=True).start()
        query.awaitTermination()
        held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    rows = spark.read.parquet(f"{out}/rows")
    by_kind = {r["kind"]: r["n"] for r in rows.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    last = rows.where("kind <> 'late'").groupBy("bucket").agg(F.max_by(F.struct("n", "cents"), "batch_id").alias("s"))
    side = rows.where("kind = 'late'")
    whole = last.select("bucket", "s.n", "s.cents").unionByName(side.select("bucket", "n", "cents")).groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("cents").alias("cents"))
    want = {b: (n, round(amount * 100)) for (b,), (n, _, amount) in plain_sums(df, 3600, 3600, []).items()}
    assert {r.bucket: (r.n, r.cents) for r in whole.collect()} == want
    # Rows of files older than 15 days before the newest are late, one by one.
    mark = seconds(df.agg(F.max("ts")).first()[0]) - 15 * 86_400
    old = df.where(F.floor(epoch(F.col("ts")) / 3600) * 3600 + 3600 <= mark).count()
    assert by_kind["late"] == side.count() == old
    # Windows that are not within the lateness have been closed and their state is gone.
    assert held[-1] <= 2 * last.where(F.col("bucket") + 3600 > mark).count()
