"""Streams: each query drains a file stream over a given table and reads the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from paylens.functions.dates import wall_clock
from paylens.functions.numeric import money
from paylens.operators import recovery, silence
from paylens.operators.aggregates import row_count
from paylens.operators.dedup import latest_per_key
from paylens.queries import data
from paylens.queries.quality import FEED, replay_feed
from paylens.queries.registry import query
from paylens.queries.sqlbase import REASON, with_views
from paylens.queries.windows import CHECKED, SERIES, five_minute_counts
from paylens.session import scratch_path
from paylens.streaming import alarms, late, sinks
from paylens.streaming.ingest import file_stream
from paylens.streaming.windows import without_replays

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def event_stream(spark, sf):
    # A pattern matches a single file as well as a folder; a plain path must be a folder.
    return file_stream(spark, f"{sf.rstrip('/')}/{{events.parquet}}", EVENT_SCHEMA)


def windowed(spark, stream, width, label, *args, **options):
    """Windows of a stream with the rows that came too late for them added again."""
    return late.complete_windows(spark, stream, "ts", width, label, *args, **options)


def amount():
    return money(F.col("value"))


@query(
    "r01_json_ingest",
    "SELECT event_type, COUNT(*) AS rows, CAST(SUM(event_id) AS BIGINT) AS key_sum, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM events GROUP BY 1",
)
def r01(spark, sf):
    path = scratch_path(spark, "json-feed")
    data.table(spark, sf, "events").write.json(f"{path}/in")
    stream = file_stream(spark, f"{path}/in", EVENT_SCHEMA, "json")
    sinks.drain(stream, sinks.store_updates(f"{path}/out"), f"{path}/checkpoint")
    stored = spark.read.parquet(f"{path}/out")
    return stored.groupBy("event_type").agg(row_count().alias("rows"), F.sum("event_id").alias("key_sum"), F.sum(amount()).cast("double").alias("amount"))


BUCKET = "CAST(FLOOR(epoch(ts) / {s}) * {s} AS BIGINT)"


@query(
    "r02_hourly_tumbling",
    f"SELECT {BUCKET.format(s=3600)} AS bucket, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM events GROUP BY 1",
)
def r02(spark, sf):
    hours = windowed(spark, event_stream(spark, sf), 3600, "hourly", amount())
    return hours.select("bucket", "n", F.col("amount").cast("double").alias("amount"))


TIMED_LATENESS = 15 * 86_400
FEED_CUTS = ("2024-01-21", "2024-01-11")


@query(
    "r02b_timers_and_late_rows",
    f"""SELECT bucket, CAST(COUNT(CASE WHEN NOT late THEN 1 END) AS BIGINT) AS n_in_time, CAST(COUNT(CASE WHEN late THEN 1 END) AS BIGINT) AS n_late,
        CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM (SELECT *, {BUCKET.format(s=3600)} AS bucket, ts < TIMESTAMP '{FEED_CUTS[0]}'
          AND {BUCKET.format(s=3600)} + 3600 + {TIMED_LATENESS} <= (SELECT MAX(epoch(ts)) FROM events) AS late FROM events) GROUP BY 1""",
)
def r02b(spark, sf):
    """Ten days at a time, the newest first, each in a run of its own that goes on from the state of the last."""
    out = scratch_path(spark, "timed")
    events, upper = data.table(spark, sf, "events").select("ts", "value"), None
    for i, lower in enumerate([*FEED_CUTS, None]):
        piece = events.where(F.lit(True) if lower is None else F.col("ts") >= wall_clock(f"{lower} 00:00:00"))
        piece = piece if upper is None else piece.where(F.col("ts") < wall_clock(f"{upper} 00:00:00"))
        piece.write.parquet(f"{out}/in/piece={i}")
        upper = lower
        feed = file_stream(spark, f"{out}/in/*", "ts timestamp_ntz, value double")
        with late.timer_store(spark):
            timed = late.timed_windows(feed, "ts", 3600, (money(F.col("value")) * 100).cast("long"), TIMED_LATENESS)
            sinks.drain(timed, sinks.store_updates(f"{out}/rows"), f"{out}/checkpoint", "update")
    rows = spark.read.parquet(f"{out}/rows")
    sums = latest_per_key(rows.where("kind <> 'late'"), ["bucket"], [F.desc("batch_id")]).select("bucket", F.col("n").alias("n_in_time"), F.lit(0).alias("n_late"), "cents")
    side = rows.where("kind = 'late'").select("bucket", F.lit(0).alias("n_in_time"), F.lit(1).alias("n_late"), "cents")
    return sums.unionByName(side).groupBy("bucket").agg(
        F.sum("n_in_time").alias("n_in_time"), F.sum("n_late").alias("n_late"), (F.sum("cents").cast("decimal(28,2)") / 100).cast("double").alias("amount")
    )


@query(
    "r03_zero_load_alarm",
    f"""SELECT bucket FROM (SELECT bucket, SUM(CASE WHEN n < 1 THEN 1 ELSE 0 END) OVER (ORDER BY bucket ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) = 2 AS alarm
        FROM ({SERIES})) WHERE alarm""",
)
def r03(spark, sf):
    counts = windowed(spark, event_stream(spark, sf), 300, "five-minutes")
    return alarms.zero_load(silence.within(counts, "bucket", *CHECKED)).select("bucket")


LOST = "ts >= TIMESTAMP '2024-01-10 02:00:00' AND ts < TIMESTAMP '2024-01-10 09:00:00'"


@query(
    "r04_divergence_alarm",
    f"""SELECT bucket, CAST(sent AS BIGINT) AS sent, CAST(loaded AS BIGINT) AS loaded, ROUND(CAST(100 AS DOUBLE) * (sent - loaded) / sent, 2) AS divergence_pct,
        ROUND(CAST(100 AS DOUBLE) * (sent - loaded) / sent, 2) > 5 AS alarm FROM (SELECT {BUCKET.format(s=600)} AS bucket, COUNT(*) AS sent,
        COUNT(CASE WHEN NOT ({LOST}) THEN 1 END) AS loaded FROM events GROUP BY 1)""",
)
def r04(spark, sf):
    gone = F.expr("ts >= TIMESTAMP_NTZ '2024-01-10 02:00:00' AND ts < TIMESTAMP_NTZ '2024-01-10 09:00:00'")
    sent = windowed(spark, event_stream(spark, sf), 600, "sent")
    kept = windowed(spark, event_stream(spark, sf).where(~gone), 600, "loaded")
    return alarms.divergence(sent, kept)


@query(
    "r05_freshness",
    f"""SELECT bucket, age AS age_seconds, CASE WHEN age >= 900 THEN 'CRITICAL' WHEN age > 600 THEN 'DELAYED' ELSE 'OK' END AS status FROM
        (SELECT bucket, bucket + 300 - MAX(newest) OVER (ORDER BY bucket) AS age FROM (SELECT s.bucket, newest FROM ({SERIES}) s LEFT JOIN
         (SELECT {BUCKET.format(s=300)} AS b, MAX(CAST(FLOOR(epoch(ts)) AS BIGINT)) AS newest FROM events GROUP BY 1) m ON m.b = s.bucket))""",
)
def r05(spark, sf):
    counts = windowed(spark, event_stream(spark, sf), 300, "freshness")
    return alarms.freshness(silence.within(counts, "bucket", *CHECKED))


@query(
    "r06_error_spikes",
    f"SELECT {BUCKET.format(s=60)} AS bucket, COUNT(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1 HAVING COUNT(*) > 1",
)
def r06(spark, sf):
    errors = event_stream(spark, sf).where("event_type = 'error'")
    counts = windowed(spark, errors, 60, "errors")
    return alarms.spikes(counts, 1).select("bucket", "n")


@query("r07_replay_dedup", "SELECT event_type, COUNT(*) AS rows, CAST(SUM(event_id) AS BIGINT) AS key_sum FROM events GROUP BY 1")
def r07(spark, sf):
    """The feed holds every event twice; the stream passes each once."""
    path = scratch_path(spark, "replayed")
    events = data.table(spark, sf, "events")
    for copy in ("first", "again"):
        events.write.parquet(f"{path}/in/copy={copy}")
    stream = file_stream(spark, f"{path}/in/*", EVENT_SCHEMA)
    sinks.drain(without_replays(stream, "event_id", "ts", "31 days"), sinks.store_updates(f"{path}/out"), f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out").groupBy("event_type").agg(row_count().alias("rows"), F.sum("event_id").alias("key_sum"))


@query(
    "r08_upsert_sink",
    "SELECT 'first' AS run, COUNT(*) AS rows_in_target FROM events UNION ALL SELECT 'replay', COUNT(*) FROM events",
)
def r08(spark, sf):
    """The same stream twice, the second time from a fresh checkpoint: no row is added."""
    path = scratch_path(spark, "upsert")
    out = None
    for run in ("first", "replay"):
        handle = sinks.upsert_into(spark, f"{path}/target", "event_id", [F.desc("ts"), F.asc("event_type")], run)
        sinks.drain(event_stream(spark, sf), handle, f"{path}/checkpoint-{run}")
        held = spark.read.parquet(f"{path}/target").where("batch LIKE 'first%'" if run == "first" else "true")
        line = held.agg(row_count().alias("rows_in_target")).select(F.lit(run).alias("run"), "rows_in_target")
        out = line if out is None else out.unionByName(line)
    return out


FEED_SCHEMA = (
    "k long, transaction_id string, amount string, transaction_date string, status string, ingestion_timestamp timestamp_ntz, "
    "merchant_name string, merchant_nm string"
)


@query(
    "r09_repair_and_quarantine",
    with_views(
        "txn_dirty dim_merchant",
        rf"""SELECT CASE WHEN reason = '' THEN 'clean' ELSE 'quarantine' END AS outcome, reason, COUNT(*) AS rows, CAST(SUM(k) AS BIGINT) AS key_sum,
            COUNT(CASE WHEN regexp_matches(transaction_date, '^\d{{2}}-\d{{2}}-\d{{4}}$') AND transaction_date <> '99-99-9999' THEN 1 END) AS dates_fixed
            FROM (SELECT *, {REASON} AS reason FROM feed) GROUP BY 1, 2""",
        {"feed": FEED},
    ),
)
def r09(spark, sf):
    path = scratch_path(spark, "repair")
    replay_feed(spark, sf).write.json(f"{path}/in")
    stream = file_stream(spark, f"{path}/in", FEED_SCHEMA, "json").withColumn("raw_date", F.col("transaction_date"))
    sinks.drain(stream, sinks.repair_and_split(f"{path}/out"), f"{path}/checkpoint")
    fixed = F.count_if((F.col("raw_date") != F.col("transaction_date")) & (F.col("raw_date") != "99-99-9999"))
    return spark.read.parquet(f"{path}/out").groupBy("outcome", "reason").agg(
        row_count().alias("rows"), F.sum("k").alias("key_sum"), fixed.alias("dates_fixed")
    )


@query(
    "r10_replay_from_timestamp",
    with_views(
        "txn_dirty dim_merchant",
        f"""SELECT run, rows_read, CASE WHEN run = 'first' THEN ids ELSE 0 END AS rows_loaded,
            CASE WHEN run = 'first' THEN clean - ids ELSE clean END AS rows_skipped, rows_quarantined FROM (SELECT COUNT(*) AS rows_read,
            COUNT(CASE WHEN reason = '' THEN 1 END) AS clean, COUNT(DISTINCT CASE WHEN reason = '' THEN transaction_id END) AS ids,
            COUNT(CASE WHEN reason <> '' THEN 1 END) AS rows_quarantined FROM (SELECT *, {REASON} AS reason FROM feed)), (VALUES ('first'), ('again')) t(run)""",
        {"feed": FEED + " WHERE d.ingestion_timestamp >= TIMESTAMP '1999-01-01'"},
    ),
)
def r10(spark, sf):
    import datetime

    from paylens.plans.replay import recover

    target = scratch_path(spark, "replay-target")
    feed = replay_feed(spark, sf)
    out = None
    for run in ("first", "again"):
        counts = recover(spark, feed, target, datetime.datetime(1999, 1, 1), run).select(F.lit(run).alias("run"), "*")
        out = counts if out is None else out.unionByName(counts)
    return out


@query(
    "r11_sliding_loss",
    f"""SELECT user_id, bucket, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS loss, SUM(CAST(value AS DECIMAL(18,2))) > 300 AS breach
        FROM (SELECT *, UNNEST([h, h - 3600, h - 7200, h - 10800]) AS bucket FROM (SELECT *, {BUCKET.format(s=3600)} AS h FROM events)) GROUP BY 1, 2""",
)
def r11(spark, sf):
    rows = windowed(spark, event_stream(spark, sf), 4 * 3600, "sliding", amount(), 3600, ["user_id"])
    return rows.select("user_id", "bucket", "n", F.col("amount").cast("double").alias("loss"), (F.col("amount") > 300).alias("breach"))


@query(
    "r12_change_then_silence",
    f"""SELECT change_id, c.bucket, MIN(s.bucket) AS first_gap FROM (SELECT event_id AS change_id, {BUCKET.format(s=300)} AS bucket FROM events
        WHERE event_type = 'signup') c LEFT JOIN (SELECT bucket FROM ({SERIES}) WHERE n = 0) s ON s.bucket >= c.bucket GROUP BY 1, 2""",
)
def r12(spark, sf):
    from paylens.functions.dates import bucket_start

    changes = data.table(spark, sf, "events").where("event_type = 'signup'").select(
        F.col("event_id").alias("change_id"), bucket_start(F.col("ts"), 300).alias("bucket")
    )
    return recovery.change_then_silence(changes, five_minute_counts(spark, sf), "bucket")
