"""Files, merges, replay and streams: everything can run twice."""

import datetime
import functools
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paylens.operators import recovery
from paylens.plans import payments, replay
from paylens.queries import streams
from paylens.session import scratch_path
from paylens.sources import readers, writers
from paylens.streaming import alarms, sinks
from paylens.streaming.ingest import file_stream
from paylens.streaming.windows import windowed, without_replays


def put(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_damaged_csv(spark):
    path = scratch_path(spark, "csv")
    put(path, "a.csv", "id,amount\n1,2.5\n<<<<<<< HEAD\n2,3.5\n=======\nid,amount\n3,x\n>>>>>>> other\n")
    good, bad = readers.read_csv_damaged(spark, path, StructType.fromDDL("id long, amount double"))
    assert sorted(r["id"] for r in good.collect()) == [1, 2]
    assert bad.count() == 5


def test_csv_as_text_keeps_everything(spark):
    path = scratch_path(spark, "csv")
    put(path, "a.csv", "id,amount\n007,1.50\n,abc\n")
    rows = readers.read_csv_text(spark, path)
    assert dict(rows.dtypes) == {"id": "string", "amount": "string"}
    assert [tuple(r) for r in rows.collect()] == [("007", "1.50"), (None, "abc")]


def test_json_batches_object_array_broken_empty(spark):
    path = scratch_path(spark, "json")
    put(path, "one.json", json.dumps({"id": 1}))
    put(path, "many.json", json.dumps([{"id": 2}, {"id": 3}]))
    put(path, "broken.json", '[{"id": 4}, {"id"')
    put(path, "empty.json", "")
    good, broken = readers.read_json_batches(spark, path, StructType.fromDDL("id long, note string"))
    assert sorted(r["id"] for r in good.collect()) == [1, 2, 3]
    assert broken.count() == 1


def test_replacing_partitions_leaves_the_others(spark):
    path = scratch_path(spark, "parts")
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "v long, day string")
    writers.replace_partitions(df, path, ["day"])
    writers.replace_partitions(df.where("day = 'b'").withColumn("v", F.col("v") * 10), path, ["day"])
    assert sorted((r["v"], r["day"]) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "a"), (30, "b")]


def test_merge_is_insert_only_and_a_retried_batch_changes_nothing(spark):
    path = scratch_path(spark, "target")
    order = [F.asc("v")]
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), (None, 9)], "id string, v long")

    def merge(rows, batch):
        r = writers.merge_insert(spark, rows, path, "id", order, batch).first()
        assert r["rows_loaded"] + r["rows_skipped"] + r["rows_rejected"] == r["rows_attempted"]
        return (r["rows_attempted"], r["rows_loaded"], r["rows_skipped"])

    assert merge(df, "one") == (4, 2, 1)
    assert merge(df, "one") == (4, 2, 1)
    assert merge(df, "two") == (4, 0, 3)
    more = spark.createDataFrame([("b", 99), ("c", 4)], "id string, v long")
    assert merge(more, "three") == (2, 1, 1)
    assert sorted((r["id"], r["v"]) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 3), ("c", 4)]
    assert merge(more.where("id = 'c'"), "three") == (1, 1, 0) and merge(more.limit(0), "three") == (0, 0, 0)
    assert sorted((r["id"], r["v"]) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 3)]
    assert merge(more, "odd/name = 1") == (2, 1, 1)


def test_incremental_replaces_equal_keys(spark):
    day = datetime.datetime
    this = spark.createDataFrame([("a", 1, day(2024, 1, 1)), ("b", 1, day(2024, 1, 5))], "id string, v long, at timestamp_ntz")
    source = spark.createDataFrame(
        [("a", 2, day(2024, 1, 6)), ("b", 7, day(2024, 1, 5)), ("c", 3, day(2024, 1, 7)), ("c", 4, day(2024, 1, 8))], "id string, v long, at timestamp_ntz"
    )
    got = sorted((r["id"], r["v"]) for r in payments.incremental(source, this, "id", "at").collect())
    assert got == [("a", 2), ("b", 1), ("c", 4)]


def test_quarantine_sink_repeated_run_does_not_double(spark):
    path = scratch_path(spark, "quarantine")
    df = spark.createDataFrame([("x",), ("y",)], "id string")
    at = F.lit("2024-02-03 04:00:00").cast("timestamp_ntz")
    for run in ("r1", "r1", "r2"):
        writers.quarantine(df, F.lit("bad"), "feed", at, path, run)
    rows = spark.read.parquet(path)
    assert rows.count() == 4 and set(rows.columns) >= {"quarantine_reason", "quarantine_source", "quarantined_at"}
    writers.quarantine(df.limit(0), F.lit("bad"), "feed", at, path, "r1")
    assert [r["run_id"] for r in spark.read.parquet(path).collect()] == ["r2", "r2"]


FEED = "k long, transaction_id string, amount string, transaction_date string, ingestion_timestamp timestamp_ntz, merchant_name string, merchant_nm string"


def feed_rows():
    at = datetime.datetime(2024, 5, 1)
    return [
        (1, "a", "10", "31-12-2024", at, None, "M"), (2, "a", "10", "2024-12-31", at, "M", None), (3, "", "10", "2024-12-31", at, "M", None),
        (4, "b", "0", "2024-12-31", at, "M", None), (5, "c", "abc", "2024-12-31", at, "M", None), (6, "d", "5", "2024-12-31", at, None, None),
        (7, "e", None, "2024-12-31", at, "M", None), (8, "f", "7", "2024-12-31", at - datetime.timedelta(days=9), "M", None), (9, "g", "8", "2024-12-31", at, "M", None),
    ]


def test_bad_dates_and_endless_amounts_are_rejected(spark):
    at = datetime.datetime(2024, 5, 1)
    rows = [
        (1, "a", "10", "99-99-9999", at, "M", None), (2, "b", "nan", "2024-12-31", at, "M", None), (3, "c", "Infinity", "2024-12-31", at, "M", None),
        (4, "d", "1", "2024-13-45", at, "M", None), (5, "e", "1", "29-02-2024", at, "M", None), (6, "f", "1", None, at, "M", None),
    ]
    good, bad = recovery.split_records(spark.createDataFrame(rows, FEED))
    assert [r["k"] for r in good.collect()] == [5]
    assert {r["k"]: r["_quarantine_reason"] for r in bad.collect()} == {
        1: "invalid_date", 2: "invalid_amount", 3: "invalid_amount", 4: "invalid_date", 6: "invalid_date",
    }


def test_repair_and_first_reason(spark):
    good, bad = recovery.split_records(spark.createDataFrame(feed_rows(), FEED))
    assert {r["k"]: r["_quarantine_reason"] for r in bad.collect()} == {
        3: "null_transaction_id", 4: "zero_or_negative_amount", 5: "invalid_amount", 6: "null_merchant_name", 7: "zero_or_negative_amount"
    }
    first = good.where("k = 1").first()
    assert first["merchant_name"] == "M" and first["transaction_date"] == "2024-12-31" and "merchant_nm" not in good.columns


def test_repair_without_the_old_field(spark):
    df = spark.createDataFrame([("a", "M")], "transaction_date string, merchant_nm string")
    assert recovery.repair(df).first()["merchant_name"] == "M"


def test_replay_adds_up_and_loads_nothing_the_second_time(spark):
    target, bronze = scratch_path(spark, "replay"), spark.createDataFrame(feed_rows(), FEED)
    since = datetime.datetime(2024, 4, 30)
    one = replay.recover(spark, bronze, target, since, "r1")
    got = one.first()
    assert (got["rows_read"], got["rows_loaded"], got["rows_skipped"], got["rows_quarantined"]) == (8, 2, 1, 5)
    assert replay.verify(spark, target, "r1", one).first()["verified"]
    two = replay.recover(spark, bronze, target, since, "r2").first()
    assert (two["rows_loaded"], two["rows_skipped"], two["rows_quarantined"]) == (0, 3, 5)
    assert two["rows_loaded"] + two["rows_skipped"] + two["rows_quarantined"] == two["rows_read"]


EVENTS = "event_id long, ts timestamp_ntz, value double"


@pytest.fixture
def event_files(spark):
    path = scratch_path(spark, "events")
    start = datetime.datetime(2024, 1, 1)
    rows = [(i, start + datetime.timedelta(minutes=(i * 37) % 2000), float(i % 7)) for i in range(500)]
    df = spark.createDataFrame(rows, EVENTS)
    df.repartition(5).write.parquet(path)
    return path, df


@pytest.fixture
def newest_first(spark):
    """A table over 150 days in five files, the newest of which is read first."""
    path = scratch_path(spark, "newest-first")
    os.makedirs(f"{path}/events.parquet")
    rows = [(i, datetime.datetime(2024, 6, 1) - datetime.timedelta(days=30 * (i // 3) + i // 3), i % 2, "error", float(i), None) for i in range(15)]
    for k in range(5):
        spark.createDataFrame(rows[3 * k : 3 * k + 3], streams.EVENT_SCHEMA).coalesce(1).write.parquet(f"{path}/{k}")
        name = next(n for n in os.listdir(f"{path}/{k}") if n.endswith(".parquet"))
        os.link(f"{path}/{k}/{name}", f"{path}/events.parquet/{k}.parquet")
        os.utime(f"{path}/events.parquet/{k}.parquet", (1_700_000_000 + 60 * k,) * 2)
    return path


def test_no_row_of_a_table_is_too_late(spark, newest_first, monkeypatch):
    monkeypatch.setattr(streams, "file_stream", functools.partial(file_stream, files_per_batch=1))
    table = spark.read.parquet(f"{newest_first}/events.parquet")
    hours = {r.bucket: (r.n, r.amount) for r in streams.r02(spark, newest_first).collect()}
    want = windowed(table, "ts", "1 hour", F.col("value")).collect()
    assert hours == {r.bucket: (r.n, r.amount) for r in want} and len(hours) == 5
    assert streams.r06(spark, newest_first).count() == 5
    assert streams.r11(spark, newest_first).agg(F.sum("n")).first()[0] == 4 * 15


def test_late_rows_of_all_batches_are_counted(spark, newest_first):
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(kept, "2")
    try:
        stream = windowed(file_stream(spark, f"{newest_first}/events.parquet", streams.EVENT_SCHEMA, files_per_batch=1), "ts", "1 hour", lateness="1 day")
        out = scratch_path(spark, "late")
        assert sinks.drain(stream, sinks.store_updates(f"{out}/rows"), f"{out}/checkpoint", "update") == 3
    finally:
        spark.conf.unset(kept)


@pytest.mark.parametrize("files", [1, 1000])
def test_stream_windows_equal_the_batch_in_any_file_order(spark, event_files, files):
    path, df = event_files
    stream = file_stream(spark, path, EVENTS, files_per_batch=files)
    got = sinks.collect_windows(spark, windowed(stream, "ts", "1 hour", F.col("value")), ["bucket"], "w")
    want = windowed(df, "ts", "1 hour", F.col("value"))
    keys = ["bucket", "n", "amount"]
    assert sorted(map(tuple, got.select(*keys).collect())) == sorted(map(tuple, want.select(*keys).collect()))


def test_stream_dedup_passes_each_key_once(spark, event_files):
    path, df = event_files
    df.write.mode("append").parquet(path)
    out = scratch_path(spark, "dedup")
    stream = file_stream(spark, path, EVENTS, files_per_batch=2)
    sinks.drain(without_replays(stream, "event_id", "ts", "30 days"), sinks.store_updates(f"{out}/rows"), f"{out}/cp")
    rows = spark.read.parquet(f"{out}/rows")
    assert rows.count() == rows.select("event_id").distinct().count() == 500


def test_upsert_stream_twice(spark, event_files):
    path, _ = event_files
    out = scratch_path(spark, "upsert")
    for run in ("first", "again"):
        handle = sinks.upsert_into(spark, f"{out}/target", "event_id", [F.asc("ts")], run)
        sinks.drain(file_stream(spark, path, EVENTS, files_per_batch=2), handle, f"{out}/cp-{run}")
    rows = spark.read.parquet(f"{out}/target")
    assert rows.count() == rows.select("event_id").distinct().count() == 500


def test_stream_repair_loses_no_row(spark):
    path = scratch_path(spark, "feed")
    spark.createDataFrame(feed_rows(), FEED).write.json(f"{path}/in")
    sinks.drain(file_stream(spark, f"{path}/in", FEED, "json"), sinks.repair_and_split(f"{path}/out"), f"{path}/cp")
    rows = spark.read.parquet(f"{path}/out")
    assert {r["outcome"]: r["n"] for r in rows.groupBy("outcome").agg(F.count("*").alias("n")).collect()} == {"clean": 4, "quarantine": 5}


def test_alarms(spark):
    counts = spark.createDataFrame([(0, 5, 10), (300, 1, 400), (1500, 2, 1600)], "bucket long, n long, newest_epoch long")
    assert sorted(r["bucket"] for r in alarms.zero_load(counts).where("alarm").collect()) == [900, 1200]
    fresh = {r["bucket"]: (r["age_seconds"], r["status"]) for r in alarms.freshness(counts).collect()}
    assert fresh[300] == (200, "OK") and fresh[900] == (800, "DELAYED") and fresh[1200] == (1100, "CRITICAL") and fresh[1500] == (200, "OK")
    sent = spark.createDataFrame([(0, 100), (600, 100), (1200, 100)], "bucket long, n long")
    loaded = spark.createDataFrame([(0, 96), (600, 94)], "bucket long, n long")
    assert {r["bucket"]: r["alarm"] for r in alarms.divergence(sent, loaded).collect()} == {0: False, 600: True, 1200: True}


def test_scratch_needs_a_shared_folder_off_local(spark, monkeypatch):
    from paylens import session

    class Remote:
        conf = type("C", (), {"get": staticmethod(lambda key, default="": "")})
        sparkContext = type("S", (), {"master": "yarn"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Remote)
