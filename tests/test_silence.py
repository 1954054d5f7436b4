"""Gaps between buckets against a dense grid, and rolling sums of a hot key."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from paylens.operators import silence, windows
from paylens.streaming import alarms

STEP = 300


def counts_of(spark, buckets):
    return spark.createDataFrame([(b, 1 + b // STEP % 3, b + 17) for b in buckets], "bucket long, n long, newest_epoch long").repartition(3)


def dense(buckets, below=1):
    n = {b: 1 + b // STEP % 3 for b in buckets}
    return [(b, n.get(b, 0)) for b in range(min(buckets), max(buckets) + 1, STEP)]


@pytest.fixture(params=[1, 7, 4096])
def block(request, monkeypatch):
    """Blocks of one bucket, of a few, and one for everything."""
    monkeypatch.setattr(silence, "BLOCK", request.param)
    monkeypatch.setattr(silence, "CHUNK", 3)


@pytest.mark.parametrize("below", [1, 3])
def test_low_runs_match_the_grid(spark, block, below):
    rng = random.Random(below)
    buckets = sorted({rng.randrange(-40, 90) * STEP for _ in range(60)})
    runs, open_run = [], []
    for b, n in [*dense(buckets), (None, below)]:
        if n < below:
            open_run.append(b)
        elif open_run:
            runs.append((open_run[0], open_run[-1], len(open_run)))
            open_run = []
    got = silence.low_runs(counts_of(spark, buckets), "bucket", STEP, below)
    assert sorted(tuple(r) for r in got.collect()) == runs
    assert sorted(r["bucket"] for r in silence.each_bucket(got, "bucket", STEP).collect()) == [b for b, n in dense(buckets) if n < below]


def test_alarms_match_the_grid(spark, block):
    rng = random.Random(9)
    buckets = sorted({rng.randrange(0, 120) * STEP for _ in range(40)})
    grid = dense(buckets)
    counts = counts_of(spark, buckets)
    for periods in (1, 2, 3):
        want = [b for i, (b, n) in enumerate(grid) if i + 1 >= periods and all(m == 0 for _, m in grid[i + 1 - periods : i + 1])]
        assert sorted(r["bucket"] for r in alarms.zero_load(counts, STEP, periods).collect()) == want
    newest, want = None, {}
    for b, n in grid:
        newest = b + 17 if n else newest
        age = b + STEP - newest
        want[b] = (age, "CRITICAL" if age >= 900 else "DELAYED" if age > 600 else "OK")
    assert {r["bucket"]: (r["age_seconds"], r["status"]) for r in alarms.freshness(counts, STEP).collect()} == want


def test_first_gap_matches_the_grid(spark, block):
    rng = random.Random(4)
    buckets = sorted({rng.randrange(0, 80) * STEP for _ in range(45)})
    empty = [b for b, n in dense(buckets) if not n]
    changes = [(i, rng.randrange(min(buckets) // STEP, max(buckets) // STEP + 1) * STEP) for i in range(50)]
    runs = silence.low_runs(counts_of(spark, buckets), "bucket", STEP)
    got = silence.first_gap(spark.createDataFrame(changes, "change_id long, bucket long"), runs, "bucket", STEP)
    assert {r["change_id"]: r["first_gap"] for r in got.collect()} == {i: min((e for e in empty if e >= b), default=None) for i, b in changes}


def test_clocks_off_by_centuries_cost_one_row_each(spark):
    """Stamps of 1970 and 9999: a dense grid would have 800 million buckets."""
    at = 1_704_067_200
    buckets = [0, *[at + i * STEP for i in range(20) if i not in (4, 5)], 253_402_300_500]
    counts = counts_of(spark, buckets)
    runs = sorted(tuple(r) for r in silence.low_runs(counts, "bucket", STEP).collect())
    assert runs == [
        (STEP, at - STEP, at // STEP - 1), (at + 4 * STEP, at + 5 * STEP, 2),
        (at + 20 * STEP, 253_402_300_500 - STEP, (253_402_300_500 - at) // STEP - 20),
    ]
    since, until = at - 86_400, at + 86_400
    report = silence.window_report(counts, "bucket", since, until).first()
    outside = {b: 1 + b // STEP % 3 for b in (0, 253_402_300_500)}
    assert (report["rows_before"], report["rows_after"]) == (outside[0], outside[253_402_300_500])
    assert [r["bucket"] for r in alarms.zero_load(silence.within(counts, "bucket", since, until), STEP).collect()] == [at + 5 * STEP]


def test_no_counts_no_silence(spark):
    counts = counts_of(spark, [0]).where("false")
    assert silence.low_runs(counts, "bucket", STEP).collect() == []
    assert alarms.freshness(counts, STEP).collect() == []
    assert silence.window_report(counts, "bucket", 0, 1).first()["rows_inside"] == 0


def test_rolling_sum_of_a_hot_key_holds_blocks_only(spark):
    rng = random.Random(2)
    start = datetime.datetime(2024, 1, 1)
    rows = [("hot", start + datetime.timedelta(seconds=rng.randint(0, 200_000)), rng.randint(1, 9)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "m string, ts timestamp_ntz, v long")
    wide = windows.rolling_sum(df, "m", "ts", F.col("v"), 3600, "loss", block=10**9)
    for block in (1000, 3600, 14_400):
        cut = windows.rolling_sum(df, "m", "ts", F.col("v"), 3600, "loss", block=block)
        assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, wide.collect()))
    assert "_block" in windows.rolling_sum(df, "m", "ts", F.col("v"), 3600, "loss")._jdf.queryExecution().executedPlan().toString()
