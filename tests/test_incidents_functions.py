"""Failure windows, replay from a ledger, sketches, distances, retrieval and functions for SQL."""

import datetime
import math
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from paylens.functions import aggregate
from paylens.operators import aggregates as agg
from paylens.operators import distance, incident, monitoring, retrieval, sketches
from paylens.plans import ledger
from paylens.session import scratch_path

H = incident.HOUR


# -- failure windows -----------------------------------------------------------------------------


def hours(spark, counts):
    return spark.createDataFrame([(h * H, n, D(n)) for h, n in counts.items()], "hour long, n long, amount decimal(18,2)")


def test_failure_windows_are_maximal_runs_of_short_hours(spark):
    week = 168
    history = hours(spark, {h: 10 for h in range(2 * week) if h % 24 != 3})
    baseline = incident.weekly_baseline(history, 0, 2 * week * H)
    assert baseline.count() == 7 * 23 and {r.expected_n for r in baseline.collect()} == {10.0}
    since = 2 * week
    loaded = {h: 10 for h in range(since, since + 48)} | {since + 5: 4, since + 6: 5, since + 8: 4, since + 9: 0}
    del loaded[since + 10], loaded[since + 27]  # one hour without rows, and one that never has any
    found = incident.failure_windows(incident.hourly_shortfall(hours(spark, loaded), baseline, since * H, (since + 48) * H))
    got = sorted((r.start // H - since, r.end // H - since, r.hours, r.records_missing) for r in found.collect())
    assert got == [(5, 6, 1, 6.0), (8, 11, 3, 26.0)]
    assert incident.worst_window(found).first().start == (since + 8) * H


def test_a_slot_that_misses_a_week_counts_it_as_zero(spark):
    baseline = incident.weekly_baseline(hours(spark, {5: 12}), 0, 2 * incident.WEEK)
    assert [(r.slot, r.expected_n, r.expected_amount) for r in baseline.collect()] == [(5 * H, 6.0, 6.0)]


def test_losses_notifications_and_the_incident_row(spark):
    keyed = "hour long, merchant_id long, n long, amount decimal(18,2)"
    history = spark.createDataFrame([(h * H, m, 2, D(100 * m)) for h in range(168) for m in (1, 2, 3)], keyed)
    base = incident.weekly_baseline(history, 0, incident.WEEK, ["merchant_id"])
    window = spark.createDataFrame([((168 + 4) * H, (168 + 7) * H, 3, 15.0)], "start long, end long, hours long, records_missing double")
    loaded = spark.createDataFrame([((168 + h) * H, 1, 2, D(100)) for h in (4, 5, 6)] + [((168 + 4) * H, 2, 5, D(500))], keyed)
    losses = incident.merchant_losses(loaded, base, window, "merchant_id")
    assert sorted((r.merchant_id, r.missing_amount) for r in losses.collect()) == [(2, 400.0), (3, 900.0)]
    contracts = spark.createDataFrame([(1, 1.0), (2, 400.0), (3, 500.0)], "merchant_id long, threshold double")
    told = incident.notifications(losses, contracts, window, "merchant_id")
    assert [(r.merchant_id, r.notify_by) for r in told.collect()] == [(3, "1970-01-08 09:00:00")]
    row = incident.incident_row(window, losses, told, "merchant_id").first()
    assert (row.records_missing, row.gmv_gap, row.window_start, row.window_end) == (15.0, 1300.0, "1970-01-08 04:00:00", "1970-01-08 07:00:00")
    assert (row.merchants_affected, row.sla_breaches, row.notify_first, row.notify_by) == (2, 1, "3", "1970-01-08 09:00:00")
    assert incident.incident_row(window.where("false"), losses, told, "merchant_id").collect() == []


@pytest.mark.parametrize("minutes,met,near", [(119, True, True), (121, False, True), (129, False, True), (108, True, False), (108.01, True, True)])
def test_runtime_is_never_rounded(spark, minutes, met, near):
    start = datetime.datetime(2024, 1, 1, 1)
    record = spark.createDataFrame([(start, start + datetime.timedelta(minutes=minutes))], "started timestamp_ntz, ended timestamp_ntz")
    metrics = record.select(monitoring.minutes_of(F.col("started"), F.col("ended")).alias("runtime_minutes"))
    assert metrics.first()[0] == minutes
    assert monitoring.evaluate_objectives(metrics, [monitoring.Objective("runtime", "runtime_minutes", high=120)]).first().met == met
    rule = [r for r in monitoring.ALERT_RULES if r.name == "runtime_approaching_limit"]
    assert monitoring.evaluate_alerts(metrics, rule).first().fired == near


# -- replay --------------------------------------------------------------------------------------

FEED = "k long, transaction_id string, amount string, transaction_date string, ingestion_timestamp timestamp_ntz, merchant_name string, merchant_nm string"


def test_replay_reads_hours_since_the_failure_and_loads_once(spark):
    at = datetime.datetime
    feed = spark.createDataFrame(
        [(i, f"t{i}" if i else None, "5", "2024-01-02", at(2024, 1, 2, i), "m", None) for i in range(10)], FEED
    )
    book, target, now = scratch_path(spark, "ledger"), scratch_path(spark, "target"), at(2024, 1, 3)
    ledger.note_load(feed.where("k = 7"), "transaction_id", book, at(2024, 1, 2, 9), "nightly")
    ledger.note_load(feed.where("k = 8"), "transaction_id", book, at(2024, 1, 1), "before the failure")
    known = ledger.loaded_since(spark, book, at(2024, 1, 2, 0))
    assert [r.id for r in known.collect()] == ["t7"]
    assert all("hour=2024-01-02" in r[0] for r in known.select(F.col("_metadata.file_path")).distinct().collect())

    def replay(run):
        return tuple(ledger.replay(spark, feed, target, book, at(2024, 1, 2), now, run, True).first())

    # read, skipped by the ledger, loaded, skipped by the merge, quarantined
    assert replay("r1") == (10, 1, 8, 0, 1)
    assert replay("r1") == (10, 1, 8, 0, 1)
    assert replay("r2") == (10, 9, 0, 0, 1)
    assert spark.read.parquet(target).where("transaction_id = 't8'").count() == 1


def test_replay_is_refused_without_its_conditions(spark):
    now = datetime.datetime(2024, 1, 10)
    for start, fixed, why in ((now - datetime.timedelta(days=1), False, "not fixed"), (now - datetime.timedelta(days=7, seconds=1), True, "older"),
                              (now + datetime.timedelta(hours=1), True, "future")):
        with pytest.raises(ledger.ReplayRefused, match=why):
            ledger.replay(spark, None, "", "", start, now, "r", fixed)
    ledger.check_replay(now - datetime.timedelta(days=7), now, True)


def test_hours_beyond_the_retention_are_dropped(spark):
    book, now = scratch_path(spark, "expiry"), datetime.datetime(2024, 1, 10, 5)
    ids = spark.createDataFrame([("a",)], "id string")
    for day in (2, 3, 9):
        ledger.note_load(ids, "id", book, datetime.datetime(2024, 1, day, 5), "r")
    assert ledger.expire(spark, book, now) == ["2024-01-02T05"]
    assert ledger.expire(spark, book, now) == []
    assert ledger.loaded_since(spark, book, datetime.datetime(2024, 1, 1)).count() == 2
    assert ledger.expire(spark, f"{book}-absent", now) == []


# -- medians, sketches, distances ----------------------------------------------------------------


@pytest.mark.parametrize("bits", [1, 3, 16])
def test_median_by_refining_a_histogram(spark, bits, monkeypatch):
    monkeypatch.setattr(agg, "MEDIAN_BITS", bits)
    for values in ([5], [5, 5], [-(10**15), 10**15, 3, 4], [1, 2, 3], [0, 0, 0, 1], [7, 7, 9, 9], list(range(-50, 51))):
        df = spark.createDataFrame([(D(v) / 100,) for v in values] + [(None,)], "v decimal(18,2)")
        ordered = sorted(values)
        want = (ordered[(len(values) - 1) // 2] + ordered[len(values) // 2]) / 200
        assert agg.exact_median(df, F.col("v")).first()[0] == want
    assert agg.exact_median(spark.createDataFrame([(None,)], "v long"), F.col("v")).first()[0] is None
    with pytest.raises(ValueError):
        agg.exact_median(spark.createDataFrame([(1.5,)], "v double"), F.col("v"))


def test_sketches_merge_to_within_their_errors(spark):
    rng = random.Random(6)
    rows = [(f"2024-01-0{1 + i % 3}", str(round(rng.gauss(100, 20), 3)), f"u{rng.randrange(3000)}", None if i % 10 else "rare") for i in range(9000)]
    df = spark.createDataFrame(rows, "day string, v string, u string, label string")
    path = scratch_path(spark, "sketches")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-02"):
        sketches.store_days(df.where(F.col("day") == day), "day", ["v", "u", "label"], path)
    got = {r.column_name: r for r in sketches.merged_profile(sketches.stored_days(spark, path)).collect()}
    assert {c: (r.total_rows, r.null_count) for c, r in got.items()} == {"v": (9000, 0), "u": (9000, 0), "label": (9000, 8100)}
    for c, exact in (("u", len({r[2] for r in rows})), ("v", len({r[1] for r in rows})), ("label", 1)):
        assert abs(got[c].distinct_estimate - exact) <= 3 * sketches.DISTINCT_ERROR * exact + 0.5
    for value, rank in ((got["v"].median_estimate, 0.5), (got["v"].low_estimate, 0.05), (got["v"].high_estimate, 0.95)):
        lo, hi = sketches.rank_range(df, "v", value)
        assert lo - sketches.RANK_ERROR <= rank <= hi + sketches.RANK_ERROR
    assert got["u"].median_estimate is None and got["u"].numbers == 0
    part = sketches.merged_profile(sketches.stored_days(spark, path, "2024-01-02", "2024-01-02"))
    assert {r.total_rows for r in part.collect()} == {3000}


def test_frequent_values_state_how_low_they_may_be(spark, monkeypatch):
    monkeypatch.setattr(sketches, "HEAVY", 3)
    rng = random.Random(7)
    rows = [(f"d{i % 4}", f"v{min(int(rng.expovariate(0.4)), 30)}") for i in range(4000)]
    stored = sketches.sketch_days(spark.createDataFrame(rows, "day string, v string"), "day", ["v"])
    exact = {}
    for _, v in rows:
        exact[v] = exact.get(v, 0) + 1
    got = sketches.merged_heavy(stored, 2).collect()
    assert {r.value for r in got} == set(sorted(exact, key=lambda v: (-exact[v], v))[:2])
    for r in got:
        assert r.n <= exact[r.value] <= r.n + r.too_low


def test_distances_against_plain_ones(spark):
    rng = random.Random(9)
    a = [round(rng.gauss(0, 1), 1) for _ in range(300)] + [None]
    b = [round(rng.gauss(0.4, 1.3), 1) for _ in range(200)] + ["x", float("nan")]
    left = spark.createDataFrame([(None if v is None else str(v), "p" if i % 3 else "q") for i, v in enumerate(a)], "v string, l string")
    right = spark.createDataFrame([(str(v), "p" if i % 2 else " ") for i, v in enumerate(b)], "v string, l string")
    xs, ys = [v for v in a if v is not None], [v for v in b if not isinstance(v, str) and not math.isnan(v)]
    points = sorted({*xs, *ys})
    gaps = [abs(sum(x <= p for x in xs) / len(xs) - sum(y <= p for y in ys) / len(ys)) for p in points]
    r = distance.number_distances(left, right, ["v"]).first()
    assert (r.n_left, r.n_right, r.ks) == (300, 200, round(max(gaps), 6))
    assert r.earth_mover == pytest.approx(sum(g * (q - p) for g, p, q in zip(gaps, points, points[1:])), abs=1e-4)
    assert r.drifted == (r.ks > r.ks_limit) and r.ks_limit == round(1.358 * math.sqrt(500 / 60000), 6)
    same = distance.number_distances(left, left, ["v"]).first()
    assert (same.ks, same.earth_mover, same.drifted) == (0.0, 0.0, False)
    none = distance.number_distances(left, right.limit(0), ["v"]).first()
    assert (none.n_right, none.ks, none.drifted) == (0, None, None)
    labels = distance.label_distances(left, right, ["l"]).first()
    p, q = {"p": 200 / 301, "q": 101 / 301}, {"p": 1.0}
    want = sum((p.get(k, 0) - q.get(k, 0)) ** 2 / (p.get(k, 0) + q.get(k, 0)) for k in "pq") / 2
    assert labels.chi_square == pytest.approx(want, abs=1e-6) and labels.total_variation == pytest.approx(101 / 301, abs=1e-6)


# -- retrieval -----------------------------------------------------------------------------------


def test_index_answers_like_a_scan(spark):
    from paylens.operators import texts

    rng = random.Random(2)
    stems = ["alpha", "Beta", "gamma", "delta.", "epsilon", "(zeta)", "etaeta", "theta,iota"]
    rows = [(i, "\n".join(rng.choice(stems) + rng.choice(("", "x", " ")) for _ in range(rng.randrange(12)))) for i in range(80)] + [(99, None), (100, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = scratch_path(spark, "index")
    retrieval.build_index(docs, path, parts=8)
    for question in ("alphax gamma delta.", "zetaa epsil theta,iota", "beta) beta gammax BETAx", "nothing-like-it"):
        want = texts.retrieve(docs, question, 5).collect()
        assert retrieval.retrieve(spark, path, docs, question, 5).collect() == want
    opened = retrieval.hit_postings(spark, path, ["epsil"])
    assert "PartitionFilters" in opened._jdf.queryExecution().executedPlan().toString()
    parts = {r.part for r in retrieval.matching_tokens(spark, path, ["epsil"]).collect()}
    assert 0 < len(parts) < 8


# -- functions for SQL ---------------------------------------------------------------------------


def test_aggregate_function_in_parts(spark):
    values = [(k, float(v)) for k in "ab" for v in range(-3, 40)] + [("c", -1.0), ("d", None)]
    df = spark.createDataFrame(values, "k string, v double").repartition(5)
    partial, final = aggregate.register_geometric_mean(spark, "gm")
    got = {r.k: r.g for r in aggregate.aggregate_in_parts(df, ["k"], F.col("v"), partial, final, "g", parts=3).collect()}
    want = math.exp(sum(math.log(v) for v in range(1, 40)) / 39)
    assert got["a"] == pytest.approx(want) and got["b"] == pytest.approx(want) and got["c"] is None and got["d"] is None
    df.createOrReplaceTempView("gm_values")
    sql = spark.sql("SELECT k, gm(s) AS g FROM (SELECT k, gm_partial(v) AS s FROM gm_values GROUP BY k) GROUP BY k")
    assert {r.k: r.g for r in sql.collect()} == pytest.approx(got)


def test_table_function_keeps_state_across_batches(spark):
    rng, rows = random.Random(3), []
    for key in range(5):
        at = 0
        for _ in range(60):
            at += rng.choice((0, 5, 1799, 1800, 4000))
            rows.append((key, at))
    spark.createDataFrame(rows, "key long, second long").repartition(4).createOrReplaceTempView("session_rows")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        aggregate.register_sessions(spark, "visits")
        got = spark.sql("SELECT * FROM visits(TABLE(session_rows) PARTITION BY key ORDER BY second)").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = []
    for key in range(5):
        visit = []
        for s in sorted(s for k, s in rows if k == key):
            if visit and s - visit[-1] >= 1800:
                want.append((key, visit[0], visit[-1], len(visit)))
                visit = []
            visit.append(s)
        want.append((key, visit[0], visit[-1], len(visit)))
    assert sorted(map(tuple, got)) == sorted(want)
