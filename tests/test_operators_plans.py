"""Operators against brute force, plan shapes, and the registry's contract."""

import datetime
import os
import random
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from paylens import queries
from paylens.operators import aggregates, dedup, joins, sets, texts, windows
from paylens.operators.dedup import latest_per_key

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_running_total_matches_cumulative_sum(spark):
    rng = random.Random(3)
    values = {rng.randint(0, 10**6): rng.randint(1, 9) for _ in range(3000)}
    df = spark.createDataFrame(list(values.items()), "v long, n long")
    got = {r["v"]: r["cum"] for r in windows.running_total(df, "v", "n", "cum").collect()}
    total, want = 0, {}
    for v in sorted(values):
        total += values[v]
        want[v] = total
    assert got == want


def test_rolling_sum_matches_brute_force(spark):
    rng = random.Random(5)
    start = datetime.datetime(2024, 1, 1)
    rows = [(rng.choice("ab"), start + datetime.timedelta(seconds=rng.randint(0, 40000)), rng.randint(1, 50)) for _ in range(300)]
    df = spark.createDataFrame(rows, "m string, ts timestamp_ntz, v long")
    got = windows.rolling_sum(df, "m", "ts", F.col("v"), 14400, "loss", 100).collect()
    epoch = datetime.datetime(1970, 1, 1)
    for r in got:
        want = sum(v for m, ts, v in rows if m == r["m"] and r["second"] - 14400 <= (ts - epoch).total_seconds() <= r["second"])
        assert r["loss"] == want and r["breach"] == (want > 100)


def test_first_gap_after_change(spark):
    from paylens.operators.recovery import change_then_silence

    series = spark.createDataFrame([(0, 1), (300, 0), (600, 2), (900, 0)], "bucket long, n long")
    changes = spark.createDataFrame([(1, 0), (2, 300), (3, 600), (4, 900)], "change_id long, bucket long")
    assert {r["change_id"]: r["first_gap"] for r in change_then_silence(changes, series, "bucket").collect()} == {1: 300, 2: 300, 3: 900, 4: 900}


def test_reconcile_outcomes(spark):
    schema = "id string, gateway string, amount double"
    ledger = spark.createDataFrame([("a", "g", 10.0), ("b", "g", 10.0), ("c", "g", 10.0), ("d", "g", 10.0)], schema)
    gateway = spark.createDataFrame([("a", "g", 11.0), ("b", "g", 11.5), ("c", "g", 10.0), ("z", "g", 1.0)], schema)
    got = {r["id"]: r["outcome"] for r in joins.reconcile(ledger, gateway, "id", "amount", "gateway").collect()}
    assert got == {"a": "matched", "b": "disputed", "c": "matched", "d": "missing", "z": "gateway_only"}


def test_not_yet_loaded_keeps_rows_without_id(spark):
    source = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), ("", 5)], "id string, v long")
    loaded = spark.createDataFrame([("a",)], "id string")
    got = sorted(r["v"] for r in joins.not_yet_loaded(source, loaded, "id", [F.asc("v")]).collect())
    assert got == [2, 4, 5]


def test_coverage_tiers(spark):
    rows = [("x", i) for i in "abcd"] + [("y", i) for i in "ab"] + [("z", "c")] + [("w", "q")]
    df = spark.createDataFrame(rows, "who string, item string")
    got = {r["who"]: r["tier"] for r in aggregates.coverage(df, "who", "item", ["a", "b"], ["c", "d"]).collect()}
    assert got == {"x": "master", "y": "complete", "z": "partial", "w": "missing"}


def test_error_fingerprint_ignores_paths_and_lines(spark):
    from paylens.functions.text import error_fingerprint

    trace = 'Traceback (most recent call last):\n  File "%s", line %d, in f\n    go(x)\n    ~~^^^\nKeyError: %s'
    df = spark.createDataFrame([(trace % ("/a.py", 1, "k"),), (trace % ("/b.py", 99, "k"),), (trace % ("/a.py", 1, "other"),)], "log string")
    a, b, c = [r[0] for r in df.select(error_fingerprint(F.col("log"))).collect()]
    assert a == b != c and len(a) == 12


def test_text_operators(spark):
    df = spark.createDataFrame([(1, "Nothing here. The schema mismatch broke loading. End"), (2, "schema")], "doc_id long, text string")
    best = df.select(texts.best_sentence(F.col("text"), "schema mismatch loading").alias("b")).first()["b"]
    assert best["sentence"] == "The schema mismatch broke loading" and best["score"] == 3
    assert [r["doc_id"] for r in texts.retrieve(df, "the schema mismatch", 5).collect()] == [1, 2]
    mood = spark.createDataFrame([("all good, very happy!",), ("failed, failed again but good",), ("done",)], "t string")
    assert [round(r[0], 3) for r in mood.select(texts.sentiment(F.col("t"))).collect()] == [1.0, -0.333, 0.0]


def test_bounded_result(spark):
    shown, truncated = sets.bounded(spark.range(10), [F.asc("id")], 4)
    assert [r["id"] for r in shown.collect()] == [0, 1, 2, 3] and truncated.first()["truncated"]
    assert not sets.bounded(spark.range(4), [F.asc("id")], 4)[1].first()["truncated"]


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as key", "id as v")
    plan = plan_of(latest_per_key(df, ["key"], [F.desc("v")]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_merchant_names_join_after_grouping(spark, sf):
    from paylens.queries import data

    plan = plan_of(aggregates.merchant_performance(data.transactions(spark, sf), data.merchants(spark, sf)))
    assert plan.index("LeftOuter") < plan.index("partial_sum")
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_filter_and_columns_reach_the_scan(spark, sf):
    from paylens.queries import data

    df = data.table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    plan = plan_of(df)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "o_totalprice" not in plan


def test_partition_filter_prunes_folders(spark):
    from paylens.session import scratch_path
    from paylens.sources import readers, writers

    path = scratch_path(spark, "pruned")
    writers.replace_partitions(spark.range(10).selectExpr("id", "id % 2 as part"), path, ["part"])
    plan = plan_of(readers.read_partition(spark, path, "part", 1))
    assert "PartitionFilters: [isnotnull(part" in plan


@pytest.mark.parametrize("partitions", ["4", "64"])
def test_registered_dedup_limits_groups_on_both_sides_of_the_shuffle(spark, sf, partitions):
    from paylens.queries import load

    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        plan = plan_of(load()["w02_dedup_latest"].run(spark, sf))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "WindowGroupLimit" in plan and "REPARTITION" not in plan
    first, last = plan.index("WindowGroupLimit"), plan.rindex("WindowGroupLimit")
    assert "hashpartitioning(l_orderkey" in plan[first:last] and "l_linenumber" in plan[first:last]


def test_lower_date_bound_reaches_the_scan(spark, sf):
    from paylens.queries import load

    for name in ("f05_after_cutoff", "f07_rolling_window", "j12_dormant_gold"):
        assert "GreaterThanOrEqual(l_shipdate" in plan_of(load()[name].run(spark, sf)), name


def test_every_query_has_sql_and_families_are_complete():
    known = queries.load()
    assert len(known) >= 215
    assert [n for n, q in known.items() if q.sql is None] == []
    prefixes = {n[0] for n in known}
    assert prefixes == set("afjstuwepqrx")


def test_entry_module_loads_without_a_session():
    code = "import __spark_entry__ as e; from paylens.queries import load; assert set(load()) <= set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_workers_need_no_package_on_their_path(tmp_path, sf):
    """Run from another folder, the way a driver program elsewhere would."""
    code = (
        f"import sys; sys.path.insert(0, {ROOT!r}); import __spark_entry__ as e\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        f"assert e.queries()['x01_user_model'](spark, {sf!r}).count() > 0 and e.entry(spark).count() > 0"
    )
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


SAMPLE = [
    "a03_merchant_performance", "a05_customer_ltv", "j07_latest_child", "j16_source_target_hours", "w04_rolling_loss", "q01_profile", "q12_suite_run",
    "q14_quarantine_split", "p01_detect_columns", "p09_classify_rows", "s14_insert_only_merge", "u04_except_rows", "x02_metric_registry", "e09_boundary_differences",
]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, sf, name):
    sys.path.insert(0, os.path.join(ROOT, "tools"))
    from check_oracle import TABLES, normal

    q = queries.load()[name]
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got, want = normal(q.run(spark, sf).toPandas()), normal(con.sql(q.sql).df())
    assert list(got.columns) == list(want.columns) and got.equals(want)


def test_duplicate_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "id string")
    r = dedup.excess_rows(df, ["id"]).first()
    assert (r["rows"], r["distinct_keys"], r["excess"]) == (5, 2, 3)
    assert dedup.duplicate_keys(df, ["id"]).count() == 2
