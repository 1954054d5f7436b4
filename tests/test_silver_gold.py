"""Silver rules, Gold measures, the layered run."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from paylens.operators import aggregates as agg
from paylens.plans import medallion
from paylens.session import scratch_path

D = decimal.Decimal
SCHEMA = (
    "transaction_id string, amount decimal(18,2), status string, merchant_id string, customer_id string, "
    "transaction_date date, payment_method string, k long, ingestion_timestamp timestamp_ntz"
)


def row(tid, amount, status="COMPLETED", merchant="M1", customer="C1", day=1, method="UPI", k=0, hour=0):
    return (
        tid, D(str(amount)), status, merchant, customer, datetime.date(2024, 3, day), method, k,
        datetime.datetime(2024, 3, 1, hour),
    )


@pytest.fixture
def merchants(spark):
    return spark.createDataFrame(
        [("M1", "Alpha", "Travel", "Pune"), ("M2", "Beta", "Grocery", "Delhi"), ("M3", "Idle", "Grocery", "Delhi")],
        "merchant_id string, merchant_name string, category string, city string",
    )


def silver_of(spark, merchants, rows):
    return medallion.to_silver(spark.createDataFrame(rows, SCHEMA), merchants)


def test_silver_drops_null_blank_and_negative_and_keeps_zero(spark, merchants):
    rows = [row(None, 1), row(" ", 1), row("a", -1), row("b", 0), row("c", 5)]
    assert sorted(r["transaction_id"] for r in silver_of(spark, merchants, rows).collect()) == ["b", "c"]


def test_latest_copy_wins(spark, merchants):
    rows = [row("a", 1, hour=3, k=1), row("a", 2, hour=9, k=2), row("a", 3, hour=5, k=3)]
    got = silver_of(spark, merchants, rows).collect()
    assert [r["amount"] for r in got] == [D("2.00")]


def test_unmatched_merchant_is_kept_and_flagged(spark, merchants):
    got = {r["transaction_id"]: r for r in silver_of(spark, merchants, [row("a", 1), row("b", 1, merchant="MX")]).collect()}
    assert got["a"]["quality_flag"] == "CLEAN" and got["a"]["merchant_name"] == "Alpha"
    assert got["b"]["quality_flag"] == "UNMATCHED" and got["b"]["merchant_name"] is None


def test_failure_rate_and_revenue(spark, merchants):
    facts = spark.createDataFrame([row("a", 100), row("b", 70, "FAILED"), row("c", 30, merchant="MX")], SCHEMA)
    got = {r["merchant_id"]: r for r in agg.merchant_performance(facts, merchants).collect()}
    assert got["M1"]["failure_rate_pct"] == 50.0 and got["M1"]["total_revenue"] == 100.0 and got["M1"]["txn_count"] == 2
    assert got["MX"]["merchant_name"] == ""
    assert "M3" not in got


def test_daily_summary_counts_distinct(spark):
    facts = spark.createDataFrame(
        [row("a", 1, customer="C1"), row("b", 2, customer="C2"), row("c", 3, customer="C1", merchant="M2"), row("d", 4, day=2)], SCHEMA
    )
    got = {r["report_date"].day: r for r in agg.daily_summary(facts).collect()}
    assert (got[1]["unique_customers"], got[1]["unique_merchants"], got[1]["total_txns"]) == (2, 2, 3)


def test_mart_denominator_and_idle_merchants(spark, merchants):
    facts = spark.createDataFrame([row("a", 10), row("b", 10, "FAILED"), row("c", 10, "PENDING")], SCHEMA)
    inner = agg.merchant_mart(facts, merchants).collect()
    assert len(inner) == 1 and inner[0]["total_transactions"] == 2 and inner[0]["failure_rate_pct"] == 50.0
    outer = {r["merchant_id"]: r for r in agg.merchant_mart(facts, merchants, keep_idle=True).collect()}
    assert outer["M3"]["total_transactions"] == 0 and outer["M3"]["avg_transaction_value"] == 0.0


def test_ltv_prefers_most_used_method_and_breaks_ties_by_name(spark):
    facts = spark.createDataFrame(
        [row("a", 10, method="UPI"), row("b", 20, method="UPI", day=3), row("c", 5, method="DEBIT_CARD", status="FAILED"),
         row("d", 5, customer="C2", method="UPI"), row("e", 5, customer="C2", method="CREDIT_CARD")], SCHEMA
    )
    got = {r["customer_id"]: r for r in agg.customer_ltv(facts).collect()}
    assert got["C1"]["preferred_payment_method"] == "UPI" and got["C1"]["total_spent"] == 30.0
    assert got["C1"]["avg_txn_value"] == 15.0 and got["C1"]["last_txn_date"].day == 3
    assert got["C2"]["preferred_payment_method"] == "CREDIT_CARD"


def test_cutoff_day_is_excluded(spark):
    facts = spark.createDataFrame([row("a", 1, day=5), row("b", 1, day=6)], SCHEMA)
    assert [r["transaction_id"] for r in facts.where(F.col("transaction_date") > datetime.date(2024, 3, 5)).collect()] == ["b"]


@pytest.mark.parametrize("grain", ["day", "month"])
def test_layered_run_twice_gives_the_same_tables(spark, merchants, grain):
    rows = [row(str(i), i, day=1 + i % 3, merchant="M1" if i % 2 else "MX") for i in range(30)] + [row("3", 3)]
    bronze, out = spark.createDataFrame(rows, SCHEMA), scratch_path(spark, "run")
    first = medallion.run(spark, bronze, merchants, out, grain=grain)
    tables = ["silver", "merchant_performance", "daily_summary", "customer_ltv"]
    before = {t: sorted(map(str, spark.read.parquet(f"{out}/{t}").collect())) for t in tables}
    again = medallion.run(spark, bronze, merchants, out, grain=grain)
    after = {t: sorted(map(str, spark.read.parquet(f"{out}/{t}").collect())) for t in tables}
    assert before == after and first == again
    assert (first.rows_in, first.rows_valid, first.rows_out) == (31, 31, 30)


def test_gate_stops_before_silver(spark, merchants):
    rows = [row("a", 1), row(None, 1)]
    out = scratch_path(spark, "halted")
    with pytest.raises(medallion.QualityHalt):
        medallion.run(spark, spark.createDataFrame(rows, SCHEMA), merchants, out)
    from paylens.sources.readers import read_or_skip

    assert read_or_skip(spark, f"{out}/silver") == (None, "source_missing")


def test_exact_median_matches_sorting(spark):
    import random

    for n in (1, 2, 7, 200, 1001):
        rng = random.Random(n)
        values = [round(rng.expovariate(1 / 50), 2) for _ in range(n)]
        ordered = sorted(values)
        want = (ordered[(n - 1) // 2] + ordered[n // 2]) / 2
        df = spark.createDataFrame([(D(str(v)),) for v in values] + [(None,)], "v decimal(18,2)")
        assert agg.exact_median(df, F.col("v")).first()["median"] == pytest.approx(want, abs=1e-9)


def test_segments_and_tiers(spark):
    from paylens.functions.numeric import merchant_tier, spend_segment

    df = spark.createDataFrame([(v,) for v in (199.0, 200.0, 1000.0, 5000.0, 5000.01, 100000.0, 500000.0, 1000000.0)], "v double")
    got = {r["v"]: (r["s"], r["t"]) for r in df.select("v", spend_segment(F.col("v")).alias("s"), merchant_tier(F.col("v")).alias("t")).collect()}
    assert [got[v][0] for v in (199.0, 200.0, 1000.0, 5000.0, 5000.01)] == ["Low", "Mid", "High", "High", "VIP"]
    assert [got[v][1] for v in (5000.0, 100000.0, 500000.0, 1000000.0)] == ["BRONZE", "SILVER", "GOLD", "PLATINUM"]


def test_staging_models(spark):
    from paylens.plans.staging import STAGING, staging_model

    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    for name, (source, key, columns) in STAGING.items():
        names = columns
        full = spark.createDataFrame([tuple("1" for _ in names) + ("x",), tuple(None if n == key else "1" for n in names) + ("x",)], [*names, "extra"])
        out = staging_model(name, {source: full}, at)
        assert out.columns == [*names, "_loaded_at"]
        assert out.count() == (1 if key else 2), name


def test_recorded_runs(spark, merchants):
    out = scratch_path(spark, "recorded")
    good = spark.createDataFrame([row("a", 1)], SCHEMA)
    assert medallion.run_recorded(spark, "r1", good, merchants, out) == "SUCCESS"
    assert medallion.run_recorded(spark, "r2", None, merchants, out) == "SKIPPED"
    with pytest.raises(medallion.QualityHalt):
        medallion.run_recorded(spark, "r3", spark.createDataFrame([row(None, 1)], SCHEMA), merchants, out)
    got = {r["run_id"]: (r["status"], r["rows_out"]) for r in spark.read.json(f"{out}/runs/*").collect()}
    assert got == {"r1": ("SUCCESS", 1), "r2": ("SKIPPED", 0), "r3": ("FAILED", 0)}


def test_missing_csv_skips_the_day(spark):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    assert medallion.ingest_bronze(spark, scratch_path(spark, "absent"), scratch_path(spark, "bronze"), "r", at) == "source_missing"
