"""Checks, quarantine, fixes, decisions, drift and privacy on small rows."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paylens.operators import contracts, drift, privacy, quality
from paylens.operators.quality import Check

ROWS = [
    ("T1", "10", "2024-01-01", "INR"),
    ("T1", "20", "2024-01-02", "INR"),
    (None, "-5", "99-99-9999", "XYZ"),
    (" ", "abc", "31-01-2024", None),
    ("T2", None, None, "USD"),
    ("T3", "2000000", "2024-02-30", "EUR"),
]
SUITE = [
    Check("not_null", "transaction_id", severity="critical"),
    Check("unique", "transaction_id", severity="critical"),
    Check("between", "amount", low=0, high=1000000),
    Check("strict_date", "transaction_date"),
    Check("in_set", "currency", values=("INR", "USD", "EUR")),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "transaction_id string, amount string, transaction_date string, currency string")


def outcome(df):
    return {(r["check_name"], r["column_name"]): (r["value"], r["status"]) for r in df.collect()}


def test_suite_counts(rows):
    got = outcome(quality.run_suite(rows, SUITE))
    assert got[("not_null", "transaction_id")] == (2.0, "fail")
    assert got[("unique", "transaction_id")] == (4.0, "fail")
    assert got[("between", "amount")] == (4.0, "fail")
    assert got[("strict_date", "transaction_date")] == (4.0, "fail")
    assert got[("in_set", "currency")] == (2.0, "fail")


def test_missing_column_is_an_error_not_a_pass(rows):
    assert outcome(quality.run_suite(rows, [Check("not_null", "city")])) == {("not_null", "city"): (None, "error")}


def test_nulls_can_be_skipped(rows):
    got = outcome(quality.run_suite(rows, [Check("in_set", "currency", values=("INR", "USD", "EUR"), nulls="skip")]))
    assert got[("in_set", "currency")] == (1.0, "fail")


def test_second_unique_check_and_table_checks(rows):
    got = outcome(
        quality.run_suite(
            rows, [Check("unique", "transaction_id"), Check("unique", "currency"), Check("row_count", low=1, high=10), Check("minimum", "amount", low=0)]
        )
    )
    assert got[("unique", "currency")] == (2.0, "fail") and got[("row_count", "")] == (6.0, "pass")
    assert got[("minimum", "amount")] == (-5.0, "fail")


def test_empty_table(spark, rows):
    got = outcome(quality.run_suite(rows.limit(0), [*SUITE, Check("row_count", low=1)]))
    assert got[("not_null", "transaction_id")] == (0.0, "pass") and got[("row_count", "")] == (0.0, "fail")


def test_quarantine_keeps_every_row_with_reasons_in_suite_order(rows):
    clean, bad = quality.quarantine_split(rows, SUITE)
    reasons = sorted(r["_quarantine_reason"] for r in bad.collect())
    both = "not_null:transaction_id; unique:transaction_id"
    assert reasons == [both, both, "unique:transaction_id", "unique:transaction_id"]
    assert clean.count() + bad.count() == len(ROWS)


def test_single_missing_key_is_not_a_duplicate(spark):
    from paylens.operators.dedup import flag_duplicates

    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "id string")
    assert {r["id"]: r["is_duplicate"] for r in flag_duplicates(df, F.col("id")).collect()} == {"a": True, None: False, "b": False}


def test_hot_key_duplicates(spark):
    from paylens.operators.dedup import flag_duplicates

    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("id"))
    got = {r["is_duplicate"]: r["n"] for r in flag_duplicates(df, F.col("id")).groupBy("is_duplicate").agg(F.count("*").alias("n")).collect()}
    assert got == {True: 10000, False: 20000}


@pytest.mark.parametrize(
    ("total", "bad", "critical", "want"),
    [(100, 0, False, ("load_clean", False)), (100, 5, True, ("quarantine_and_load", True)), (100, 5, False, ("quarantine_and_load", False)),
     (100, 20, False, ("quarantine_and_load", True)), (100, 21, False, ("reject_all", True))],
)
def test_load_decision(spark, total, bad, critical, want):
    counts = spark.range(1).select(*quality.load_decision(F.lit(total), F.lit(bad), F.lit(critical))).first()
    assert (counts["load_decision"], counts["alert_required"]) == want


def test_auto_fix(rows):
    fixed = {(r["transaction_id"], r["amount"], r["transaction_date"]) for r in quality.auto_fix(rows).collect()}
    assert ("T2", "15.0", None) in fixed and ("T3", "2000000", "INVALID_DATE") in fixed
    log = {r["fix"]: r["rows_affected"] for r in quality.fix_log(rows).collect()}
    assert log == {"null_amount_filled_with_median": 1, "invalid_dates_marked": 3, "whitespace_stripped": 1}


def test_profile(rows):
    got = {r["column_name"]: r for r in quality.profile(rows).collect()}
    amount, tid = got["amount"], got["transaction_id"]
    assert amount["inferred_type"] == "numeric" and amount["negative_count"] == 1 and amount["null_count"] == 1
    assert (tid["null_count"], tid["unique_count"], tid["inferred_type"]) == (2, 3, "string")
    assert quality.completeness(rows, rows.columns).first()["completeness_pct"] == 79.2
    quick = {r["column_name"]: r["null_count"] for r in quality.quick_profile(rows, rows.columns).collect()}
    assert quick["transaction_id"] == 2


def test_scan_checks_two_pass_four_fail(spark):
    day = spark.createDataFrame(
        [("O1", "C1", 12.0, "COMPLETED"), ("O2", "C2", -5.0, "COMPLETED"), ("O3", "C3", 30.0, "ODD"), ("O4", None, 4.0, "PENDING"), ("O1", "C1", 12.0, "COMPLETED")],
        "order_id string, customer_id string, amount double, status string",
    )
    wanted = contracts.ScanChecks(["order_id", "customer_id"], ["order_id"], {"amount": 0.0}, {"status": ["COMPLETED", "PENDING", "FAILED"]})
    got = {r["check_name"]: r["outcome"] for r in contracts.scan_checks(day, wanted).collect()}
    assert [n for n, o in got.items() if o == "pass"] == ["row_count", "missing_count(order_id)"] and len(got) == 6


def test_model_tests(spark):
    facts = spark.createDataFrame([("a", "M1"), ("a", "M9"), (None, None)], "id string, merchant_id string")
    dim = spark.createDataFrame([("M1",)], "merchant_id string")
    tests = [contracts.ModelTest("not_null", "id"), contracts.ModelTest("unique", "id"), contracts.ModelTest("relationships", "merchant_id")]
    got = {r["test"]: r["failures"] for r in contracts.model_tests(facts, tests, {"merchant_id": dim}).collect()}
    assert got == {"not_null": 1, "unique": 1, "relationships": 1}


def test_build_stops_at_a_failed_test(spark):
    from paylens.plans.build import Model, TestFailure, build
    from paylens.session import scratch_path

    seen = []

    def late(built):
        seen.append("late")
        return built["raw"]

    models = [
        Model("raw", lambda b: spark.range(3).selectExpr("id % 2 as id"), "table", (contracts.ModelTest("unique", "id"),)),
        Model("late", late),
    ]
    with pytest.raises(TestFailure, match=r"raw: unique\(id\)=1"):
        build(spark, models, scratch_path(spark, "build"))
    assert seen == []


def test_domain_violations_and_verdict(spark):
    df = spark.createDataFrame(
        [("a", 150000.0, "COMPLETED", "M1", datetime.date(2024, 1, 1), "UPI"), ("b", 0.0, "COMPLETED", "M9", datetime.date(2099, 1, 1), "CARD"),
         ("c", 5.0, "APPROVED", "M1", datetime.date(2024, 1, 1), "CARD")],
        "transaction_id string, amount double, status string, merchant_id string, transaction_date date, payment_method string",
    )
    dim = spark.createDataFrame([("M1",)], "merchant_id string")
    as_of = F.lit(datetime.date(2024, 6, 1))
    got = sorted((r["transaction_id"], r["violation"]) for r in quality.domain_violations(df, dim, as_of).collect())
    assert got == [("a", "upi_over_limit"), ("b", "future_date"), ("b", "unknown_merchant"), ("b", "zero_completed"), ("c", "unknown_status")]
    cases = spark.createDataFrame(
        [("t1", 10.0, "INR", datetime.date(2024, 1, 1), None), ("t2", -1.0, "INR", datetime.date(2024, 1, 1), None), ("t3", 1.0, "ZZZ", datetime.date(2024, 1, 1), None),
         ("t4", 1.0, "INR", datetime.date(2030, 1, 1), None), ("t5", 9e5, "INR", datetime.date(2024, 1, 1), None), ("t6", 9e5, "INR", datetime.date(2024, 1, 1), "health"),
         (None, 1.0, "INR", datetime.date(2024, 1, 1), None)],
        "transaction_id string, amount double, currency string, transaction_date date, category string",
    )
    got = [r["v"] for r in cases.select(quality.verdict(as_of, ["INR"]).alias("v")).collect()]
    assert got == ["PASS", "QUARANTINE", "QUARANTINE", "QUARANTINE", "FLAG", "PASS", "QUARANTINE"]


def schema(text):
    return StructType.fromDDL(text)


@pytest.mark.parametrize(
    ("before", "after", "level"),
    [("a int", "a int", "NONE"), ("a int", "a int, b string", "LOW"), ("a int", "a int, b string not null", "HIGH"), ("a int", "a bigint", "HIGH"),
     ("a bigint", "a int", "BREAKING"), ("a int, b string", "a int", "BREAKING")],
)
def test_drift_severity(before, after, level):
    want, have = schema(before), schema(after)
    assert drift.severity(drift.schema_changes(want, have), {f.name: f.nullable for f in have}) == level


def test_evolve_restores_flags_and_keeps(spark):
    df = spark.createDataFrame([("1", "x", 2.0), ("oops", "y", 3.0)], "amount string, note string, score double")
    out = drift.evolve(df, schema("id string, amount int"))
    assert out.columns == ["id", "amount", "amount_anomaly", "note", "score", "score_anomaly"]
    assert [(r["amount"], r["amount_anomaly"]) for r in out.collect()] == [(1, False), (None, True)]
    report = {r["column_name"]: (r["action"], r["rows_touched"]) for r in drift.drift_report(df, schema("id string, amount int")).collect()}
    assert report == {"id": ("HALT", 2), "amount": ("FLAG_ANOMALY", 1), "note": ("ADD_TO_SCHEMA", 2), "score": ("FLAG_ANOMALY", 2)}


def test_account_numbers_are_not_taken_for_national_ids(spark):
    df = spark.createDataFrame([("123456789012", "123456789012", "a@b.co", "x")] * 3, "account_number string, aadhaar string, contact string, note string")
    got = {r["column_name"]: (r["pii_type"], r["confidence"]) for r in privacy.detect(df, df.columns).collect()}
    assert got == {"account_number": ("account_number", "high"), "aadhaar": ("aadhaar_number", "high"), "contact": ("email_address", "high")}
    assert privacy.dataset_tier(privacy.detect(df, df.columns)).first()["dataset_tier"] == "Restricted"


def test_redaction_and_statements(spark):
    text = "call +919876543210 or me@site.org, card 4111 1111 1111 1111 end"
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(privacy.redact(F.col("t"))).first()[0] == "call [PHONE] or [EMAIL], card [CARD] end"
    cases = spark.createDataFrame([("select 1 from fact where x",), ("please drop it",), ("backdrop dropped",), ("",)], "t string")
    assert [r[0] for r in cases.select(privacy.destructive(F.col("t"))).collect()] == [False, True, False, False]


def test_masks(spark):
    from paylens.functions import masking

    df = spark.createDataFrame([("9876543210", "joe@site.org", "ABCDE1234F", 7)], "p string, e string, n string, id long")
    got = df.select(masking.last_four(F.col("p")), masking.hashed_mailbox(F.col("e")), masking.shape_token(F.col("n")), masking.pseudonym(F.col("id"))).first()
    short = spark.createDataFrame([("1234",), ("7",), ("",), (None,)], "p string").select(masking.last_four(F.col("p")).alias("p"))
    assert [r["p"] for r in short.collect()] == ["XXXX", "X", "", None]
    assert got[0] == "XXXXXX3210" and got[1].endswith("@site.org") and "joe" not in got[1] and got[2] == "AAAAA9999A" and got[3].startswith("Person-")


def test_objectives_alerts_and_rollup(spark):
    from paylens.operators import monitoring as m

    metrics = spark.range(1).selectExpr(
        "30.0D as freshness_hours", "99.87D as quality_pct", "25.0D as rows_per_day", "10.0D as runtime_minutes", "31.0D as max_failure_rate_pct", "0 as new_methods"
    )
    fired = {r["rule"] for r in m.evaluate_alerts(metrics).where("fired").collect()}
    assert fired == {"data_freshness_breach", "quality_threshold_breach", "quality_slightly_below_threshold", "merchant_failure_rate_spike", "row_count_near_bounds"}
    results = m.evaluate_objectives(metrics, [m.Objective("fresh", "freshness_hours", high=24), m.Objective("rows", "rows_per_day", 17, 25)])
    assert m.status_rollup(results, ["fresh"]).first()["status"] == "CRITICAL"
    assert m.status_rollup(results, []).first()["status"] == "DEGRADED"
