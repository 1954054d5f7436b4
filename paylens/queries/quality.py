"""Data-quality operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from paylens.functions import numeric
from paylens.functions.dates import strict_date, wall_clock
from paylens.functions.text import blank_to_null, is_blank
from paylens.operators import distance, quality, recovery, sketches
from paylens.operators.aggregates import the_amount, is_failed, row_count
from paylens.operators.quality import Check
from paylens.queries import data
from paylens.queries.registry import query
from paylens.queries.sqlbase import REASON as REJECT_REASON
from paylens.queries.sqlbase import with_views
from paylens.session import scratch_path

COLUMNS = ["transaction_id", "amount", "transaction_date", "currency", "merchant_id", "status", "customer_id", "payment_method"]


def histogram_sql(columns, source):
    """Rows per (column, value) of ``source``, blanks as null."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CASE WHEN trim(CAST({c} AS VARCHAR)) <> '' THEN CAST({c} AS VARCHAR) END AS value, COUNT(*) AS n FROM {source} GROUP BY 2"
        for c in columns
    )


PROFILE = """SELECT column_name, CAST(SUM(n) AS BIGINT) AS total_rows,
   CAST(COALESCE(SUM(CASE WHEN value IS NULL THEN n END), 0) AS BIGINT) AS null_count,
   ROUND(CAST(100 AS DOUBLE) * COALESCE(SUM(CASE WHEN value IS NULL THEN n END), 0) / SUM(n), 1) AS null_pct,
   COUNT(value) AS unique_count, ROUND(CAST(100 AS DOUBLE) * COUNT(value) / SUM(n), 1) AS uniqueness_pct,
   CASE WHEN {num} THEN 'numeric' ELSE 'string' END AS inferred_type,
   CASE WHEN {num} THEN MIN(TRY_CAST(trim(value) AS DOUBLE)) END AS min_value,
   CASE WHEN {num} THEN MAX(TRY_CAST(trim(value) AS DOUBLE)) END AS max_value,
   CASE WHEN {num} THEN ROUND(SUM(TRY_CAST(trim(value) AS DOUBLE) * n) / SUM(CASE WHEN TRY_CAST(trim(value) AS DOUBLE) IS NOT NULL THEN n END), 2) END AS mean_value,
   CASE WHEN {num} THEN CAST(COALESCE(SUM(CASE WHEN TRY_CAST(trim(value) AS DOUBLE) < 0 THEN n END), 0) AS BIGINT) END AS negative_count
   FROM {h} GROUP BY 1""".replace("{num}", "COALESCE(SUM(CASE WHEN TRY_CAST(trim(value) AS DOUBLE) IS NOT NULL THEN n END), 0) > SUM(n) * 0.5")


@query("q01_profile", with_views("txn_dirty", PROFILE.replace("{h}", "h"), {"h": histogram_sql(COLUMNS, "txn_dirty")}))
def q01(spark, sf):
    return quality.profile(data.transactions_dirty(spark, sf), COLUMNS)


FILLED = " + ".join(f"COUNT(CASE WHEN trim({c}) <> '' THEN 1 END)" for c in COLUMNS)


@query(
    "q02_completeness",
    with_views("txn_dirty", f"SELECT COUNT(*) AS total_rows, ROUND(CAST(100 AS DOUBLE) * ({FILLED}) / (COUNT(*) * {len(COLUMNS)}), 1) AS completeness_pct FROM txn_dirty"),
)
def q02(spark, sf):
    return quality.completeness(data.transactions_dirty(spark, sf), COLUMNS)


BLANK_ID = "(transaction_id IS NULL OR trim(transaction_id) = '')"
KEY = "CASE WHEN trim(transaction_id) <> '' THEN transaction_id END"
BAD_AMOUNT = "COALESCE(TRY_CAST(trim(amount) AS DOUBLE) < 0 OR TRY_CAST(trim(amount) AS DOUBLE) > 1000000, TRUE)"
BAD_DATE = r"COALESCE(NOT regexp_matches(transaction_date, '^(?:^\d{4}-\d{2}-\d{2}$)'), TRUE)"
BAD_CURRENCY = "COALESCE(currency NOT IN ('INR', 'EUR', 'USD'), TRUE)"
BAD_STATUS = "COALESCE(status NOT IN ('COMPLETED', 'FAILED', 'PENDING'), TRUE)"

NOT_NULL = Check("not_null", "transaction_id", severity="critical")
UNIQUE = Check("unique", "transaction_id", severity="critical")
BETWEEN = Check("between", "amount", low=0, high=1000000)
ISO_DATE = Check("regex", "transaction_date", pattern=r"^\d{4}-\d{2}-\d{2}$")
CURRENCY = Check("in_set", "currency", values=("INR", "EUR", "USD"))
STATUS = Check("in_set", "status", values=("COMPLETED", "FAILED", "PENDING"), severity="medium")
SUITE = [NOT_NULL, UNIQUE, BETWEEN, ISO_DATE, CURRENCY, STATUS]


def failed_rows(spark, sf, check):
    """Rows that fail one row check, counted per payment method."""
    bad = data.transactions_dirty(spark, sf).where(quality.failing(check))
    return bad.groupBy("payment_method").agg(row_count().alias("failed"), F.sum("k").alias("key_sum"))


def failed_sql(condition):
    return with_views(
        "txn_dirty", f"SELECT payment_method, COUNT(*) AS failed, CAST(SUM(k) AS BIGINT) AS key_sum FROM txn_dirty WHERE {condition} GROUP BY 1"
    )


@query("q03_expect_not_null", failed_sql(BLANK_ID))
def q03(spark, sf):
    return failed_rows(spark, sf, NOT_NULL)


@query(
    "q04_expect_unique",
    with_views(
        "txn_dirty",
        f"""SELECT payment_method, COUNT(*) AS failed, CAST(SUM(k) AS BIGINT) AS key_sum FROM
            (SELECT *, COUNT(*) OVER (PARTITION BY {KEY}) AS c FROM txn_dirty) WHERE c > 1 GROUP BY 1""",
    ),
)
def q04(spark, sf):
    from paylens.operators.dedup import flag_duplicates

    rows = data.transactions_dirty(spark, sf).select("transaction_id", "payment_method", "k")
    bad = flag_duplicates(rows, blank_to_null(F.col("transaction_id"))).where("is_duplicate")
    return bad.groupBy("payment_method").agg(row_count().alias("failed"), F.sum("k").alias("key_sum"))


@query("q05_expect_between", failed_sql(BAD_AMOUNT))
def q05(spark, sf):
    return failed_rows(spark, sf, BETWEEN)


@query("q06_expect_in_set", failed_sql(BAD_CURRENCY))
def q06(spark, sf):
    return failed_rows(spark, sf, CURRENCY)


@query("q07_expect_regex", failed_sql(BAD_DATE))
def q07(spark, sf):
    return failed_rows(spark, sf, ISO_DATE)


def check_row(kind, column, severity, value, ok):
    return f"SELECT '{kind}' AS check_name, '{column}' AS column_name, '{severity}' AS severity, CAST({value} AS DOUBLE) AS value, CASE WHEN {ok} THEN 'pass' ELSE 'fail' END AS status"


@query(
    "q08_row_count_between",
    with_views("txn", check_row("row_count", "", "high", "COUNT(*)", "COUNT(*) BETWEEN 10 AND 1000000000") + " FROM txn"),
)
def q08(spark, sf):
    return quality.run_suite(data.transactions(spark, sf), [Check("row_count", low=10, high=1000000000)])


@query(
    "q09_mean_between",
    with_views(
        "txn",
        check_row("mean", "amount", "high", "ROUND(CAST(SUM(amount) AS DOUBLE) / COUNT(amount), 4)", "CAST(SUM(amount) AS DOUBLE) / COUNT(amount) BETWEEN 100 AND 5000") + " FROM txn",
    ),
)
def q09(spark, sf):
    return quality.run_suite(data.transactions(spark, sf), [Check("mean", "amount", low=100, high=5000)])


@query(
    "q10_scan_checks",
    with_views(
        "txn_dirty",
        f"""SELECT 'row_count' AS check_name, CAST(COUNT(*) AS DOUBLE) AS value, CASE WHEN COUNT(*) > 0 THEN 'pass' ELSE 'fail' END AS outcome FROM txn_dirty
        UNION ALL SELECT 'missing_count(transaction_id)', COUNT(CASE WHEN {BLANK_ID} THEN 1 END), CASE WHEN COUNT(CASE WHEN {BLANK_ID} THEN 1 END) = 0 THEN 'pass' ELSE 'fail' END FROM txn_dirty
        UNION ALL SELECT 'missing_count(customer_id)', 0, 'pass'
        UNION ALL SELECT 'duplicate_count(transaction_id)', COUNT(*), CASE WHEN COUNT(*) = 0 THEN 'pass' ELSE 'fail' END FROM
          (SELECT {KEY} AS key FROM txn_dirty WHERE trim(transaction_id) <> '' GROUP BY 1 HAVING COUNT(*) > 1)
        UNION ALL SELECT 'min(amount)', MIN(TRY_CAST(trim(amount) AS DOUBLE)), CASE WHEN MIN(TRY_CAST(trim(amount) AS DOUBLE)) >= 0 THEN 'pass' ELSE 'fail' END FROM txn_dirty
        UNION ALL SELECT 'invalid_count(status)', COUNT(CASE WHEN trim(status) <> '' AND status NOT IN ('COMPLETED','PENDING','FAILED') THEN 1 END),
          CASE WHEN COUNT(CASE WHEN trim(status) <> '' AND status NOT IN ('COMPLETED','PENDING','FAILED') THEN 1 END) = 0 THEN 'pass' ELSE 'fail' END FROM txn_dirty""",
    ),
)
def q10(spark, sf):
    from paylens.operators.contracts import ScanChecks, scan_checks

    wanted = ScanChecks(
        missing=["transaction_id", "customer_id"], duplicate=["transaction_id"], minimum={"amount": 0.0},
        valid={"status": ["COMPLETED", "PENDING", "FAILED"]},
    )
    return scan_checks(data.transactions_dirty(spark, sf), wanted)


@query(
    "q11_model_tests",
    with_views(
        "bronze dim_merchant",
        """SELECT 'not_null' AS test, 'transaction_id' AS column_name, COUNT(*) AS failures, COUNT(*) = 0 AS passed FROM bronze WHERE transaction_id IS NULL
        UNION ALL SELECT 'unique', 'transaction_id', COUNT(*), COUNT(*) = 0 FROM (SELECT transaction_id FROM bronze GROUP BY 1 HAVING COUNT(*) > 1)
        UNION ALL SELECT 'accepted_values', 'status', COUNT(*), COUNT(*) = 0 FROM bronze WHERE status NOT IN ('COMPLETED', 'FAILED')
        UNION ALL SELECT 'relationships', 'merchant_id', COUNT(*), COUNT(*) = 0 FROM bronze WHERE merchant_id NOT IN (SELECT merchant_id FROM dim_merchant)
        UNION ALL SELECT 'between', 'amount', COUNT(*), COUNT(*) = 0 FROM bronze WHERE amount < 1000 OR amount > 100000""",
    ),
)
def q11(spark, sf):
    from paylens.operators.contracts import ModelTest, model_tests

    return model_tests(
        data.bronze(spark, sf),
        [
            ModelTest("not_null", "transaction_id"), ModelTest("unique", "transaction_id"),
            ModelTest("accepted_values", "status", values=("COMPLETED", "FAILED")),
            ModelTest("relationships", "merchant_id"), ModelTest("between", "amount", low=1000, high=100000),
        ],
        {"merchant_id": data.merchants(spark, sf)},
    )


def suite_sql():
    def one(check, condition):
        count = f"COUNT(CASE WHEN {condition} THEN 1 END)"
        return check_row(check.kind, check.column, check.severity, count, f"{count} = 0") + " FROM marked"

    parts = [
        one(NOT_NULL, BLANK_ID), one(UNIQUE, "copies > 1"), one(BETWEEN, BAD_AMOUNT), one(ISO_DATE, BAD_DATE),
        one(CURRENCY, BAD_CURRENCY), one(STATUS, BAD_STATUS),
        "SELECT 'not_null', 'merchant_city', 'low', CAST(NULL AS DOUBLE), 'error'",
    ]
    return with_views("txn_dirty", " UNION ALL ".join(parts), {"marked": f"SELECT *, COUNT(*) OVER (PARTITION BY {KEY}) AS copies FROM txn_dirty"})


@query("q12_suite_run", suite_sql())
def q12(spark, sf):
    return quality.run_suite(data.transactions_dirty(spark, sf), [*SUITE, Check("not_null", "merchant_city", severity="low")])


MEDIAN = "(SELECT CAST(CAST(MEDIAN(TRY_CAST(trim(amount) AS DECIMAL(18,2))) AS DOUBLE) AS DECIMAL(18,3)) FROM txn_dirty)"


@query(
    "q13_auto_fix",
    with_views(
        "txn_dirty",
        rf"""SELECT status, COUNT(*) AS rows, COUNT(CASE WHEN day = 'INVALID_DATE' THEN 1 END) AS bad_days,
            CAST(SUM(TRY_CAST(amount AS DECIMAL(18,3))) AS DOUBLE) AS amount_sum FROM (SELECT trim(status) AS status,
            CASE WHEN trim(amount) <> '' THEN trim(amount) ELSE CAST(m AS VARCHAR) END AS amount,
            CASE WHEN transaction_date IS NOT NULL AND (NOT regexp_matches(transaction_date, '^\d{{4}}-\d{{2}}-\d{{2}}$')
              OR TRY_CAST(transaction_date AS DATE) IS NULL) THEN 'INVALID_DATE' ELSE transaction_date END AS day
            FROM txn_dirty, (SELECT {MEDIAN} AS m)) GROUP BY 1""",
    ),
)
def q13(spark, sf):
    fixed = quality.auto_fix(data.transactions_dirty(spark, sf))
    return fixed.groupBy("status").agg(
        row_count().alias("rows"), numeric.count_when(F.col("transaction_date") == "INVALID_DATE").alias("bad_days"),
        F.sum(F.col("amount").try_cast("decimal(18,3)")).cast("double").alias("amount_sum"),
    )


PADDED = " OR ".join(f"{c} <> trim({c})" for c in COLUMNS)


@query(
    "q13b_fix_log",
    with_views(
        "txn_dirty",
        rf"""SELECT 'null_amount_filled_with_median' AS fix, COUNT(*) AS rows_affected FROM txn_dirty WHERE amount IS NULL OR trim(amount) = ''
        UNION ALL SELECT 'invalid_dates_marked', COUNT(*) FROM txn_dirty WHERE NOT regexp_matches(transaction_date, '^\d{{4}}-\d{{2}}-\d{{2}}$')
          OR TRY_CAST(transaction_date AS DATE) IS NULL
        UNION ALL SELECT 'whitespace_stripped', COUNT(*) FROM txn_dirty WHERE {PADDED}""",
    ),
)
def q13b(spark, sf):
    return quality.fix_log(data.transactions_dirty(spark, sf))


REASON = "concat_ws('; ', CASE WHEN {blank} THEN 'not_null:transaction_id' END, CASE WHEN copies > 1 THEN 'unique:transaction_id' END)".replace("{blank}", BLANK_ID)
MARKED = {"marked": f"SELECT *, COUNT(*) OVER (PARTITION BY {KEY}) AS copies FROM txn_dirty"}


@query(
    "q14_quarantine_split",
    with_views("txn_dirty", f"SELECT {REASON} AS reason, COUNT(*) AS rows, CAST(SUM(k) AS BIGINT) AS key_sum FROM marked GROUP BY 1", MARKED),
)
def q14(spark, sf):
    marked = quality.critical_reasons(data.transactions_dirty(spark, sf), SUITE)
    return marked.groupBy(F.col("_quarantine_reason").alias("reason")).agg(row_count().alias("rows"), F.sum("k").alias("key_sum"))


FEED = """SELECT d.k, d.transaction_id, d.amount, d.transaction_date, CASE WHEN d.k % 2 = 0 THEN m.merchant_name END AS a,
   CASE WHEN d.k % 2 = 1 THEN m.merchant_name END AS b FROM txn_dirty d LEFT JOIN dim_merchant m ON m.merchant_id = d.merchant_id"""


def replay_feed(spark, sf):
    """Dirty rows as a stream delivers them: half of them with the renamed name field."""
    names = data.merchants(spark, sf).select("merchant_id", "merchant_name")
    joined = data.transactions_dirty(spark, sf).join(names, "merchant_id", "left")
    return joined.select(
        "k", "transaction_id", "amount", "transaction_date", "status", "ingestion_timestamp",
        F.when(F.col("k") % 2 == 0, F.col("merchant_name")).alias("merchant_name"),
        F.when(F.col("k") % 2 == 1, F.col("merchant_name")).alias("merchant_nm"),
    )


@query(
    "q15_row_validation",
    with_views(
        "txn_dirty dim_merchant",
        """SELECT reason, COUNT(*) AS rows, CAST(SUM(k) AS BIGINT) AS key_sum FROM (SELECT k, CASE
           WHEN transaction_id IS NULL OR trim(transaction_id) = '' THEN 'null_transaction_id'
           WHEN COALESCE(a, b) IS NULL THEN 'null_merchant_name'
           WHEN amount IS NULL OR trim(amount) = '' OR TRY_CAST(trim(amount) AS DOUBLE) <= 0 THEN 'zero_or_negative_amount'
           WHEN TRY_CAST(trim(amount) AS DOUBLE) IS NULL OR NOT isfinite(TRY_CAST(trim(amount) AS DOUBLE)) THEN 'invalid_amount'
   WHEN TRY_CAST(CASE WHEN regexp_matches(transaction_date, '^[0-9][0-9]-[0-9][0-9]-[0-9][0-9][0-9][0-9]$') THEN
     substr(transaction_date, 7, 4) || '-' || substr(transaction_date, 4, 2) || '-' || substr(transaction_date, 1, 2) ELSE transaction_date END AS DATE) IS NULL
   THEN 'invalid_date' ELSE 'ok' END AS reason FROM feed) GROUP BY 1""",
        {"feed": FEED},
    ),
)
def q15(spark, sf):
    judged = recovery.repair(replay_feed(spark, sf)).withColumn("reason", F.coalesce(recovery.reject_reason(), F.lit("ok")))
    return judged.groupBy("reason").agg(row_count().alias("rows"), F.sum("k").alias("key_sum"))


@query(
    "q16_load_decision",
    with_views(
        "txn_dirty",
        f"""SELECT total, quarantined, pct AS quarantine_pct, CASE WHEN pct > 20 THEN 'reject_all' WHEN quarantined > 0 THEN 'quarantine_and_load'
            ELSE 'load_clean' END AS load_decision, pct > 10 OR quarantined > 0 AS alert_required FROM
            (SELECT COUNT(*) AS total, COUNT(CASE WHEN {BLANK_ID} THEN 1 END) AS quarantined,
             ROUND(CAST(100 AS DOUBLE) * COUNT(CASE WHEN {BLANK_ID} THEN 1 END) / COUNT(*), 1) AS pct FROM txn_dirty)""",
    ),
)
def q16(spark, sf):
    critical = [NOT_NULL]
    marked = quality.flag_failures(data.transactions_dirty(spark, sf), critical)
    counts = marked.agg(row_count().alias("total"), numeric.count_when(F.col("_quarantine_reason") != "").alias("quarantined"))
    total, bad = F.col("total"), F.col("quarantined")
    return counts.select("total", "quarantined", *quality.load_decision(total, bad, bad > 0))


@query(
    "q17_halt_gate",
    with_views(
        "txn_dirty",
        f"""SELECT rows_in, rows_valid, CAST(rows_in - rows_valid AS DOUBLE) / rows_in > 0.05 AS halted FROM (SELECT COUNT(*) AS rows_in,
            COUNT(CASE WHEN trim(transaction_id) <> '' AND TRY_CAST(trim(amount) AS DECIMAL(18,2)) >= 0 THEN 1 END) AS rows_valid FROM txn_dirty)""",
    ),
)
def q17(spark, sf):
    from paylens.plans.medallion import HALT_SHARE

    ok = ~is_blank(F.col("transaction_id")) & (numeric.to_amount(the_amount()) >= 0)
    seen = data.transactions_dirty(spark, sf).agg(row_count().alias("rows_in"), numeric.count_when(ok).alias("rows_valid"))
    failed = numeric.ratio(F.col("rows_in") - F.col("rows_valid"), F.col("rows_in"))
    return seen.withColumn("halted", failed > HALT_SHARE)


SCORED = ["transaction_id", "amount", "status", "merchant_id"]
N_NULL = " + ".join(f"COUNT(CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 1 END)" for c in SCORED)
DUP = "CAST(COUNT(*) - COUNT(DISTINCT transaction_id) AS DOUBLE) / COUNT(*)"


@query(
    "q18_scorecard",
    with_views(
        "txn_dirty",
        "SELECT COUNT(*) AS total_rows, "
        + ", ".join(f"ROUND(CAST(100 AS DOUBLE) * COUNT(CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 1 END) / COUNT(*), 4) AS null_rate_{c}" for c in SCORED)
        + f""", ROUND({DUP} * 100, 4) AS duplicate_rate, 0 AS schema_match,
        ROUND(40 * (1 - CAST({N_NULL} AS DOUBLE) / (COUNT(*) * {len(SCORED)})) + 40 * (1 - {DUP}), 2) AS overall_quality_score FROM txn_dirty""",
    ),
)
def q18(spark, sf):
    return quality.scorecard(data.transactions_dirty(spark, sf), [*SCORED, "merchant_city"], "transaction_id")


@query(
    "q19_stage_accounting",
    with_views(
        "txn_dirty dim_merchant",
        f"""SELECT COUNT(*) AS rows_in, COUNT(CASE WHEN reason = '' THEN 1 END) AS rows_clean, COUNT(CASE WHEN reason <> '' THEN 1 END) AS rows_quarantined,
           COUNT(DISTINCT CASE WHEN reason = '' THEN transaction_id END) AS rows_out,
           COUNT(*) = COUNT(CASE WHEN reason = '' THEN 1 END) + COUNT(CASE WHEN reason <> '' THEN 1 END) AS balanced FROM (SELECT *, {REJECT_REASON} AS reason FROM feed)""",
        {"feed": FEED},
    ),
)
def q19(spark, sf):
    from paylens.operators.dedup import latest_per_key

    judged = recovery.repair(replay_feed(spark, sf)).withColumn("_reason", recovery.reject_reason())
    counts = judged.agg(
        row_count().alias("rows_in"), numeric.count_when(F.col("_reason").isNull()).alias("rows_clean"),
        numeric.count_when(F.col("_reason").isNotNull()).alias("rows_quarantined"),
    )
    unique = latest_per_key(judged.where("_reason IS NULL").select("transaction_id", "k"), ["transaction_id"], [F.desc("k")])
    out = unique.agg(row_count().alias("n")).scalar()
    return counts.withColumn("rows_out", out).withColumn(
        "balanced", F.col("rows_in") == F.col("rows_clean") + F.col("rows_quarantined")
    )


LAYER_COLUMNS = ["transaction_id", "amount", "status", "merchant_id", "customer_id", "transaction_date", "merchant_name", "category", "city"]


@query(
    "q20_layer_summary",
    with_views(
        "silver",
        """SELECT 'total_rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM silver
        UNION ALL SELECT 'amount_min', CAST(MIN(amount) AS DOUBLE) FROM silver UNION ALL SELECT 'amount_max', CAST(MAX(amount) AS DOUBLE) FROM silver
        UNION ALL SELECT 'amount_mean', ROUND(CAST(SUM(amount) AS DOUBLE) / COUNT(amount), 2) FROM silver
        UNION ALL SELECT 'unique_statuses', COUNT(DISTINCT status) FROM silver
        UNION ALL SELECT 'status_' || status, COUNT(*) FROM silver GROUP BY status
        UNION ALL """ + " UNION ALL ".join(
            f"SELECT 'null_rate_{c}', ROUND(100.0::DOUBLE * COUNT(CASE WHEN {c} IS NULL THEN 1 END) / COUNT(*), 4) FROM silver" for c in LAYER_COLUMNS
        ),
    ),
)
def q20(spark, sf):
    return quality.layer_summary(data.silver(spark, sf).select(*LAYER_COLUMNS), "amount", "status")


CONTRACT_RULES = [
    ("required", "transaction_id", "trim(transaction_id) = '' OR transaction_id IS NULL"),
    ("format", "transaction_id", "NOT regexp_matches(COALESCE(transaction_id, ''), '^(?:[0-9]+-[0-9]$)')"),
    ("enum", "currency", "COALESCE(currency NOT IN ('INR','USD','EUR','GBP'), TRUE)"),
    ("positive", "amount", "COALESCE(TRY_CAST(trim(amount) AS DOUBLE) <= 0, TRUE)"),
    ("date", "transaction_date", r"NOT regexp_matches(transaction_date, '^\d{4}-\d{2}-\d{2}$') OR TRY_CAST(transaction_date AS DATE) IS NULL"),
    ("enum", "status", "COALESCE(status NOT IN ('COMPLETED','PENDING','FAILED'), TRUE)"),
]


@query(
    "q26_contract_validation",
    with_views(
        "txn_dirty",
        " UNION ALL ".join(f"SELECT '{r}' AS rule, '{c}' AS field, COUNT(*) AS violations FROM txn_dirty WHERE {w}" for r, c, w in CONTRACT_RULES),
    ),
)
def q26(spark, sf):
    from paylens.operators.contracts import Field, validate_contract

    contract = [
        Field("transaction_id", pattern="[0-9]+-[0-9]$"), Field("currency", required=False, values=("INR", "USD", "EUR", "GBP")),
        Field("amount", required=False, positive=True), Field("transaction_date", required=False, is_date=True),
        Field("status", required=False, values=("COMPLETED", "PENDING", "FAILED")),
    ]
    return validate_contract(data.transactions_dirty(spark, sf), contract)


@query(
    "q27_self_heal",
    with_views(
        "txn_dirty",
        """SELECT payment_method, COUNT(*) AS rows, ROUND(CAST(SUM(CAST(COALESCE(TRY_CAST(trim(amount) AS DOUBLE), 0) AS DECIMAL(18,2))) AS DOUBLE), 2) AS amount,
           COUNT(CASE WHEN COALESCE(TRY_CAST(trim(amount) AS DOUBLE), 0) = 0 THEN 1 END) AS zeroed, CAST(0 AS BIGINT) AS cities
           FROM txn_dirty WHERE trim(transaction_id) <> '' GROUP BY 1""",
    ),
)
def q27(spark, sf):
    kept = quality.drop_missing_key(data.transactions_dirty(spark, sf), "transaction_id")
    healed = quality.add_or_drop(quality.add_or_drop(quality.numbers_or_zero(kept, ["amount"]), "currency"), "merchant_city")
    return healed.groupBy("payment_method").agg(
        row_count().alias("rows"), F.round(numeric.total(numeric.money(the_amount())), 2).alias("amount"),
        numeric.count_when(the_amount() == 0).alias("zeroed"), F.count("merchant_city").alias("cities"),
    )


RISKY = """SELECT transaction_id, CASE WHEN k % 59 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE amount * 2 END AS amount,
   CASE WHEN k % 53 = 0 THEN 'APPROVED' ELSE status END AS status, CASE WHEN k % 41 = 0 THEN 'MXXX' ELSE merchant_id END AS merchant_id,
   transaction_date, payment_method FROM txn"""


@query(
    "q28_domain_violations",
    with_views(
        "txn dim_merchant",
        """SELECT violation, COUNT(*) AS rows FROM (
           SELECT 'upi_over_limit' AS violation FROM r WHERE payment_method = 'UPI' AND amount > 100000
           UNION ALL SELECT 'future_date' FROM r WHERE transaction_date > DATE '2001-09-30'
           UNION ALL SELECT 'unknown_status' FROM r WHERE status NOT IN ('COMPLETED', 'FAILED', 'PENDING')
           UNION ALL SELECT 'unknown_merchant' FROM r WHERE merchant_id NOT IN (SELECT merchant_id FROM dim_merchant)
           UNION ALL SELECT 'zero_completed' FROM r WHERE status = 'COMPLETED' AND amount = 0) GROUP BY 1""",
        {"r": RISKY},
    ),
)
def q28(spark, sf):
    k = F.col("k")
    risky = data.bronze(spark, sf).withColumns(
        {
            "amount": F.when(k % 59 == 0, F.lit(0).cast("decimal(18,2)")).otherwise((the_amount() * 2).cast("decimal(18,2)")),
            "status": F.when(k % 53 == 0, "APPROVED").otherwise(F.col("status")),
        }
    )
    found = quality.domain_violations(risky, data.merchants(spark, sf), F.lit("2001-09-30").cast("date"))
    return found.groupBy("violation").agg(row_count().alias("rows"))


HALVES = ["event_type", "value", "user_id"]


@query(
    "q29_profile_comparison",
    "WITH a AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16'), b AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-16'), "
    f"ha AS ({histogram_sql(HALVES, 'a')}), hb AS ({histogram_sql(HALVES, 'b')}), pa AS ({PROFILE.replace('{h}', 'ha')}), pb AS ({PROFILE.replace('{h}', 'hb')}) "
    """SELECT pa.column_name, pa.total_rows, pa.null_pct, pa.unique_count, pa.mean_value, pb.total_rows AS other_total_rows, pb.null_pct AS other_null_pct,
       pb.unique_count AS other_unique_count, pb.mean_value AS other_mean_value, ROUND(pb.mean_value - pa.mean_value, 2) AS mean_gap
       FROM pa JOIN pb ON pa.column_name = pb.column_name""",
)
def q29(spark, sf):
    events = data.table(spark, sf, "events")
    early, late = F.col("ts") < wall_clock(data.EVENTS_HALF), F.col("ts") >= wall_clock(data.EVENTS_HALF)
    return quality.compare_profiles(events.where(early), events.where(late), HALVES)


def cumulative_sql(column, source):
    """Running counts of both halves over the values of a numeric column."""
    return f"""SELECT '{column}' AS column_name, v, SUM(a) OVER (ORDER BY v) AS ca, SUM(b) OVER (ORDER BY v) AS cb, SUM(a) OVER () AS na, SUM(b) OVER () AS nb,
        LEAD(v) OVER (ORDER BY v) AS nv FROM (SELECT CAST({column} AS DOUBLE) AS v, COUNT(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 END) AS a,
        COUNT(CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 1 END) AS b FROM {source} WHERE {column} IS NOT NULL GROUP BY 1)"""


@query(
    "q29b_distribution_distance",
    f"""SELECT column_name, CAST(na AS BIGINT) AS n_left, CAST(nb AS BIGINT) AS n_right, ROUND(MAX(ABS(ca / na - cb / nb)), 6) AS ks,
        ROUND(1.358 * SQRT((na + nb) / (CAST(na AS DOUBLE) * nb)), 6) AS ks_limit, ROUND(MAX(ABS(ca / na - cb / nb)), 6) > ROUND(1.358 * SQRT((na + nb) / (CAST(na AS DOUBLE) * nb)), 6) AS drifted,
        ROUND(SUM(ABS(ca / na - cb / nb) * (nv - v)), 4) AS earth_mover FROM ({cumulative_sql('value', 'events')} UNION ALL {cumulative_sql('user_id', 'events')}) GROUP BY column_name, na, nb""",
)
def q29b(spark, sf):
    """Numbers of the two halves: largest gap of the distributions and the area between them."""
    events = data.table(spark, sf, "events")
    early, late = F.col("ts") < wall_clock(data.EVENTS_HALF), F.col("ts") >= wall_clock(data.EVENTS_HALF)
    return distance.number_distances(events.where(early), events.where(late), ["value", "user_id"])


def label_sql(column):
    return f"""SELECT '{column}' AS column_name, CAST(COUNT(CASE WHEN k % 3 = 0 THEN 1 END) AS DOUBLE) AS a, CAST(COUNT(CASE WHEN k % 3 <> 0 THEN 1 END) AS DOUBLE) AS b
        FROM txn_dirty WHERE trim({column}) <> '' GROUP BY {column}"""


LABELS = ["status", "currency", "payment_method", "merchant_id"]


@query(
    "q29c_label_distance",
    with_views(
        "txn_dirty",
        """SELECT column_name, CAST(na AS BIGINT) AS n_left, CAST(nb AS BIGINT) AS n_right, COUNT(*) AS labels,
           ROUND(SUM((a / na - b / nb) * (a / na - b / nb) / (a / na + b / nb)) / 2, 6) AS chi_square, ROUND(SUM(ABS(a / na - b / nb)) / 2, 6) AS total_variation
           FROM (SELECT *, SUM(a) OVER (PARTITION BY column_name) AS na, SUM(b) OVER (PARTITION BY column_name) AS nb FROM counts) GROUP BY column_name, na, nb""",
        {"counts": " UNION ALL ".join(label_sql(c) for c in LABELS)},
    ),
)
def q29c(spark, sf):
    """Labels of a third of the rows, as a synthetic sample would be, against the rest."""
    rows = data.transactions_dirty(spark, sf)
    return distance.label_distances(rows.where("k % 3 = 0"), rows.where("k % 3 <> 0"), LABELS)


SKETCHED = ["event_type", "value", "user_id"]


@query(
    "q01b_sketch_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT(*) AS total_rows, COUNT(*) - COUNT({c}) AS null_count, COUNT(DISTINCT {c}) AS unique_count, TRUE AS distinct_within,
            {'TRUE' if c != 'event_type' else 'CAST(NULL AS BOOLEAN)'} AS median_within FROM events"""
        for c in SKETCHED
    ),
)
def q01b(spark, sf):
    """Profile merged from sketches of each day, and whether it is within its stated error of the exact figures."""
    path = scratch_path(spark, "sketches")
    events = data.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    sketches.store_days(events.where(F.col("ts") < wall_clock(data.EVENTS_HALF)), "day", SKETCHED, path)
    sketches.store_days(events.where(F.col("ts") >= wall_clock(data.EVENTS_HALF)), "day", SKETCHED, path)
    merged = sketches.merged_profile(sketches.stored_days(spark, path))
    exact = events.select([F.count_distinct(c).alias(c) for c in SKETCHED]).unpivot([], SKETCHED, "column_name", "unique_count")
    numbers = [c for c in SKETCHED if c != "event_type"]
    cells = events.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in numbers])))
    medians = merged.select("column_name", "median_estimate")
    ranks = cells.join(F.broadcast(medians), "column_name").groupBy("column_name").agg(
        (F.count(F.when(F.col("v") < F.col("median_estimate"), 1)) / F.count("v")).alias("lo"), (F.count(F.when(F.col("v") <= F.col("median_estimate"), 1)) / F.count("v")).alias("hi")
    )
    near = (F.col("lo") <= 0.5 + sketches.RANK_ERROR) & (F.col("hi") >= 0.5 - sketches.RANK_ERROR)
    error = F.abs(F.col("distinct_estimate") - F.col("unique_count")) / F.col("unique_count")
    return merged.join(exact, "column_name").join(ranks, "column_name", "left").select(
        "column_name", "total_rows", "null_count", "unique_count", (error <= 3 * sketches.DISTINCT_ERROR).alias("distinct_within"), near.alias("median_within")
    )


@query(
    "q01c_frequent_values",
    """SELECT column_name, value, n FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS r FROM
       (SELECT 'event_type' AS column_name, event_type AS value, COUNT(*) AS n FROM events GROUP BY 2)) WHERE r <= 5""",
)
def q01c(spark, sf):
    """Most frequent values from the days' lists; a column with few values has no cut-off, so its counts are exact."""
    path = scratch_path(spark, "heavy")
    events = data.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    sketches.store_days(events, "day", ["event_type"], path)
    return sketches.merged_heavy(sketches.stored_days(spark, path)).where("too_low = 0").drop("too_low")


@query(
    "q30_fix_impact",
    with_views(
        "txn_dirty txn_raw",
        """SELECT 'drop_missing_key' AS fix, COUNT(*) AS rows_before, COUNT(CASE WHEN trim(transaction_id) <> '' THEN 1 END) AS rows_after,
           COUNT(DISTINCT customer_id) AS customers_before, COUNT(DISTINCT CASE WHEN trim(transaction_id) <> '' THEN customer_id END) AS customers_after
           FROM txn_dirty
           UNION ALL SELECT 'only_clean_amounts', COUNT(*), COUNT(CASE WHEN TRY_CAST(trim(amount) AS DOUBLE) >= 0 THEN 1 END), COUNT(DISTINCT customer_id),
           COUNT(DISTINCT CASE WHEN TRY_CAST(trim(amount) AS DOUBLE) >= 0 THEN customer_id END) FROM txn_dirty""",
    ),
)
def q30(spark, sf):
    rows = data.transactions_dirty(spark, sf)
    fixes = {"drop_missing_key": ~is_blank(F.col("transaction_id")), "only_clean_amounts": numeric.to_number(the_amount()) >= 0}
    per = rows.groupBy("customer_id").agg(row_count().alias("n"), *[numeric.count_when(c).alias(f) for f, c in fixes.items()])
    wide = per.agg(
        F.sum("n").alias("rows"), F.count("customer_id").alias("customers"),
        *[F.sum(f).alias(f"r_{f}") for f in fixes], *[numeric.count_when(F.col(f) > 0).alias(f"c_{f}") for f in fixes],
    )
    lines = [
        F.struct(
            F.lit(f).alias("fix"), F.col("rows").alias("rows_before"), F.col(f"r_{f}").alias("rows_after"),
            F.col("customers").alias("customers_before"), F.col(f"c_{f}").alias("customers_after"),
        )
        for f in fixes
    ]
    return wide.select(F.inline(F.array(*lines)))


@query(
    "q31_verdict",
    with_views(
        "txn_dirty",
        r"""SELECT verdict, COUNT(*) AS rows FROM (SELECT CASE WHEN transaction_id IS NULL OR trim(transaction_id) = '' OR COALESCE(a < 0, TRUE)
           OR currency NOT IN ('INR','USD','EUR','GBP') OR COALESCE(d > DATE '2001-11-05', TRUE) THEN 'QUARANTINE'
           WHEN a > 500000 AND category IS NULL THEN 'FLAG' ELSE 'PASS' END AS verdict FROM
           (SELECT *, TRY_CAST(trim(amount) AS DOUBLE) * 10 AS a, CASE WHEN regexp_matches(transaction_date, '^\d{4}-\d{2}-\d{2}$') THEN TRY_CAST(transaction_date AS DATE) END AS d,
            CASE WHEN payment_method = 'UPI' THEN NULL ELSE 'retail' END AS category FROM txn_dirty)) GROUP BY 1""",
    ),
)
def q31(spark, sf):
    rows = data.transactions_dirty(spark, sf).withColumns(
        {
            "amount": numeric.to_number(the_amount()) * 10, "transaction_date": strict_date(F.col("transaction_date")),
            "category": F.when(F.col("payment_method") != "UPI", "retail"),
        }
    )
    judged = rows.withColumn("verdict", quality.verdict(data.as_of(), ["INR", "USD", "EUR", "GBP"]))
    return judged.groupBy("verdict").agg(row_count().alias("rows"))


@query(
    "q32_small_sample_guard",
    with_views(
        "txn",
        """SELECT merchant_id, transaction_date, failed, n, n >= 5 AS reliable, ROUND(GREATEST(((failed / n::DOUBLE) + 3.8416 / (2 * n)
           - 1.96 * SQRT((failed / n::DOUBLE) * (1 - failed / n::DOUBLE) / n + 3.8416 / (4.0 * n * n))) / (1 + 3.8416 / n), 0), 4) AS wilson_low
           FROM (SELECT merchant_id, transaction_date, COUNT(CASE WHEN status = 'FAILED' THEN 1 END) AS failed, COUNT(*) AS n FROM txn GROUP BY 1, 2)""",
    ),
)
def q32(spark, sf):
    rates = data.transactions(spark, sf).groupBy("merchant_id", "transaction_date").agg(numeric.count_when(is_failed()).alias("failed"), row_count().alias("n"))
    return quality.small_sample_guard(rates, "failed", "n", 5)


@query(
    "q33_blocked_customers",
    with_views(
        "txn",
        """SELECT threshold, COUNT(DISTINCT CASE WHEN amount > threshold THEN customer_id END) AS customers_blocked,
           COUNT(CASE WHEN amount > threshold THEN 1 END) AS transactions_blocked FROM txn, (VALUES (50000), (80000), (100000)) t(threshold)
           WHERE status = 'COMPLETED' GROUP BY 1""",
    ),
)
def q33(spark, sf):
    from paylens.operators.contracts import blocked_customers

    legitimate = data.transactions(spark, sf).where("status = 'COMPLETED'")
    return blocked_customers(legitimate, "customer_id", the_amount(), [50000, 80000, 100000])


CHECKS_SQL = [
    ("row_count", "COUNT(*)", "v > 0"),
    ("null_transaction_id", "COUNT(*) - COUNT(transaction_id)", "v = 0"),
    ("null_amount", "COUNT(*) - COUNT(amount)", "v = 0"),
    ("null_status", "COUNT(*) - COUNT(status)", "v = 0"),
    ("null_transaction_date", "COUNT(*) - COUNT(transaction_date)", "v = 0"),
    ("negative_amount", "COUNT(CASE WHEN amount < 0 THEN 1 END)", "v = 0"),
    ("duplicate_transaction_id", "COUNT(*) - COUNT(DISTINCT transaction_id)", "v = 0"),
    ("invalid_status", "COUNT(CASE WHEN status NOT IN ('COMPLETED','FAILED','PENDING') THEN 1 END)", "v = 0"),
    ("invalid_quality_flag", "COUNT(CASE WHEN quality_flag NOT IN ('CLEAN','UNMATCHED') THEN 1 END)", "v = 0"),
    ("mean_amount", "CAST(SUM(amount) AS DOUBLE) / COUNT(amount)", "v BETWEEN 100 AND 5000"),
]


@query(
    "q34_sql_check_list",
    with_views(
        "silver",
        " UNION ALL ".join(
            f"SELECT '{n}' AS check_name, CAST(v AS DOUBLE) AS value, CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT {e} AS v FROM silver)"
            for n, e, ok in CHECKS_SQL
        ),
    ),
)
def q34(spark, sf):
    from paylens.operators.contracts import silver_checks

    return silver_checks(data.silver(spark, sf))
