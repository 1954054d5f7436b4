"""Projections, filters, predicates."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from paylens.functions import numeric
from paylens.functions.dates import wall_clock
from paylens.functions.text import is_blank
from paylens.operators import aggregates as agg
from paylens.operators.aggregates import is_completed, row_count, the_amount
from paylens.operators.privacy import guard_status
from paylens.plans import delivery, payments
from paylens.plans.medallion import is_valid, valid_rows
from paylens.queries import data
from paylens.queries.aggregates import BEHAVIOUR, PREFERRED, ratings
from paylens.queries.registry import query
from paylens.queries.sqlbase import AS_OF, REVENUE, with_views

PER_STATUS = "COUNT(*) AS rows, CAST(SUM(k) AS BIGINT) AS key_sum"


def per(df, *keys):
    return df.groupBy(*keys).agg(row_count().alias("rows"), F.sum("k").alias("key_sum"))


@query(
    "f01_null_key_filter",
    with_views("txn_dirty", f"SELECT status, {PER_STATUS} FROM txn_dirty WHERE transaction_id IS NOT NULL AND trim(transaction_id) <> '' GROUP BY 1"),
)
def f01(spark, sf):
    return per(data.transactions_dirty(spark, sf).where(~is_blank(F.col("transaction_id"))), "status")


MODES = [("silver", ">="), ("staging", ">"), ("replay", ">")]


@query(
    "f02_amount_validity",
    with_views(
        "txn_dirty",
        " UNION ALL ".join(
            f"""SELECT '{m}' AS mode, {PER_STATUS} FROM txn_dirty WHERE trim(transaction_id) <> ''
                AND TRY_CAST(trim(amount) AS DECIMAL(18,2)) {op} 0"""
            for m, op in MODES
        ),
    ),
)
def f02(spark, sf):
    """All three variants in one pass: each is a condition on the row."""
    typed = data.transactions_dirty(spark, sf).withColumn("amount", numeric.to_amount(the_amount()))
    counts = [x for i, (mode, _) in enumerate(MODES) for x in (numeric.count_when(is_valid(mode)).alias(f"n{i}"), F.sum(F.when(is_valid(mode), F.col("k"))).alias(f"k{i}"))]
    lines = [F.struct(F.lit(mode).alias("mode"), F.col(f"n{i}").alias("rows"), F.col(f"k{i}").alias("key_sum")) for i, (mode, _) in enumerate(MODES)]
    return typed.agg(*counts).select(F.inline(F.array(*lines)))


TESTED = """SELECT k, CASE WHEN k % 47 = 0 THEN 'TEST_' || merchant_id ELSE merchant_id END AS merchant_id FROM txn"""


@query(
    "f03_test_merchants",
    with_views("txn", f"SELECT merchant_id, {PER_STATUS} FROM ({TESTED}) WHERE merchant_id NOT LIKE 'TEST_%' GROUP BY 1"),
)
def f03(spark, sf):
    tagged = data.transactions(spark, sf).withColumn(
        "merchant_id", F.when(F.col("k") % 47 == 0, F.concat(F.lit("TEST_"), "merchant_id")).otherwise(F.col("merchant_id"))
    )
    return per(payments.without_test_merchants(tagged), "merchant_id")


@query("f04_status_in", with_views("txn", f"SELECT status, {PER_STATUS} FROM txn WHERE status IN ('COMPLETED','FAILED') GROUP BY 1"))
def f04(spark, sf):
    return per(data.transactions(spark, sf).where(F.col("status").isin("COMPLETED", "FAILED")), "status")


@query("f05_after_cutoff", with_views("txn", f"SELECT status, {PER_STATUS} FROM txn WHERE transaction_date > DATE '1998-06-15' GROUP BY 1"))
def f05(spark, sf):
    return per(data.transactions(spark, sf, datetime.date(1998, 6, 16)), "status")


@query(
    "f06_date_range",
    with_views("txn", f"SELECT status, {PER_STATUS} FROM txn WHERE transaction_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' GROUP BY 1"),
)
def f06(spark, sf):
    lo, hi = F.lit("1997-01-01").cast("date"), F.lit("1997-12-31").cast("date")
    return per(data.transactions(spark, sf, lo).where(F.col("transaction_date").between(lo, hi)), "status")


@query(
    "f07_rolling_window",
    with_views("txn", f"SELECT status, {PER_STATUS} FROM txn WHERE transaction_date >= {AS_OF} - INTERVAL 30 DAY GROUP BY 1"),
)
def f07(spark, sf):
    return per(data.transactions(spark, sf, data.AS_OF_DAY - datetime.timedelta(days=30)), "status")


@query(
    "f08_active_only",
    """SELECT c_mktsegment, COUNT(*) AS active FROM customer WHERE c_custkey IN
       (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01') GROUP BY 1""",
)
def f08(spark, sf):
    recent = data.table(spark, sf, "orders").where(F.col("o_orderdate") >= wall_clock("2001-01-01"))
    seen = recent.select(F.col("o_custkey").alias("c_custkey"))
    active = data.table(spark, sf, "customer").join(seen, "c_custkey", "left_semi")
    return active.groupBy("c_mktsegment").agg(row_count().alias("active"))


@query(
    "f09_staging_projection",
    """SELECT event_id, user_id AS customer_id, event_type, ts AS event_timestamp, TIMESTAMP '2024-01-31 02:00:00' AS _loaded_at
       FROM events WHERE event_id IS NOT NULL""",
)
def f09(spark, sf):
    raw = data.table(spark, sf, "events").withColumnsRenamed({"user_id": "customer_id", "ts": "event_timestamp"})
    stamp = wall_clock("2024-01-31 02:00:00")
    return payments.stage(raw, ["event_id", "customer_id", "event_type", "event_timestamp"], "event_id", stamp)


@query(
    "f10_without_personal_columns",
    """SELECT c_custkey AS customer_id, CASE WHEN c_acctbal >= 6000 THEN 'GOLD' WHEN c_acctbal >= 2000 THEN 'SILVER' ELSE 'BRONZE' END
       AS tier, CAST(date_trunc('month', d) AS DATE) AS birth_month, CAST(DATE_DIFF('year', d, DATE '2001-11-05') AS INTEGER) AS age_years,
       sha256(c_name) AS name_hash FROM customer JOIN (SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS d FROM orders GROUP BY 1)
       ON o_custkey = c_custkey""",
)
def f10(spark, sf):
    first = data.table(spark, sf, "orders").groupBy(F.col("o_custkey").cast("string").alias("customer_id")).agg(
        F.min("o_orderdate").cast("date").alias("date_of_birth")
    )
    people = data.customers(spark, sf).join(first, "customer_id").withColumn("is_active", F.lit(True))
    return payments.customer_dimension(people, data.as_of()).withColumn("customer_id", F.col("customer_id").cast("long"))


@query(
    "f10b_user_dimension",
    f"""WITH b AS ({BEHAVIOUR}), p AS ({PREFERRED}), seen AS (SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS d FROM orders GROUP BY 1)
        SELECT c_custkey AS user_id, CAST(DATE_DIFF('day', d, {AS_OF}) AS INTEGER) AS account_age_days, CAST(DATE_DIFF('year', d, {AS_OF}) AS INTEGER) AS age_approx,
        total_orders, avg_order_value, avg_order_hour, cancelled_orders, event_type AS most_used, sha256(c_name) AS email_hash
        FROM customer LEFT JOIN seen ON o_custkey = c_custkey LEFT JOIN b ON b.user_id = c_custkey LEFT JOIN p ON p.user_id = c_custkey""",
)
def f10b(spark, sf):
    first = data.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(F.min("o_orderdate").cast("date").alias("signup_date"))
    people = data.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("customer_name"))
    behaviour = delivery.user_behaviour(data.table(spark, sf, "events"), ratings(spark, sf))
    return delivery.users(people, behaviour, first, data.as_of())


@query(
    "f11_typed_projection",
    with_views(
        "txn_dirty",
        """SELECT COUNT(*) AS rows, COUNT(TRY_CAST(trim(amount) AS DECIMAL(18,2))) AS amounts,
           COUNT(CASE WHEN regexp_matches(transaction_date, '^\\d{4}-\\d{2}-\\d{2}$') THEN TRY_CAST(transaction_date AS DATE) END) AS dates,
           CAST(SUM(TRY_CAST(trim(amount) AS DECIMAL(18,2))) AS DOUBLE) AS amount_sum FROM txn_dirty""",
    ),
)
def f11(spark, sf):
    from paylens.functions.dates import strict_date

    typed = data.transactions_dirty(spark, sf).select(
        numeric.to_amount(the_amount()).alias("amount"), strict_date(F.col("transaction_date")).alias("day")
    )
    return typed.agg(
        row_count().alias("rows"), F.count("amount").alias("amounts"), F.count("day").alias("dates"), numeric.total(the_amount()).alias("amount_sum")
    )


@query(
    "f12_lower_case",
    with_views(
        "txn", f"SELECT lower(status) AS status, lower(payment_method) AS payment_method, {PER_STATUS} FROM txn GROUP BY 1, 2"
    ),
)
def f12(spark, sf):
    lowered = data.transactions(spark, sf).withColumns({c: F.lower(c) for c in ("status", "payment_method")})
    return per(lowered, "status", "payment_method")


@query("f13_quality_flag", with_views("silver", f"SELECT quality_flag, {PER_STATUS} FROM silver GROUP BY 1"))
def f13(spark, sf):
    return per(data.silver(spark, sf), "quality_flag")


@query(
    "f14_merchant_tier",
    with_views(
        "txn",
        f"""SELECT merchant_id, {REVENUE} AS revenue, CASE WHEN {REVENUE} >= 1000000 THEN 'PLATINUM' WHEN {REVENUE} >= 500000 THEN 'GOLD'
            WHEN {REVENUE} >= 100000 THEN 'SILVER' ELSE 'BRONZE' END AS tier FROM txn WHERE transaction_date >= DATE '2001-08-01' GROUP BY 1""",
    ),
)
def f14(spark, sf):
    recent = data.transactions(spark, sf, datetime.date(2001, 8, 1))
    revenue = recent.groupBy("merchant_id").agg(numeric.when_sum(is_completed(), the_amount()).alias("revenue"))
    return revenue.withColumn("tier", numeric.merchant_tier(F.col("revenue")))


@query(
    "f15_customer_segment",
    with_views(
        "txn",
        f"""SELECT customer_id, s AS total_spent, n AS txn_frequency, CASE WHEN s > 5000 THEN 'VIP' WHEN s >= 1000 THEN 'High'
            WHEN s >= 200 THEN 'Mid' ELSE 'Low' END AS segment, {AS_OF} AS segment_updated_date FROM (SELECT customer_id,
            CAST(SUM(amount) AS DOUBLE) AS s, COUNT(*) AS n FROM txn WHERE status = 'COMPLETED'
            AND transaction_date > {AS_OF} - INTERVAL 30 DAY GROUP BY 1)""",
    ),
)
def f15(spark, sf):
    return agg.segments(data.transactions(spark, sf, data.AS_OF_DAY - datetime.timedelta(days=29)), data.as_of())


@query(
    "f16_compliance_flag",
    with_views(
        "txn",
        f"SELECT CASE WHEN amount > 50000 THEN 'requires_review' ELSE 'ok' END AS compliance_flag, {PER_STATUS} FROM txn GROUP BY 1",
    ),
)
def f16(spark, sf):
    return per(data.transactions(spark, sf).withColumn("compliance_flag", numeric.compliance_flag(the_amount())), "compliance_flag")


@query(
    "f17_fee_lookup",
    with_views(
        "txn",
        f"""SELECT payment_method, COUNT(*) AS txn_volume, {REVENUE} AS gross_revenue, ROUND({REVENUE} * rate, 2) AS fees,
            ROUND({REVENUE} * (1 - rate), 2) AS effective_revenue FROM txn JOIN (VALUES ('CREDIT_CARD', 0.02::DOUBLE),
            ('DEBIT_CARD', 0.015::DOUBLE), ('UPI', 0.0::DOUBLE)) f(m, rate) ON m = payment_method GROUP BY payment_method, rate""",
    ),
)
def f17(spark, sf):
    return agg.fee_analysis(data.transactions(spark, sf))


@query(
    "f18_defaults_and_safe_division",
    """SELECT c_custkey, COALESCE(n, 0) AS finished, COALESCE(total / NULLIF(n, 0), 0) AS avg_order FROM customer LEFT JOIN
       (SELECT o_custkey, COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n,
        CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS total
        FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def f18(spark, sf):
    done = F.col("o_orderstatus") == "F"
    spend = data.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        numeric.count_when(done).alias("n"), numeric.when_sum(done, numeric.money(F.col("o_totalprice"))).alias("total")
    )
    return data.table(spark, sf, "customer").select("c_custkey").join(spend, "c_custkey", "left").select(
        "c_custkey",
        F.coalesce("n", F.lit(0)).alias("finished"),
        F.coalesce(numeric.ratio(F.col("total"), F.col("n")), F.lit(0.0)).alias("avg_order"),
    )


# A statement per event, as a query log would hold it.
STATEMENT = """CASE event_type WHEN 'click' THEN 'SELECT * FROM fact_transactions WHERE k = ' || event_id
   WHEN 'view' THEN 'select count(*) from dim_merchant' WHEN 'error' THEN 'DROP TABLE fact_transactions'
   WHEN 'signup' THEN 'SELECT 1; DELETE FROM fact_transactions WHERE k = ' || event_id ELSE 'SELECT name FROM unknown_things WHERE id = ' || event_id END"""


def query_log(spark, sf):
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    statement = (
        F.when(kind == "click", F.concat(F.lit("SELECT * FROM fact_transactions WHERE k = "), number))
        .when(kind == "view", F.lit("select count(*) from dim_merchant"))
        .when(kind == "error", F.lit("DROP TABLE fact_transactions"))
        .when(kind == "signup", F.concat(F.lit("SELECT 1; DELETE FROM fact_transactions WHERE k = "), number))
        .otherwise(F.concat(F.lit("SELECT name FROM unknown_things WHERE id = "), number))
    )
    return data.table(spark, sf, "events").select("event_id", "user_id", "ts", statement.alias("sql_text"))


@query(
    "f19_query_audit",
    f"""SELECT status, COUNT(*) AS n FROM (SELECT CASE WHEN NOT starts_with(s, 'SELECT') THEN 'not_select'
        WHEN regexp_matches(s, '(^|[^A-Z0-9_])(DROP|DELETE|INSERT|UPDATE|TRUNCATE|ALTER|CREATE)($|[^A-Z0-9_])') THEN 'forbidden_keyword'
        WHEN NOT (contains(s, 'FACT_TRANSACTIONS') OR contains(s, 'DIM_MERCHANT')) THEN 'unknown_table'
        WHEN NOT contains(s, ' WHERE ') THEN 'full_scan' ELSE 'ok' END AS status
        FROM (SELECT upper(trim({STATEMENT})) AS s FROM events)) GROUP BY 1""",
)
def f19(spark, sf):
    log = query_log(spark, sf).withColumn("status", guard_status(F.col("sql_text"), ["fact_transactions", "dim_merchant"]))
    return log.groupBy("status").agg(row_count().alias("n"))
