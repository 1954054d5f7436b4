"""Aggregations."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from paylens.functions.dates import hour_label, wall_clock
from paylens.functions.numeric import count_when, money, total
from paylens.operators import aggregates as agg
from paylens.operators import dedup, recovery
from paylens.operators.aggregates import row_count, the_amount
from paylens.queries import data
from paylens.queries.registry import query
from paylens.queries.sqlbase import AS_OF, N_COMPLETED, N_FAILED, REVENUE, with_views
from paylens.queries.sqlbase import pct as sql_pct

RATE = sql_pct(N_FAILED, "COUNT(*)")


@query("a01_totals", with_views("txn", f"SELECT COUNT(*) AS total_transactions, {N_FAILED} AS failed_count, {REVENUE} AS total_revenue FROM txn"))
def a01(spark, sf):
    return agg.totals(data.transactions(spark, sf))


MART = f"""
SELECT merchant_id, COUNT(transaction_id) AS total_transactions, {N_FAILED} AS failed_count,
       COUNT(DISTINCT customer_id) AS unique_customers, {REVENUE} AS total_revenue, {N_COMPLETED} AS nc
FROM txn WHERE status IN ('COMPLETED','FAILED') GROUP BY merchant_id"""


@query(
    "a02_merchant_mart",
    with_views(
        "txn dim_merchant",
        """SELECT d.merchant_id, merchant_name, category, city, total_transactions, failed_count,
           ROUND(CAST(failed_count AS DOUBLE) / total_transactions * 100, 4) AS failure_rate_pct, total_revenue,
           total_revenue / NULLIF(nc, 0) AS avg_transaction_value, unique_customers
           FROM agg JOIN dim_merchant d ON d.merchant_id = agg.merchant_id""",
        {"agg": MART},
    ),
)
def a02(spark, sf):
    return agg.merchant_mart(data.transactions(spark, sf), data.merchants(spark, sf))


@query(
    "a02b_merchant_mart_with_idle",
    with_views(
        "txn dim_merchant",
        """SELECT d.merchant_id, merchant_name, category, city,
           COALESCE(total_transactions, 0) AS total_transactions, COALESCE(failed_count, 0) AS failed_count,
           COALESCE(ROUND(CAST(failed_count AS DOUBLE) / total_transactions * 100, 4), 0) AS failure_rate_pct,
           COALESCE(total_revenue, 0) AS total_revenue,
           COALESCE(total_revenue / NULLIF(nc, 0), 0) AS avg_transaction_value,
           COALESCE(unique_customers, 0) AS unique_customers
           FROM dim_merchant d LEFT JOIN agg ON d.merchant_id = agg.merchant_id""",
        {"agg": MART},
    ),
)
def a02b(spark, sf):
    return agg.merchant_mart(data.transactions(spark, sf), data.merchants(spark, sf), keep_idle=True)


@query(
    "a03_merchant_performance",
    with_views(
        "silver",
        f"""SELECT merchant_id, COALESCE(MAX(merchant_name), '') AS merchant_name, COALESCE(MAX(category), '') AS category,
            COALESCE(MAX(city), '') AS city, {REVENUE} AS total_revenue, COUNT(*) AS txn_count,
            {RATE} AS failure_rate_pct FROM silver GROUP BY merchant_id""",
    ),
)
def a03(spark, sf):
    return agg.merchant_performance(data.valid_rows(data.bronze(spark, sf)), data.merchants(spark, sf))


@query(
    "a03b_merchant_performance_daily",
    with_views(
        "silver",
        f"""SELECT merchant_id, transaction_date, COALESCE(MAX(merchant_name), '') AS merchant_name,
            COALESCE(MAX(category), '') AS category, COALESCE(MAX(city), '') AS city, {REVENUE} AS total_revenue,
            COUNT(*) AS txn_count, {RATE} AS failure_rate_pct FROM silver GROUP BY merchant_id, transaction_date""",
    ),
)
def a03b(spark, sf):
    return agg.merchant_performance(data.valid_rows(data.bronze(spark, sf)), data.merchants(spark, sf), daily=True)


@query(
    "a04_daily_summary",
    with_views(
        "silver",
        f"""SELECT transaction_date AS report_date, {REVENUE} AS total_revenue, COUNT(*) AS total_txns,
            COUNT(DISTINCT customer_id) AS unique_customers, COUNT(DISTINCT merchant_id) AS unique_merchants,
            {RATE} AS failure_rate_pct FROM silver GROUP BY 1""",
    ),
)
def a04(spark, sf):
    return agg.daily_summary(data.valid_rows(data.bronze(spark, sf)))


@query(
    "a05_customer_ltv",
    with_views(
        "silver",
        f"""SELECT s.customer_id, {REVENUE} AS total_spent, COUNT(*) AS total_txns,
            {REVENUE} / NULLIF({N_COMPLETED}, 0) AS avg_txn_value,
            MIN(transaction_date) AS first_txn_date, MAX(transaction_date) AS last_txn_date,
            MAX(p.payment_method) AS preferred_payment_method
            FROM silver s JOIN pref p ON p.customer_id = s.customer_id GROUP BY s.customer_id""",
        {
            "pref": """SELECT customer_id, payment_method FROM (SELECT customer_id, payment_method,
              ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY COUNT(*) DESC, payment_method) AS rn
              FROM silver GROUP BY 1, 2) WHERE rn = 1"""
        },
    ),
)
def a05(spark, sf):
    return agg.customer_ltv(data.valid_rows(data.bronze(spark, sf)))


@query(
    "a06_revenue_ranking",
    with_views(
        "txn dim_merchant",
        f"""SELECT merchant_name, {REVENUE} AS revenue_usd FROM txn t JOIN dim_merchant m ON t.merchant_id = m.merchant_id
            GROUP BY merchant_name ORDER BY revenue_usd DESC, merchant_name LIMIT 5""",
    ),
)
def a06(spark, sf):
    return agg.revenue_ranking(data.transactions(spark, sf), data.merchants(spark, sf), 5)


@query(
    "a07_failure_rate_by_method",
    with_views(
        "txn",
        f"SELECT payment_method, COUNT(*) AS total, {N_FAILED} AS failed, {RATE} AS failure_rate_pct FROM txn GROUP BY 1",
    ),
)
def a07(spark, sf):
    return agg.failure_by(data.transactions(spark, sf), "payment_method")


@query(
    "a08_merchant_summary",
    with_views(
        "txn dim_merchant",
        f"""SELECT merchant_name, category, COUNT(transaction_id) AS total_txns, {N_COMPLETED} AS completed,
            {N_FAILED} AS failed, {RATE} AS failure_rate_pct, {REVENUE} AS revenue_usd
            FROM txn t JOIN dim_merchant m ON t.merchant_id = m.merchant_id GROUP BY 1, 2""",
    ),
)
def a08(spark, sf):
    return agg.merchant_summary(data.transactions(spark, sf), data.merchants(spark, sf))


@query(
    "a09_customer_spend",
    with_views(
        "txn dim_customer",
        """SELECT c.customer_id, customer_name, tier, CAST(SUM(amount) AS DOUBLE) AS lifetime_value,
           COUNT(transaction_id) AS total_orders FROM dim_customer c JOIN txn t ON c.customer_id = t.customer_id
           AND status = 'COMPLETED' GROUP BY ALL HAVING SUM(amount) > 1000""",
    ),
)
def a09(spark, sf):
    return agg.customer_spend(data.transactions(spark, sf), data.customers(spark, sf), 1000)


@query("a10_daily_gmv", with_views("gmv", "SELECT * FROM gmv"))
def a10(spark, sf):
    return agg.daily_gmv(data.staged(spark, sf), data.merchants(spark, sf))


@query(
    "a11_rolling_merchant",
    with_views(
        "gmv",
        f"""SELECT merchant_id, merchant_name, category, SUM(CAST(gmv AS DECIMAL(18,2)))::DOUBLE AS gmv_30d,
            CAST(SUM(transaction_count) AS BIGINT) AS transactions_30d,
            CAST(SUM(CAST(failure_rate_pct AS DECIMAL(18,2))) AS DOUBLE) / COUNT(failure_rate_pct) AS avg_failure_rate_pct, MAX(transaction_date) AS last_transaction_date,
            CASE WHEN SUM(CAST(gmv AS DECIMAL(18,2))) >= 1000000 THEN 'PLATINUM'
                 WHEN SUM(CAST(gmv AS DECIMAL(18,2))) >= 500000 THEN 'GOLD'
                 WHEN SUM(CAST(gmv AS DECIMAL(18,2))) >= 100000 THEN 'SILVER' ELSE 'BRONZE' END AS merchant_tier
            FROM gmv WHERE transaction_date >= {AS_OF} - INTERVAL 30 DAY GROUP BY 1, 2, 3""",
    ),
)
def a11(spark, sf):
    month = data.valid_rows(data.transactions(spark, sf, data.AS_OF_DAY - datetime.timedelta(days=30)), "staging")
    return agg.rolling_merchant(agg.daily_gmv(month, data.merchants(spark, sf)), data.as_of())


@query(
    "a12_daily_revenue",
    with_views(
        "gmv",
        """SELECT transaction_date, SUM(CAST(gmv AS DECIMAL(18,2)))::DOUBLE AS total_gmv,
           CAST(SUM(transaction_count) AS BIGINT) AS total_transactions, COUNT(DISTINCT merchant_id) AS active_merchants,
           SUM(CAST(failed_amount AS DECIMAL(18,2)))::DOUBLE AS total_failed,
           ROUND(CAST(SUM(CAST(failure_rate_pct AS DECIMAL(18,2))) AS DOUBLE) / COUNT(failure_rate_pct), 2) AS avg_failure_rate_pct FROM gmv GROUP BY 1""",
    ),
)
def a12(spark, sf):
    return agg.daily_revenue(agg.daily_gmv(data.staged(spark, sf), data.merchants(spark, sf)))


@query(
    "a13_headcount",
    with_views(
        "",
        f"""SELECT c_nationkey AS department_id, c_mktsegment AS work_location,
            CASE WHEN c_acctbal < 0 THEN 'CONTRACT' ELSE 'PERMANENT' END AS employment_type,
            CASE WHEN c_acctbal >= 6000 THEN 'G3' WHEN c_acctbal >= 2000 THEN 'G2' ELSE 'G1' END AS grade_band,
            COUNT(c_custkey) AS headcount, COUNT(last_day) AS active_count,
            ROUND(CAST(SUM(DATE_DIFF('day', first_day, {AS_OF})) AS DOUBLE) / COUNT(first_day), 4) AS avg_tenure_days,
            COUNT(CASE WHEN c_acctbal < 0 THEN 1 END) AS contractor_count
            FROM customer LEFT JOIN (SELECT o_custkey, MIN(o_orderdate)::DATE AS first_day, MAX(o_orderdate)::DATE AS last_day
               FROM orders GROUP BY 1) o ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4""",
    ),
)
def a13(spark, sf):
    from paylens.plans.staff import headcount, workforce

    return headcount(workforce(spark, sf), data.as_of())


@query(
    "a14_mode_per_key",
    with_views(
        "txn",
        """SELECT customer_id, payment_method, n FROM (SELECT customer_id, payment_method, COUNT(*) AS n,
           ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY COUNT(*) DESC, payment_method) AS rn
           FROM txn GROUP BY 1, 2) WHERE rn = 1""",
    ),
)
def a14(spark, sf):
    return agg.mode_per_key(data.transactions(spark, sf), ["customer_id"], "payment_method")


BEHAVIOUR = """
SELECT o.user_id, COUNT(o.event_id) AS total_orders, CAST(SUM(o.amount) AS DOUBLE) / COUNT(*) AS avg_order_value,
       MAX(o.ts) AS last_order_at, COUNT(DISTINCT o.outlet_id) AS unique_outlets,
       ROUND(AVG(EXTRACT(HOUR FROM o.ts)), 4) AS avg_order_hour,
       COUNT(CASE WHEN o.event_type = 'error' THEN 1 END) AS cancelled_orders,
       CAST(SUM(CASE WHEN o.event_type = 'signup' THEN o.amount ELSE 0 END) AS DOUBLE) AS total_discount, AVG(r.quality * 4 + 1) AS avg_rating_given
FROM (SELECT *, CAST(value AS DECIMAL(18,2)) AS amount, CAST(json_extract_string(props, '$.k') AS BIGINT) AS outlet_id
      FROM events) o LEFT JOIN labels r ON r.doc_id = o.event_id GROUP BY 1"""


PREFERRED = """SELECT user_id, event_type FROM (SELECT user_id, event_type, ROW_NUMBER() OVER
   (PARTITION BY user_id ORDER BY COUNT(*) DESC, event_type) AS rn FROM events GROUP BY 1, 2) WHERE rn = 1"""


@query(
    "a15_user_behaviour",
    with_views(
        "",
        """SELECT b.*, p.event_type AS preferred_type FROM b JOIN p ON p.user_id = b.user_id""",
        {
            "b": BEHAVIOUR,
            "p": PREFERRED,
        },
    ),
)
def a15(spark, sf):
    from paylens.plans.delivery import user_behaviour

    return user_behaviour(data.table(spark, sf, "events"), ratings(spark, sf))


def ratings(spark, sf):
    """The labels as ratings of the events of the same number."""
    return data.table(spark, sf, "labels").select(F.col("doc_id").alias("event_id"), (F.col("quality") * 4 + 1).alias("rating"))


@query(
    "a16_hourly_load",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour_utc, COUNT(*) AS tx_count,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS gmv, MIN(ts) AS first_loaded, MAX(ts) AS last_loaded
       FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 480 HOUR GROUP BY 1""",
)
def a16(spark, sf):
    return recovery.hourly_load(data.table(spark, sf, "events"), "ts", money(F.col("value")), data.EVENTS_AS_OF, 480)


@query(
    "a17_window_totals",
    with_views(
        "txn",
        """SELECT COUNT(*) AS rows_loaded, CAST(SUM(amount) AS DOUBLE) AS gmv_loaded FROM txn
           WHERE transaction_date >= DATE '1998-01-01' AND transaction_date <= DATE '1999-12-31'""",
    ),
)
def a17(spark, sf):
    return recovery.window_totals(data.transactions(spark, sf, datetime.date(1998, 1, 1)), "transaction_date", "1998-01-01", "1999-12-31")


GAP = """
SELECT user_id, CAST(SUM(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN amount ELSE 0 END) AS DOUBLE) / 15 * 15 AS expected,
       CAST(SUM(CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN amount ELSE 0 END) AS DOUBLE) AS loaded
FROM (SELECT user_id, ts, CAST(value AS DECIMAL(18,2)) AS amount FROM events) GROUP BY 1"""


@query(
    "a18_gmv_gap",
    f"""SELECT user_id AS merchant_id, ROUND(expected, 2) AS expected_gmv, loaded AS loaded_gmv,
        ROUND(expected - loaded, 2) AS missing_gmv FROM ({GAP})""",
)
def a18(spark, sf):
    return recovery.gmv_gap(*_halves(spark, sf), 15, 15)


def _halves(spark, sf):
    """Event history before and after the assumed start of a failure, as merchant rows."""
    events = data.table(spark, sf, "events").select(
        F.col("user_id").alias("merchant_id"), "ts", money(F.col("value")).alias("amount")
    )
    return events.where(F.col("ts") < wall_clock(data.EVENTS_HALF)), events.where(F.col("ts") >= wall_clock(data.EVENTS_HALF))


SLA = """SELECT c_custkey AS merchant_id, CASE WHEN c_acctbal >= 6000 THEN 100.0 WHEN c_acctbal >= 2000 THEN 200.0
   ELSE 400.0 END::DOUBLE AS threshold FROM customer"""


@query(
    "a19_sla_breach",
    f"""SELECT g.merchant_id, g.missing_gmv, s.threshold, TRUE AS notify FROM
        (SELECT user_id AS merchant_id, ROUND(expected - loaded, 2) AS missing_gmv FROM ({GAP})) g
        JOIN ({SLA}) s ON s.merchant_id = g.merchant_id WHERE g.missing_gmv > s.threshold""",
)
def a19(spark, sf):
    gap = recovery.gmv_gap(*_halves(spark, sf), 15, 15)
    return recovery.sla_breaches(gap, sla_contracts(spark, sf))


def sla_contracts(spark, sf):
    """One loss threshold per merchant, by contract tier."""
    bal = F.col("c_acctbal")
    return data.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("merchant_id"),
        F.when(bal >= 6000, 100.0).when(bal >= 2000, 200.0).otherwise(400.0).alias("threshold"),
    )


@query(
    "a20_duplicate_keys",
    with_views("txn_raw", "SELECT transaction_id, COUNT(*) AS copies FROM txn_raw GROUP BY 1 HAVING COUNT(*) > 1"),
)
def a20(spark, sf):
    return dedup.duplicate_keys(data.transactions_raw(spark, sf), ["transaction_id"])


@query(
    "a21_excess_rows",
    with_views(
        "txn_dirty",
        """SELECT COUNT(*) AS rows, COUNT(DISTINCT transaction_id) AS distinct_keys,
           COUNT(*) - COUNT(DISTINCT transaction_id) AS excess FROM txn_dirty""",
    ),
)
def a21(spark, sf):
    return dedup.excess_rows(data.transactions_dirty(spark, sf), ["transaction_id"])


NULL_COLS = ["transaction_id", "amount", "transaction_date", "currency", "merchant_id", "status"]


@query(
    "a22_null_fraction",
    with_views(
        "txn_dirty",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, ROUND(CAST(100 AS DOUBLE) * COUNT(CASE WHEN {c} IS NULL OR trim({c}) = ''
            THEN 1 END) / COUNT(*), 4) AS null_pct FROM txn_dirty"""
            for c in NULL_COLS
        ),
    ),
)
def a22(spark, sf):
    from paylens.operators.quality import null_fractions

    return null_fractions(data.transactions_dirty(spark, sf), NULL_COLS)


@query(
    "a23_growth_by_method",
    with_views(
        "txn",
        """SELECT payment_method, CAST(b AS DOUBLE) AS previous, CAST(n AS DOUBLE) AS current,
           COALESCE(ROUND(CAST(100 AS DOUBLE) * (CAST(n AS DOUBLE) - CAST(b AS DOUBLE)) / NULLIF(CAST(b AS DOUBLE), 0), 4), 0)
           AS growth_percentage FROM (SELECT payment_method,
           SUM(CASE WHEN transaction_date < DATE '2001-10-01' THEN amount ELSE 0 END) AS b,
           SUM(CASE WHEN transaction_date >= DATE '2001-10-01' THEN amount ELSE 0 END) AS n FROM txn
           WHERE transaction_date >= DATE '2001-09-01' AND transaction_date < DATE '2001-11-01' GROUP BY 1)""",
    ),
)
def a23(spark, sf):
    return agg.growth_by(data.transactions(spark, sf, datetime.date(2001, 9, 1)), "payment_method", F.lit("2001-10-20").cast("date"))


@query(
    "a24_top_failed_share",
    with_views(
        "txn dim_merchant",
        """SELECT m.merchant_id, m.merchant_name, status_count, transaction_count,
           ROUND(CAST(status_count AS DOUBLE) / transaction_count, 6) AS rate FROM (SELECT merchant_id,
           COUNT(CASE WHEN status = 'FAILED' THEN 1 END) AS status_count, COUNT(DISTINCT transaction_id) AS transaction_count
           FROM (SELECT DISTINCT transaction_id, status, merchant_id FROM txn_raw) GROUP BY 1) q
           JOIN dim_merchant m ON m.merchant_id = q.merchant_id ORDER BY rate DESC, m.merchant_id LIMIT 5""",
    ),
)
def a24(spark, sf):
    return agg.status_rate_top(data.transactions_raw(spark, sf), data.merchants(spark, sf), "FAILED", 5)


@query(
    "a25_rfm",
    with_views(
        "txn",
        f"""SELECT customer_id, CAST(DATE_DIFF('day', MAX(transaction_date), {AS_OF}) AS INTEGER) AS recency_days,
            COUNT(*) AS frequency, {REVENUE} AS monetary, DATE_DIFF('day', MAX(transaction_date), {AS_OF}) > 14 AS at_risk
            FROM txn GROUP BY 1""",
    ),
)
def a25(spark, sf):
    return agg.rfm(data.transactions(spark, sf), data.as_of())


@query(
    "a26_merchant_risk",
    with_views(
        "txn",
        f"""SELECT merchant_id, transaction_date, COUNT(*) AS txn_count, {RATE} AS failure_rate_pct,
            {RATE} > 30 AS suspicious, CASE WHEN COUNT(*) >= 30 THEN 'high' WHEN COUNT(*) >= 10 THEN 'medium' ELSE 'low' END
            AS confidence_level FROM txn GROUP BY 1, 2""",
    ),
)
def a26(spark, sf):
    return agg.merchant_risk(data.transactions(spark, sf))


@query(
    "a27_volume_anomalies",
    with_views(
        "txn",
        """SELECT merchant_id, COUNT(*) AS txn_count, CAST(SUM(amount) AS DOUBLE) / COUNT(*) AS avg_amount FROM txn
           GROUP BY 1 HAVING COUNT(*) > 40 AND CAST(SUM(amount) AS DOUBLE) / COUNT(*) < 53000""",
    ),
)
def a27(spark, sf):
    return agg.volume_anomalies(data.transactions(spark, sf), 40, 53000)


@query(
    "a27b_peer_deviation",
    with_views(
        "txn",
        """SELECT merchant_id, txn_count, avg_amount,
           ROUND((avg_amount - (SELECT AVG(avg_amount) FROM p)) / (SELECT STDDEV_SAMP(avg_amount) FROM p), 4) AS z FROM p""",
        {
            "p": """SELECT merchant_id, COUNT(*) AS txn_count, CAST(SUM(amount) AS DOUBLE) / COUNT(*) AS avg_amount
                    FROM txn GROUP BY 1"""
        },
    ),
)
def a27b(spark, sf):
    return agg.peer_deviation(data.transactions(spark, sf))


AUDIT = """SELECT conv_id, turn, text, CASE WHEN NOT regexp_matches(text, '^(?:[A-Z][a-z]+ )') THEN 'REJECTED'
   WHEN length(text) > 500 THEN 'SQL_ERROR' ELSE 'SUCCESS' END AS status FROM conversations"""


@query("a28_audit_status", f"SELECT status, COUNT(*) AS n FROM ({AUDIT}) GROUP BY 1")
def a28(spark, sf):
    text = F.col("text")
    log = data.table(spark, sf, "conversations").withColumn(
        "status",
        F.when(~text.rlike("^(?:[A-Z][a-z]+ )"), "REJECTED").when(F.length(text) > 500, "SQL_ERROR").otherwise("SUCCESS"),
    )
    return log.groupBy("status").agg(row_count().alias("n"))


@query(
    "a29_net_variance",
    with_views(
        "txn",
        """SELECT payment_method AS gateway, ROUND(CAST(SUM(amount) AS DOUBLE)
           - CAST(SUM(CAST(CASE WHEN k % 17 = 0 THEN amount + 2 WHEN k % 19 = 0 THEN amount + 0.5 ELSE amount END AS DECIMAL(18,2)))
             AS DOUBLE), 2) AS net_variance, COUNT(*) AS rows FROM txn WHERE k % 13 <> 0 GROUP BY 1""",
    ),
)
def a29(spark, sf):
    from paylens.queries.joins import reconciliation

    both = reconciliation(spark, sf).where(F.col("outcome").isin("matched", "disputed"))
    return both.groupBy("gateway").agg(
        F.round(total(F.col("ledger_amount")) - total(F.col("gateway_amount")), 2).alias("net_variance"),
        row_count().alias("rows"),
    )


@query(
    "a30_compliance_daily",
    with_views(
        "txn",
        """SELECT transaction_date, payment_method, COUNT(*) AS txn_count, CAST(SUM(amount) AS DOUBLE) AS total_amount,
           COUNT(CASE WHEN amount > 50000 THEN 1 END) AS review_count FROM txn GROUP BY 1, 2""",
    ),
)
def a30(spark, sf):
    return agg.compliance_daily(data.transactions(spark, sf))


@query(
    "a31_channel_roi",
    with_views(
        "txn",
        """SELECT channel, CAST(SUM(spend) AS DOUBLE) AS revenue, COUNT(DISTINCT customer_id) AS customers,
           ROUND(SUM(CAST(spend AS DOUBLE) * discount_pct / 100.0), 2) AS discount_cost,
           ROUND((CAST(SUM(spend) AS DOUBLE) - ROUND(SUM(CAST(spend AS DOUBLE) * discount_pct / 100.0), 2))
             / NULLIF(ROUND(SUM(CAST(spend AS DOUBLE) * discount_pct / 100.0), 2), 0), 4) AS roi
           FROM promo JOIN spend USING (customer_id) GROUP BY 1""",
        {
            "spend": "SELECT customer_id, SUM(amount) AS spend FROM txn WHERE status = 'COMPLETED' GROUP BY 1",
            "promo": """SELECT event_id, CAST(user_id AS VARCHAR) AS customer_id, CASE event_type WHEN 'click' THEN 'Email'
               WHEN 'view' THEN 'SMS' ELSE 'Push' END AS channel, CAST(json_extract_string(props, '$.k') AS DOUBLE) % 40 AS
               discount_pct FROM events WHERE event_type IN ('click', 'view', 'signup')""",
        },
    ),
)
def a31(spark, sf):
    return agg.attribution(data.transactions(spark, sf), promotions(spark, sf))


def promotions(spark, sf):
    kind = F.col("event_type")
    events = data.table(spark, sf, "events").where(kind.isin("click", "view", "signup"))
    return events.select(
        F.col("event_id").alias("promo_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.when(kind == "click", "Email").when(kind == "view", "SMS").otherwise("Push").alias("channel"),
        (F.get_json_object("props", "$.k").try_cast("double") % 40).alias("discount_pct"),
    )


EVAL = """SELECT doc_id, CASE WHEN toxic = 1 THEN 'QUARANTINE' WHEN quality = 1 THEN 'PASS' ELSE 'FLAG' END AS expected,
   CASE WHEN n_chars < 200 THEN 'QUARANTINE' WHEN n_chars > 6000 THEN 'FLAG' ELSE 'PASS' END AS decision,
   n_chars // 4 AS tokens, 500 + n_chars % 700 AS latency_ms FROM labels JOIN documents USING (doc_id)"""


@query(
    "a32_decision_eval",
    f"""SELECT expected, decision, COUNT(*) AS n, COUNT(CASE WHEN expected = decision THEN 1 END) AS correct,
        CAST(SUM(tokens) AS BIGINT) AS tokens, CAST(SUM(latency_ms) AS BIGINT) AS latency_ms FROM ({EVAL}) GROUP BY 1, 2""",
)
def a32(spark, sf):
    right = F.col("expected") == F.col("decision")
    return decisions(spark, sf).groupBy("expected", "decision").agg(
        row_count().alias("n"), count_when(right).alias("correct"), F.sum("tokens").alias("tokens"),
        F.sum("latency_ms").alias("latency_ms"),
    )


@query(
    "a32b_decision_accuracy",
    f"""SELECT COUNT(*) AS n, ROUND(AVG(CASE WHEN expected = decision THEN 1.0 ELSE 0.0 END), 4) AS accuracy,
        COUNT(CASE WHEN expected <> decision THEN 1 END) AS wrong FROM ({EVAL})""",
)
def a32b(spark, sf):
    right = F.col("expected") == F.col("decision")
    return decisions(spark, sf).agg(
        row_count().alias("n"), F.round(F.avg(F.when(right, 1.0).otherwise(0.0)), 4).alias("accuracy"),
        count_when(~right).alias("wrong"),
    )


@query(
    "a32c_wrong_decisions",
    f"SELECT doc_id, expected, decision, tokens, latency_ms FROM ({EVAL}) WHERE expected <> decision",
)
def a32c(spark, sf):
    """Every case that was decided wrongly, for review."""
    return decisions(spark, sf).where("expected <> decision").select(
        "doc_id", "expected", "decision", F.col("tokens").cast("long").alias("tokens"), F.col("latency_ms").cast("long").alias("latency_ms")
    )


def decisions(spark, sf):
    """Labelled documents with a rule's decision beside the expected one."""
    size = F.col("n_chars")
    return data.table(spark, sf, "labels").join(data.table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id").select(
        "doc_id",
        F.when(F.col("toxic") == 1, "QUARANTINE").when(F.col("quality") == 1, "PASS").otherwise("FLAG").alias("expected"),
        F.when(size < 200, "QUARANTINE").when(size > 6000, "FLAG").otherwise("PASS").alias("decision"),
        F.floor(size / 4).alias("tokens"),
        (500 + size % 700).alias("latency_ms"),
    )


@query("a33_span_counts", "SELECT role AS span_kind, COUNT(*) AS spans FROM conversations GROUP BY 1")
def a33(spark, sf):
    return data.table(spark, sf, "conversations").groupBy(F.col("role").alias("span_kind")).agg(row_count().alias("spans"))


@query(
    "a35_coverage_tier",
    """SELECT user_id, core_done, extra_done, CASE WHEN core_done = 3 AND extra_done = 2 THEN 'master'
       WHEN core_done = 3 THEN 'complete' WHEN core_done + extra_done > 0 THEN 'partial' ELSE 'missing' END AS tier
       FROM (SELECT user_id,
       MAX(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) + MAX(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)
       + MAX(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS core_done,
       MAX(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) + MAX(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)
       AS extra_done FROM events GROUP BY 1)""",
)
def a35(spark, sf):
    big = data.table(spark, sf, "events")
    return agg.coverage(big, "user_id", "event_type", ["click", "view", "purchase"], ["signup", "error"])


@query(
    "a36_golden_metrics",
    with_views(
        "silver",
        """SELECT COUNT(DISTINCT merchant_id) AS total_merchants, CAST(SUM(CAST(total_revenue AS DECIMAL(28,2))) AS DOUBLE) AS total_revenue,
           ROUND(CAST(SUM(CAST(failure_rate_pct AS DECIMAL(18,2))) AS DOUBLE) / COUNT(failure_rate_pct), 2) AS avg_failure_rate, MAX(failure_rate_pct) AS max_failure_rate,
           (SELECT merchant_name FROM perf ORDER BY failure_rate_pct DESC, merchant_name LIMIT 1) AS merchant_max_fail
           FROM perf""",
        {
            "perf": f"""SELECT merchant_id, COALESCE(MAX(merchant_name), '') AS merchant_name, {REVENUE} AS total_revenue,
                        {RATE} AS failure_rate_pct FROM silver GROUP BY 1"""
        },
    ),
)
def a36(spark, sf):
    gold = agg.merchant_performance(data.valid_rows(data.bronze(spark, sf)), data.merchants(spark, sf))
    return agg.golden_metrics(gold)


@query("a37_median_amount", with_views("txn", "SELECT CAST(MEDIAN(amount) AS DOUBLE) AS median FROM txn"))
def a37(spark, sf):
    return agg.exact_median(data.transactions(spark, sf), the_amount())


@query("a38_layer_counts", with_views("silver", "SELECT (SELECT COUNT(*) FROM txn_raw) AS bronze, (SELECT COUNT(*) FROM silver) AS silver"))
def a38(spark, sf):
    raw = data.transactions_raw(spark, sf).agg(row_count().alias("n"))
    clean = data.valid_rows(data.bronze(spark, sf)).agg(row_count().alias("silver"))
    return clean.select(raw.scalar().alias("bronze"), "silver")


@query(
    "a39_ingest_flag",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour_utc, COUNT(*) AS records,
       CASE WHEN COUNT(*) > 20 THEN 'SPIKE' WHEN COUNT(*) = 0 THEN 'ZERO' ELSE '' END AS flag FROM events GROUP BY 1""",
)
def a39(spark, sf):
    hours = data.table(spark, sf, "events").groupBy(hour_label(F.col("ts")).alias("hour_utc")).agg(row_count().alias("records"))
    return hours.withColumn("flag", recovery.ingest_flag(F.col("records"), 20))


@query(
    "a40_mean_ranking",
    with_views(
        "txn",
        """SELECT merchant_id, CAST(SUM(amount) AS DOUBLE) / COUNT(*) AS avg_amount,
           (SELECT CAST(SUM(amount) AS DOUBLE) FROM txn WHERE amount > 0) AS total_amount
           FROM txn WHERE amount > 0 GROUP BY 1""",
    ),
)
def a40(spark, sf):
    return agg.mean_ranking(data.transactions(spark, sf))
