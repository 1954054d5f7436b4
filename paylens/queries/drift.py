"""Schema, value and distribution drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from paylens.functions.dates import wall_clock
from paylens.operators import drift
from paylens.operators.aggregates import row_count
from paylens.queries import data
from paylens.queries.registry import query
from paylens.queries.sets import drifted_feed
from paylens.queries.sqlbase import with_views

DOMAIN = ["status", "payment_method", "merchant_id", "currency"]
SIDES = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, a.v AS r, b.v AS u FROM (SELECT DISTINCT {e} AS v FROM txn) a
        FULL JOIN (SELECT DISTINCT {c} AS v FROM txn_dirty WHERE trim({c}) <> '') b ON a.v = b.v"""
    for c, e in zip(DOMAIN, ["status", "payment_method", "merchant_id", "'INR'"])
)
PER_COLUMN = f"""SELECT column_name, COUNT(r) AS reference_values, COUNT(u) AS current_values, COUNT(CASE WHEN u IS NULL THEN 1 END) AS only_reference,
   COUNT(CASE WHEN r IS NULL THEN 1 END) AS only_current, COUNT(CASE WHEN u IS NULL OR r IS NULL THEN 1 END) > 0 AS drifted FROM ({SIDES}) GROUP BY 1"""


def per_column(spark, sf):
    clean = data.transactions(spark, sf).withColumn("currency", F.lit("INR"))
    return drift.domain_drift(clean, data.transactions_dirty(spark, sf), DOMAIN)


@query("q21_domain_drift", with_views("txn txn_dirty", PER_COLUMN))
def q21(spark, sf):
    return per_column(spark, sf)


@query(
    "q21b_drift_share",
    with_views(
        "txn txn_dirty",
        f"""SELECT COUNT(*) AS columns_compared, COUNT(CASE WHEN drifted THEN 1 END) AS columns_drifted,
            ROUND(COUNT(CASE WHEN drifted THEN 1 END) / CAST(COUNT(*) AS DOUBLE), 2) AS drift_share, BOOL_OR(drifted) AS dataset_drifted FROM ({PER_COLUMN})""",
    ),
)
def q21b(spark, sf):
    return drift.drift_share(per_column(spark, sf))


def psi_sql(bin_expression):
    """Stability index of one column of events, before against after the middle of the month."""
    return f"""WITH e AS (SELECT *, ts < TIMESTAMP '2024-01-16' AS early FROM events), lim AS (SELECT MIN(value) AS lo, MAX(value) AS hi FROM e WHERE early),
    b AS (SELECT early, {bin_expression} AS bin, COUNT(*) AS n FROM e, lim GROUP BY 1, 2),
    s AS (SELECT bin, GREATEST(COALESCE(SUM(CASE WHEN early THEN n END), 0)::DOUBLE / (SELECT SUM(n) FROM b WHERE early), 0.0001) AS p,
      GREATEST(COALESCE(SUM(CASE WHEN NOT early THEN n END), 0)::DOUBLE / (SELECT SUM(n) FROM b WHERE NOT early), 0.0001) AS q FROM b GROUP BY 1)
    SELECT ROUND(SUM((q - p) * LN(q / p)), 6) AS psi, SUM((q - p) * LN(q / p)) > 0.2 AS drifted FROM s"""


def halves(spark, sf):
    events = data.table(spark, sf, "events")
    middle = wall_clock(data.EVENTS_HALF)
    return events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle)


@query("q22_stability_numeric", psi_sql("LEAST(GREATEST(FLOOR((value - lo) / (hi - lo) * 10), 0), 9)"))
def q22(spark, sf):
    return drift.stability_index(drift.binned_shares(*halves(spark, sf), "value"))


@query("q22b_stability_category", psi_sql("event_type"))
def q22b(spark, sf):
    return drift.stability_index(drift.category_shares(*halves(spark, sf), "event_type"))


@query(
    "q22d_stability_report",
    f"""SELECT *, COUNT(CASE WHEN drifted THEN 1 END) OVER () >= 0.5 * COUNT(*) OVER () AS dataset_drifted FROM (
        SELECT 'value' AS column_name, * FROM ({psi_sql("LEAST(GREATEST(FLOOR((value - lo) / (hi - lo) * 10), 0), 9)")})
        UNION ALL SELECT 'event_type', * FROM ({psi_sql("event_type")}) UNION ALL SELECT 'user_id', * FROM ({psi_sql("user_id")}))""",
)
def q22d(spark, sf):
    return drift.stability_report(*halves(spark, sf), ["value"], ["event_type", "user_id"])


@query(
    "q22c_largest_share_gap",
    """WITH s AS (SELECT user_id, COUNT(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 END)::DOUBLE / (SELECT COUNT(*) FROM events WHERE ts < TIMESTAMP '2024-01-16') AS p,
       COUNT(CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 1 END)::DOUBLE / (SELECT COUNT(*) FROM events WHERE ts >= TIMESTAMP '2024-01-16') AS q FROM events GROUP BY 1)
       SELECT COUNT(*) AS bins, ROUND(MAX(ABS(p - q)), 8) AS largest_gap FROM s""",
)
def q22c(spark, sf):
    shares = drift.category_shares(*halves(spark, sf), "user_id")
    return shares.agg(row_count().alias("bins"), F.round(F.max(F.abs(F.col("p") - F.col("q"))), 8).alias("largest_gap"))


FULL_COLUMNS = ["transaction_id", "amount", "merchant_id", "status"]


@query(
    "q23_drift_actions",
    """SELECT column_name, change, action, 'BREAKING' AS severity, n AS rows_touched FROM (VALUES ('merchant_id','removed','HALT'),
       ('merchant_nm','new','ADD_TO_SCHEMA'), ('cust_ph','new','ADD_TO_SCHEMA'), ('risk_score','new','FLAG_ANOMALY'),
       ('amount','type_changed','FLAG_ANOMALY')) t(column_name, change, action),
       (SELECT COUNT(*) AS c FROM lineitem JOIN orders ON l_orderkey = o_orderkey) q,
       LATERAL (SELECT CASE WHEN change = 'type_changed' THEN 0 ELSE c END AS n)""",
)
def q23(spark, sf):
    expected = data.transactions_raw(spark, sf).select(*FULL_COLUMNS).schema
    return drift.drift_report(drifted_feed(spark, sf), expected).drop("expected_type", "actual_type")


@query(
    "q24_apply_evolution",
    with_views(
        "txn_raw",
        """SELECT status, COUNT(*) AS rows, CAST(SUM(amount) AS DOUBLE) AS amount, CAST(0 AS BIGINT) AS merchants, COUNT(*) AS phones,
           CAST(0 AS BIGINT) AS bad_amounts, COUNT(*) AS flagged_scores FROM txn_raw GROUP BY 1""",
    ),
)
def q24(spark, sf):
    expected = data.transactions_raw(spark, sf).select(*FULL_COLUMNS).schema
    healed = drift.evolve(drifted_feed(spark, sf), expected)
    return healed.groupBy("status").agg(
        row_count().alias("rows"), F.sum("amount").cast("double").alias("amount"), F.count("merchant_id").alias("merchants"),
        F.count("cust_ph").alias("phones"), F.count_if(F.col("amount_anomaly")).alias("bad_amounts"),
        F.count_if(F.col("risk_score_anomaly")).alias("flagged_scores"),
    )


@query(
    "q25_silent_column_loss",
    with_views(
        "txn",
        """SELECT 'upi_payments' AS metric, COUNT(CASE WHEN payment_method = 'UPI' THEN 1 END) AS rows_before, CAST(0 AS BIGINT) AS rows_after, TRUE AS broken FROM txn
        UNION ALL SELECT 'failed', COUNT(CASE WHEN status = 'FAILED' THEN 1 END), COUNT(CASE WHEN status = 'FAILED' THEN 1 END), FALSE FROM txn
        UNION ALL SELECT 'customers', COUNT(customer_id), CAST(0 AS BIGINT), TRUE FROM txn""",
    ),
)
def q25(spark, sf):
    v2 = data.transactions(spark, sf).select("transaction_id", "amount", "status", "merchant_id", "customer_id", "payment_method")
    v3 = v2.drop("payment_method").withColumnRenamed("customer_id", "user_id")
    metrics = {
        "upi_payments": F.col("payment_method") == "UPI", "failed": F.col("status") == "FAILED", "customers": F.col("customer_id").isNotNull()
    }
    return drift.lost_predicates(v2, v3, metrics)
