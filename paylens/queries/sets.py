"""Set operations and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from paylens.functions.numeric import total
from paylens.operators import aggregates as agg
from paylens.operators import drift, quality, sets
from paylens.operators.aggregates import is_completed, row_count, the_amount
from paylens.queries import data
from paylens.queries.registry import query
from paylens.queries.sqlbase import REVENUE, with_views


@query(
    "t01_top_merchants",
    with_views(
        "txn",
        f"SELECT merchant_id, {REVENUE} AS revenue FROM txn GROUP BY 1 ORDER BY revenue DESC, merchant_id LIMIT 10",
    ),
)
def t01(spark, sf):
    per = data.transactions(spark, sf).groupBy("merchant_id").agg(agg.when_sum(is_completed(), the_amount()).alias("revenue"))
    return sets.top_n(per, [F.desc("revenue"), F.asc("merchant_id")], 10)


@query("t02_most_recent", "SELECT event_id, user_id, event_type, value, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 3")
def t02(spark, sf):
    events = data.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    return sets.top_n(events, [F.desc("ts"), F.desc("event_id")], 3)


TOP_COLUMNS = ["status", "currency", "payment_method", "merchant_id"]


@query(
    "t03_top_values_per_column",
    with_views(
        "txn_dirty",
        """SELECT column_name, value, n FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rn FROM ("""
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {c} AS value, COUNT(*) AS n FROM txn_dirty WHERE trim({c}) <> '' GROUP BY 2" for c in TOP_COLUMNS
        )
        + ")) WHERE rn <= 5",
    ),
)
def t03(spark, sf):
    return quality.top_values(data.transactions_dirty(spark, sf), TOP_COLUMNS, 5)


@query("t04_bounded_result", "SELECT COUNT(*) AS shown, TRUE AS truncated FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 100)")
def t04(spark, sf):
    shown, truncated = sets.bounded(data.table(spark, sf, "orders"), [F.asc("o_orderkey")], 100)
    return shown.agg(row_count().alias("shown")).select("shown", truncated.scalar().alias("truncated"))


@query(
    "t05_ordered_summary",
    with_views("txn", "SELECT transaction_date, COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS amount FROM txn GROUP BY 1 ORDER BY 1 DESC"),
)
def t05(spark, sf):
    per = data.transactions(spark, sf).groupBy("transaction_date").agg(row_count().alias("n"), total(the_amount()).alias("amount"))
    return per.orderBy(F.desc("transaction_date"))


@query(
    "u01_union_all",
    with_views(
        "txn txn_dirty",
        """SELECT feed, status, COUNT(*) AS rows, COUNT(currency) AS with_currency FROM (
           SELECT 'clean' AS feed, status, NULL AS currency FROM txn UNION ALL SELECT 'dirty', status, currency FROM txn_dirty)
           GROUP BY 1, 2""",
    ),
)
def u01(spark, sf):
    clean = data.transactions(spark, sf).select("transaction_id", "status")
    dirty = data.transactions_dirty(spark, sf).select("transaction_id", "status", "currency")
    both = sets.concat_feeds({"clean": clean, "dirty": dirty})
    return both.groupBy("feed", "status").agg(row_count().alias("rows"), F.count("currency").alias("with_currency"))


@query(
    "u02_schema_difference",
    """SELECT column_name, change, expected_type, actual_type, n AS rows_touched FROM (VALUES ('merchant_id','removed','string',''),
       ('merchant_nm','new','','string'), ('cust_ph','new','','string'), ('risk_score','new','','double'),
       ('amount','type_changed','decimal(18,2)','string')) t(column_name, change, expected_type, actual_type),
       (SELECT COUNT(*) AS c FROM lineitem JOIN orders ON l_orderkey = o_orderkey) q,
       LATERAL (SELECT CASE WHEN change = 'type_changed' THEN 0 ELSE c END AS n)""",
)
def u02(spark, sf):
    columns = ["transaction_id", "amount", "merchant_id", "status"]
    expected = data.transactions_raw(spark, sf).select(*columns).schema
    return drift.drift_report(drifted_feed(spark, sf), expected).drop("action", "severity")


def drifted_feed(spark, sf):
    """The raw feed after an upstream change: a rename, two new columns, amounts as text."""
    raw = data.transactions_raw(spark, sf)
    return raw.select(
        "transaction_id", F.col("amount").cast("string").alias("amount"), F.col("merchant_id").alias("merchant_nm"), "status",
        F.concat(F.lit("+919"), F.lpad("customer_id", 9, "0")).alias("cust_ph"),
        (F.col("l_discount") * 10).alias("risk_score"),
    )


DIFF_COLUMNS = ["status", "payment_method", "merchant_id", "currency"]


@query(
    "u03_value_difference",
    with_views(
        "txn txn_dirty",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, COALESCE(a.v, b.v) AS value, CASE WHEN b.v IS NULL THEN 'left_only' ELSE 'right_only' END AS side
            FROM (SELECT DISTINCT {e} AS v FROM txn) a FULL JOIN (SELECT DISTINCT {c} AS v FROM txn_dirty) b ON a.v = b.v
            WHERE (a.v IS NULL OR b.v IS NULL) AND COALESCE(a.v, b.v) IS NOT NULL"""
            for c, e in zip(DIFF_COLUMNS, ["status", "payment_method", "merchant_id", "'INR'"])
        ),
    ),
)
def u03(spark, sf):
    clean = data.transactions(spark, sf).withColumn("currency", F.lit("INR"))
    return sets.value_difference(clean, data.transactions_dirty(spark, sf), DIFF_COLUMNS)


@query(
    "u04_except_rows",
    with_views(
        "txn_raw txn",
        """SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, status FROM (SELECT transaction_id, amount, status FROM txn_raw
           EXCEPT ALL SELECT transaction_id, amount, status FROM txn)""",
    ),
)
def u04(spark, sf):
    gone = sets.rows_missing_from(data.transactions_raw(spark, sf), data.transactions(spark, sf), ["transaction_id", "amount", "status"])
    return gone.withColumn("amount", F.col("amount").cast("double"))


@query(
    "u05_distinct",
    with_views("txn_raw", "SELECT DISTINCT transaction_id, status, merchant_id FROM txn_raw"),
)
def u05(spark, sf):
    return data.transactions_raw(spark, sf).select("transaction_id", "status", "merchant_id").distinct()
