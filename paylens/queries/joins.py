"""Joins."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from paylens.functions.dates import hour_label, wall_clock
from paylens.functions.numeric import count_when, total
from paylens.operators import aggregates as agg
from paylens.operators import joins
from paylens.operators.aggregates import is_completed, is_failed, row_count, the_amount
from paylens.plans import delivery, staff
from paylens.queries import data
from paylens.queries.registry import query
from paylens.queries.sqlbase import AS_OF, N_FAILED, REVENUE, with_views
from paylens.queries.sqlbase import pct as sql_pct

SHOWN = "transaction_id, CAST(amount AS DOUBLE) AS amount, status, merchant_id, customer_id, transaction_date"


@query("j01_enrich_left", with_views("silver", f"SELECT {SHOWN}, merchant_name, category, city, quality_flag FROM silver"))
def j01(spark, sf):
    return data.silver(spark, sf).select(
        "transaction_id", the_amount().cast("double").alias("amount"), "status", "merchant_id", "customer_id",
        "transaction_date", "merchant_name", "category", "city", "quality_flag",
    )


@query(
    "j02_inner_fact_dim",
    with_views(
        "bronze dim_merchant",
        f"""SELECT category, city, COUNT(*) AS txn_count, {REVENUE} AS revenue FROM bronze b
            JOIN dim_merchant m ON b.merchant_id = m.merchant_id GROUP BY 1, 2""",
    ),
)
def j02(spark, sf):
    per = data.bronze(spark, sf).groupBy("merchant_id").agg(
        row_count().alias("n"), F.sum(F.when(is_completed(), the_amount()).otherwise(F.lit(0).cast("decimal(18,2)"))).alias("r")
    )
    joined = per.join(data.merchants(spark, sf), "merchant_id")
    return joined.groupBy("category", "city").agg(F.sum("n").alias("txn_count"), total(F.col("r")).alias("revenue"))


@query(
    "j03_three_tables",
    with_views(
        "txn dim_merchant dim_customer",
        """SELECT c.tier, m.category, COUNT(*) AS txn_count, CAST(SUM(t.amount) AS DOUBLE) AS amount
           FROM dim_customer c, txn t, dim_merchant m WHERE c.customer_id = t.customer_id
           AND t.merchant_id = m.merchant_id AND m.category = 'Food Delivery' GROUP BY 1, 2""",
    ),
)
def j03(spark, sf):
    food = data.merchants(spark, sf).where("category = 'Food Delivery'").select("merchant_id", "category")
    per = data.transactions(spark, sf).join(food, "merchant_id").groupBy("customer_id", "category").agg(
        row_count().alias("n"), F.sum(the_amount()).alias("s")
    )
    return per.join(data.customers(spark, sf).select("customer_id", "tier"), "customer_id").groupBy("tier", "category").agg(
        F.sum("n").alias("txn_count"), total(F.col("s")).alias("amount")
    )


@query(
    "j03b_revenue_after_date",
    with_views(
        "txn dim_merchant",
        """SELECT m.merchant_name, CAST(SUM(t.amount) AS DOUBLE) AS total_revenue, COUNT(*) AS txn_count
           FROM txn t, dim_merchant m WHERE t.merchant_id = m.merchant_id AND t.transaction_date > DATE '1999-01-01'
           GROUP BY 1 ORDER BY total_revenue DESC, merchant_name LIMIT 10""",
    ),
)
def j03b(spark, sf):
    recent = data.transactions(spark, sf, datetime.date(1999, 1, 2))
    per = recent.groupBy("merchant_id").agg(total(the_amount()).alias("total_revenue"), row_count().alias("txn_count"))
    named = per.join(data.merchants(spark, sf), "merchant_id").select("merchant_name", "total_revenue", "txn_count")
    return named.orderBy(F.desc("total_revenue"), "merchant_name").limit(10)


@query(
    "j04_dim_with_four_aggregates",
    with_views(
        "txn dim_merchant",
        """SELECT d.merchant_id, COALESCE(r.v, 0) AS revenue, COALESCE(n.v, 0) AS total_transactions,
           COALESCE(c.v, 0) AS unique_customers, COALESCE(a.v, 0) AS avg_value FROM dim_merchant d
           LEFT JOIN (SELECT merchant_id, CAST(SUM(amount) AS DOUBLE) AS v FROM txn WHERE status = 'COMPLETED' GROUP BY 1) r
             ON r.merchant_id = d.merchant_id
           LEFT JOIN (SELECT merchant_id, COUNT(*) AS v FROM txn GROUP BY 1) n ON n.merchant_id = d.merchant_id
           LEFT JOIN (SELECT merchant_id, COUNT(DISTINCT customer_id) AS v FROM txn GROUP BY 1) c ON c.merchant_id = d.merchant_id
           LEFT JOIN (SELECT merchant_id, CAST(SUM(amount) AS DOUBLE) / COUNT(*) AS v FROM txn WHERE status = 'COMPLETED'
             GROUP BY 1) a ON a.merchant_id = d.merchant_id""",
    ),
)
def j04(spark, sf):
    per = data.transactions(spark, sf).groupBy("merchant_id").agg(
        agg.when_sum(is_completed(), the_amount()).alias("revenue"),
        row_count().alias("total_transactions"),
        F.count_distinct("customer_id").alias("unique_customers"),
        agg.mean_of(agg.when_sum(is_completed(), the_amount()), count_when(is_completed())).alias("avg_value"),
    )
    joined = data.merchants(spark, sf).select("merchant_id").join(per, "merchant_id", "left")
    return joined.fillna(0, ["total_transactions", "unique_customers"]).fillna(0.0, ["revenue", "avg_value"])


@query(
    "j05_fact_with_two_dims",
    with_views(
        "bronze dim_merchant dim_customer",
        f"""SELECT t.transaction_id, t.transaction_date, t.customer_id, c.tier AS customer_tier, t.merchant_id,
            m.merchant_name, m.category, CAST(t.amount AS DOUBLE) AS amount, t.status,
            CAST(CASE WHEN t.status = 'COMPLETED' THEN t.amount ELSE 0 END AS DOUBLE) AS gmv_contribution
            FROM bronze t LEFT JOIN dim_customer c ON t.customer_id = c.customer_id
            LEFT JOIN dim_merchant m ON t.merchant_id = m.merchant_id""",
    ),
)
def j05(spark, sf):
    from paylens.plans.payments import fact_transactions

    return fact_transactions(data.bronze(spark, sf), data.customers(spark, sf), data.merchants(spark, sf)).drop("_loaded_at")


@query(
    "j06_deliveries_inner_left",
    """SELECT l.l_orderkey AS order_id, l.l_linenumber AS line, CAST(o.o_orderdate AS DATE) AS order_date,
       o.o_custkey AS user_id, p.p_type AS cuisine_type, l.l_extendedprice AS final_amount,
       DATE_DIFF('minute', o.o_orderdate, l.l_shipdate) AS fulfilment_mins, o.o_orderstatus AS order_status,
       COALESCE(r.quality, 0) AS food_rating FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
       JOIN part p ON p.p_partkey = l.l_partkey LEFT JOIN labels r ON r.doc_id = l.l_orderkey""",
)
def j06(spark, sf):
    return delivery.deliveries(spark, sf).withColumn("final_amount", F.col("final_amount").cast("double"))


@query(
    "j06b_payroll_ledger",
    """SELECT o_custkey AS emp_id, o_orderkey AS payroll_id, strftime(o_orderdate, '%Y-%m') AS payroll_month,
       o_totalprice AS gross_earnings, CASE WHEN o_orderstatus = 'F' THEN 'PAID' ELSE 'PENDING' END AS payment_status,
       c_nationkey AS department_id, c_mktsegment AS work_location,
       CASE WHEN c_acctbal < 0 THEN 'CONTRACT' ELSE 'PERMANENT' END AS employment_type,
       CASE WHEN c_acctbal >= 6000 THEN 'G3' WHEN c_acctbal >= 2000 THEN 'G2' ELSE 'G1' END AS grade_band
       FROM orders JOIN customer ON c_custkey = o_custkey""",
)
def j06b(spark, sf):
    people = staff.workforce(spark, sf)
    ledger = staff.payroll_ledger(staff.monthly_payroll(spark, sf), people, people)
    return ledger.withColumn("gross_earnings", F.col("gross_earnings").cast("double")).drop("_loaded_at")


@query(
    "j07_latest_child",
    f"""SELECT c_custkey AS emp_id, c_nationkey AS department_id, c_mktsegment AS work_location,
        CASE WHEN c_acctbal < 0 THEN 'CONTRACT' ELSE 'PERMANENT' END AS employment_type,
        CASE WHEN c_acctbal >= 6000 THEN 'G3' WHEN c_acctbal >= 2000 THEN 'G2' ELSE 'G1' END AS grade_band,
        first_day AS joining_date, first_day IS NOT NULL AS is_active,
        CAST(DATE_DIFF('year', first_day, {AS_OF}) AS INTEGER) AS tenure_years,
        CAST(DATE_DIFF('day', first_day, {AS_OF}) AS INTEGER) AS tenure_days,
        COALESCE(r.rating, 'NOT_REVIEWED') AS latest_rating, COALESCE(r.rating = '1', FALSE) AS promotion_flag,
        sha256(c_name) AS email_hash FROM customer
        LEFT JOIN (SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS first_day FROM orders GROUP BY 1) o ON o.o_custkey = c_custkey
        LEFT JOIN (SELECT o_custkey, substr(o_orderpriority, 1, 1) AS rating, ROW_NUMBER() OVER (PARTITION BY o_custkey
           ORDER BY strftime(o_orderdate, '%Y-%m') DESC, o_orderkey DESC) AS rn FROM orders) r
          ON r.o_custkey = c_custkey AND r.rn = 1""",
)
def j07(spark, sf):
    return staff.people_dimension(staff.workforce(spark, sf), staff.reviews(spark, sf), data.as_of())


@query(
    "j08_correlated_count",
    with_views(
        "txn",
        f"""SELECT transaction_date, (SELECT COUNT(*) FROM txn f WHERE f.status = 'FAILED'
            AND f.transaction_date = t.transaction_date) AS failed_count, COUNT(*) AS total_count,
            {sql_pct(N_FAILED, "COUNT(*)")} AS failure_rate FROM txn t GROUP BY 1""",
    ),
)
def j08(spark, sf):
    return data.transactions(spark, sf).groupBy("transaction_date").agg(
        count_when(is_failed()).alias("failed_count"), row_count().alias("total_count"),
        agg.pct(count_when(is_failed()), row_count()).alias("failure_rate"),
    )


@query(
    "j08b_spend_and_failures",
    with_views(
        "txn dim_merchant dim_customer",
        """SELECT a.customer_id, a.customer_name, a.tier, CAST(SUM(b.amount) AS DOUBLE) AS spent,
           (SELECT COUNT(*) FROM txn x WHERE x.customer_id = a.customer_id AND x.status = 'FAILED') AS failed
           FROM dim_customer a, txn b, dim_merchant c WHERE a.customer_id = b.customer_id
           AND b.merchant_id = c.merchant_id AND c.category = 'Food Delivery' GROUP BY 1, 2, 3""",
    ),
)
def j08b(spark, sf):
    food = data.merchants(spark, sf).where("category = 'Food Delivery'").select("merchant_id", F.lit(True).alias("food"))
    per_merchant = data.transactions(spark, sf).groupBy("customer_id", "merchant_id").agg(
        F.sum(the_amount()).alias("s"), count_when(is_failed()).alias("f")
    )
    per = per_merchant.join(food, "merchant_id", "left").groupBy("customer_id").agg(
        total(F.when(F.col("food"), F.col("s"))).alias("spent"), F.sum("f").alias("failed")
    )
    names = data.customers(spark, sf).select("customer_id", "customer_name", "tier")
    return names.join(per.where("spent IS NOT NULL"), "customer_id")


@query(
    "j09_bronze_not_in_silver",
    with_views(
        "txn_dirty txn",
        """SELECT transaction_id, amount, status, k FROM txn_dirty d WHERE NOT EXISTS (SELECT 1 FROM txn s
           WHERE s.transaction_id = d.transaction_id AND s.status = 'COMPLETED')""",
    ),
)
def j09(spark, sf):
    done = data.transactions(spark, sf).where(is_completed()).select("transaction_id")
    dirty = data.transactions_dirty(spark, sf).select("transaction_id", "amount", "status", "k")
    return dirty.join(done, "transaction_id", "left_anti")


@query(
    "j10_replay_exclusion",
    with_views(
        "txn_dirty txn",
        """SELECT COUNT(*) AS to_replay, COUNT(CASE WHEN trim(transaction_id) <> '' THEN 1 END) AS with_id,
           CAST(SUM(k) AS BIGINT) AS key_sum FROM (
           SELECT transaction_id, MIN(k) AS k FROM txn_dirty WHERE trim(transaction_id) <> ''
             AND transaction_id NOT IN (SELECT transaction_id FROM txn WHERE status = 'COMPLETED') GROUP BY 1
           UNION ALL SELECT transaction_id, k FROM txn_dirty WHERE transaction_id IS NULL OR trim(transaction_id) = '')""",
    ),
)
def j10(spark, sf):
    loaded = data.transactions(spark, sf).where(is_completed())
    left = joins.not_yet_loaded(data.transactions_dirty(spark, sf), loaded, "transaction_id", [F.asc("k"), F.asc("ingestion_timestamp"), F.asc("amount")])
    return left.agg(
        row_count().alias("to_replay"), count_when(F.trim("transaction_id") != "").alias("with_id"), F.sum("k").alias("key_sum")
    )


@query(
    "j11_orphans",
    with_views(
        "bronze dim_merchant dim_customer",
        """SELECT 'merchant_id' AS fk, COUNT(*) AS orphan_rows FROM bronze WHERE merchant_id IS NOT NULL
           AND merchant_id NOT IN (SELECT merchant_id FROM dim_merchant)
           UNION ALL SELECT 'customer_id', COUNT(*) FROM bronze WHERE customer_id IS NOT NULL
           AND customer_id NOT IN (SELECT customer_id FROM dim_customer)""",
    ),
)
def j11(spark, sf):
    facts = data.bronze(spark, sf).select("merchant_id", "customer_id")
    parts = []
    for key, dim in (("merchant_id", data.merchants(spark, sf)), ("customer_id", data.customers(spark, sf))):
        per_key = facts.groupBy(key).agg(row_count().alias("n"))
        lost = joins.orphans(per_key, dim, key).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"))
        parts.append(lost.select(F.lit(key).alias("fk"), "orphan_rows"))
    return parts[0].unionByName(parts[1])


@query(
    "j12_dormant_gold",
    with_views(
        "txn dim_customer",
        f"""SELECT customer_id, customer_name FROM dim_customer c WHERE tier = 'GOLD' AND NOT EXISTS
            (SELECT 1 FROM txn t WHERE t.customer_id = c.customer_id AND t.transaction_date >= {AS_OF} - INTERVAL 30 DAY)""",
    ),
)
def j12(spark, sf):
    active = data.transactions(spark, sf, data.AS_OF_DAY - datetime.timedelta(days=30)).select("customer_id")
    gold = data.customers(spark, sf).where("tier = 'GOLD'").select("customer_id", "customer_name")
    return gold.join(active.distinct(), "customer_id", "left_anti")


def reconciliation(spark, sf):
    """Ledger of all transactions against settlement rows of the gateways.

    The settlement side lacks some rows, differs by 2 in some and by 0.5 in others.
    """
    ledger = data.transactions(spark, sf).select(
        "transaction_id", F.col("payment_method").alias("gateway"), the_amount().alias("amount"), "k"
    )
    k = F.col("k")
    settled = F.when(k % 17 == 0, the_amount() + 2).when(k % 19 == 0, the_amount() + F.lit("0.50").cast("decimal(3,2)")).otherwise(the_amount())
    gateway = ledger.where(k % 13 != 0).withColumn("amount", settled.cast("decimal(18,2)"))
    return joins.reconcile(ledger.drop("k"), gateway.drop("k"), "transaction_id", "amount", "gateway")


@query(
    "j13_reconciliation",
    with_views(
        "txn",
        """SELECT payment_method AS gateway, CASE WHEN k % 13 = 0 THEN 'missing' WHEN k % 17 = 0 THEN 'disputed'
           ELSE 'matched' END AS outcome, COUNT(*) AS rows, CAST(SUM(amount) AS DOUBLE) AS ledger_total FROM txn GROUP BY 1, 2""",
    ),
)
def j13(spark, sf):
    return reconciliation(spark, sf).groupBy("gateway", "outcome").agg(
        row_count().alias("rows"), total(F.col("ledger_amount")).alias("ledger_total")
    )


@query(
    "j14_promotion_join",
    with_views(
        "txn",
        """SELECT channel, COUNT(*) AS promo_rows, CAST(SUM(spend) AS DOUBLE) AS attributed FROM
           (SELECT customer_id, SUM(amount) AS spend FROM txn WHERE status = 'COMPLETED' GROUP BY 1) s JOIN
           (SELECT CAST(user_id AS VARCHAR) AS customer_id, CASE event_type WHEN 'click' THEN 'Email' WHEN 'view' THEN 'SMS'
             ELSE 'Push' END AS channel FROM events WHERE event_type IN ('click','view','signup')) p
           ON p.customer_id = s.customer_id GROUP BY 1""",
    ),
)
def j14(spark, sf):
    from paylens.queries.aggregates import promotions

    spend = data.transactions(spark, sf).where(is_completed()).groupBy("customer_id").agg(F.sum(the_amount()).alias("spend"))
    per = promotions(spark, sf).groupBy("customer_id", "channel").agg(row_count().alias("promos"))
    return per.join(spend, "customer_id").groupBy("channel").agg(
        F.sum("promos").alias("promo_rows"), total(F.col("spend") * F.col("promos")).alias("attributed")
    )


@query(
    "j15_semi_join",
    with_views(
        "txn dim_customer",
        """SELECT customer_id, customer_name, tier FROM dim_customer WHERE customer_id IN
           (SELECT customer_id FROM txn WHERE status = 'FAILED' GROUP BY 1 HAVING COUNT(*) > 3)""",
    ),
)
def j15(spark, sf):
    often = data.transactions(spark, sf).where(is_failed()).groupBy("customer_id").agg(row_count().alias("n")).where("n > 3")
    return data.customers(spark, sf).select("customer_id", "customer_name", "tier").join(often, "customer_id", "left_semi")


@query(
    "j16_source_target_hours",
    """SELECT hour_utc, CAST(SUM(s) AS BIGINT) AS sent, CAST(SUM(t) AS BIGINT) AS loaded, CAST(SUM(s) - SUM(t) AS BIGINT) AS gap,
       SUM(s) > 0 AND SUM(t) = 0 AS failure_hour FROM (SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour_utc, 1 AS s,
       CASE WHEN ts >= TIMESTAMP '2024-01-10 02:00:00' AND ts < TIMESTAMP '2024-01-10 09:00:00' THEN 0 ELSE 1 END AS t
       FROM events) GROUP BY 1""",
)
def j16(spark, sf):
    ts = F.col("ts")
    lost = (ts >= wall_clock("2024-01-10 02:00:00")) & (ts < wall_clock("2024-01-10 09:00:00"))
    events = data.table(spark, sf, "events")
    sent = events.groupBy(hour_label(ts).alias("hour_utc")).agg(row_count().alias("n"))
    loaded = events.where(~lost).groupBy(hour_label(ts).alias("hour_utc")).agg(row_count().alias("n"))
    both = joins.side_by_side(sent, loaded, "hour_utc", ("sent", "loaded"))
    return both.withColumn("gap", F.col("sent") - F.col("loaded")).withColumn(
        "failure_hour", (F.col("sent") > 0) & (F.col("loaded") == 0)
    )
