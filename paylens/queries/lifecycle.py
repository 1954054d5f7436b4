"""Metrics, model builds, objectives, alerts, incident summary, catalogue."""

from __future__ import annotations

import datetime
import functools

import pandas as pd
from pyspark.sql import functions as F

from paylens.functions import aggregate
from paylens.functions.dates import epoch, epoch_label, wall_clock
from paylens.functions.numeric import count_when, money, pct
from paylens.functions.udf import column_model, register_model
from paylens.operators import aggregates as agg
from paylens.operators import incident, monitoring, recovery
from paylens.operators.aggregates import is_completed, is_failed, row_count, the_amount
from paylens.operators.contracts import ModelTest
from paylens.plans import increment, ledger, payments, replay
from paylens.plans.build import Model, build
from paylens.plans.medallion import ingest_bronze, run, run_recorded, to_silver, typed
from paylens.plans.metrics import metric
from paylens.queries import data
from paylens.queries.aggregates import GAP, RATE, SLA, _halves, sla_contracts
from paylens.queries.quality import FEED, replay_feed
from paylens.queries.registry import query
from paylens.queries.sqlbase import AS_OF, N_COMPLETED, N_FAILED, REASON, REVENUE, with_views
from paylens.queries.sqlbase import pct as sql_pct
from paylens.session import scratch_path, written


@query(
    "x01_user_model",
    """SELECT lang, CASE WHEN w <= 50 THEN 'short' WHEN w <= 300 THEN 'medium' ELSE 'long' END AS label, COUNT(*) AS docs
       FROM (SELECT lang, length(text) - length(replace(text, ' ', '')) + 1 AS w FROM documents) GROUP BY 1, 2""",
)
def x01(spark, sf):
    """A stand-in for a user's model: a label from the number of words.

    A function inside a function travels to the workers by value, so they need no copy
    of this package.
    """

    def text_band(texts: pd.Series) -> pd.Series:
        words = texts.str.count(" ") + 1
        return pd.cut(words, [0, 50, 300, float("inf")], labels=["short", "medium", "long"]).astype(str)

    label = column_model(text_band, "string")
    return data.table(spark, sf, "documents").select("lang", label("text").alias("label")).groupBy("lang", "label").agg(row_count().alias("docs"))


@query(
    "x01b_aggregate_function",
    """SELECT user_id, ROUND(CASE WHEN COUNT(CASE WHEN value > 0 THEN 1 END) > 0 THEN EXP(SUM(CASE WHEN value > 0 THEN LN(value) END) / COUNT(CASE WHEN value > 0 THEN 1 END)) END, 4) AS geometric_mean
       FROM events GROUP BY 1""",
)
def x01b(spark, sf):
    """A grouped Arrow aggregate, called from SQL: parts of a user's rows to states, states to a value."""
    aggregate.register_geometric_mean(spark)
    data.table(spark, sf, "events").createOrReplaceTempView("x01b_events")
    return spark.sql(
        """SELECT user_id, ROUND(geometric_mean(state), 4) AS geometric_mean FROM
           (SELECT user_id, geometric_mean_partial(value) AS state FROM x01b_events GROUP BY user_id, pmod(event_id, 64)) GROUP BY user_id"""
    )


@query(
    "x01c_table_function",
    """SELECT key, MIN(s) AS started, MAX(s) AS ended, COUNT(*) AS events FROM (SELECT key, s, SUM(CASE WHEN s - before < 1800 THEN 0 ELSE 1 END) OVER (PARTITION BY key ORDER BY s, event_id) AS visit
       FROM (SELECT user_id AS key, event_id, CAST(FLOOR(epoch(ts)) AS BIGINT) AS s, LAG(CAST(FLOOR(epoch(ts)) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY CAST(FLOOR(epoch(ts)) AS BIGINT), event_id) AS before
             FROM events)) GROUP BY key, visit""",
)
def x01c(spark, sf):
    """A table function with a partitioned, ordered table argument, called from SQL: visits of each user."""
    aggregate.register_sessions(spark)
    data.table(spark, sf, "events").select(F.col("user_id").alias("key"), epoch(F.col("ts")).alias("second")).createOrReplaceTempView("x01c_events")
    return spark.sql("SELECT key, started, ended, events FROM sessions(TABLE(x01c_events) PARTITION BY key ORDER BY second)")


@query(
    "x01d_registered_model",
    """SELECT role, CASE WHEN n < 200 THEN 'short' WHEN n < 800 THEN 'medium' ELSE 'long' END AS label, COUNT(*) AS turns FROM
       (SELECT role, length(text) AS n FROM conversations) GROUP BY 1, 2""",
)
def x01d(spark, sf):
    """A user's column model, registered and called from SQL."""

    def size_label(texts: pd.Series) -> pd.Series:
        return pd.cut(texts.str.len(), [-1, 199, 799, float("inf")], labels=["short", "medium", "long"]).astype(str)

    register_model(spark, "size_label", size_label, "string")
    data.table(spark, sf, "conversations").createOrReplaceTempView("x01d_conversations")
    return spark.sql("SELECT role, size_label(text) AS label, COUNT(*) AS turns FROM x01d_conversations GROUP BY 1, 2")


@query(
    "x02_metric_registry",
    with_views(
        "txn dim_merchant",
        f"""SELECT category, payment_method, {REVENUE} AS total_revenue, {RATE} AS failure_rate_pct, {N_COMPLETED} AS completed_transaction_count
            FROM txn t JOIN dim_merchant m ON t.merchant_id = m.merchant_id GROUP BY 1, 2""",
    ),
)
def x02(spark, sf):
    dims = {"category": ("merchant_id", data.merchants(spark, sf))}
    names = ["total_revenue", "failure_rate_pct", "completed_transaction_count"]
    return metric(data.transactions(spark, sf), names, ["category", "payment_method"], dims)


@query(
    "x03_verified_totals",
    with_views(
        "txn dim_merchant",
        f"""SELECT 'total_transactions' AS question, CAST(COUNT(*) AS DOUBLE) AS answer FROM txn UNION ALL SELECT 'failed_count', {N_FAILED} FROM txn
        UNION ALL SELECT 'best_merchant_revenue', MAX(r) FROM (SELECT {REVENUE} AS r FROM txn t JOIN dim_merchant m ON t.merchant_id = m.merchant_id GROUP BY merchant_name)""",
    ),
)
def x03(spark, sf):
    per = data.transactions(spark, sf).groupBy("merchant_id").agg(
        row_count().alias("n"), count_when(is_failed()).alias("f"), agg.when_sum(is_completed(), the_amount()).alias("r")
    )
    known = per.join(data.merchants(spark, sf).select("merchant_id", F.lit(True).alias("known")), "merchant_id", "left")
    wide = known.agg(
        F.sum("n").cast("double").alias("total_transactions"), F.sum("f").cast("double").alias("failed_count"),
        F.max(F.when(F.col("known"), F.col("r"))).alias("best_merchant_revenue"),
    )
    return wide.unpivot([], wide.columns, "question", "answer")


@query(
    "x04_upi_daily_trend",
    with_views("txn", "SELECT transaction_date, COUNT(*) AS txn_count FROM txn WHERE payment_method = 'UPI' GROUP BY 1"),
)
def x04(spark, sf):
    upi = data.transactions(spark, sf).where("payment_method = 'UPI'")
    return upi.groupBy("transaction_date").agg(row_count().alias("txn_count")).orderBy("transaction_date")


@query(
    "x04b_average_by_method",
    with_views(
        "txn",
        "SELECT payment_method, COUNT(*) AS orders, CAST(SUM(amount) AS DOUBLE) / COUNT(*) AS avg_value FROM txn WHERE status = 'COMPLETED' GROUP BY 1",
    ),
)
def x04b(spark, sf):
    done = data.transactions(spark, sf).where(is_completed())
    return done.groupBy("payment_method").agg(
        row_count().alias("orders"), agg.mean_of(agg.total(the_amount()), row_count()).alias("avg_value")
    )


@query(
    "x04c_failing_merchants_last_week",
    with_views(
        "txn dim_merchant",
        f"""SELECT merchant_name, txn_count, failure_rate_pct FROM (SELECT merchant_id, COUNT(*) AS txn_count, {RATE} AS failure_rate_pct FROM txn
            WHERE transaction_date > {AS_OF} - INTERVAL 7 DAY GROUP BY 1) q JOIN dim_merchant m ON m.merchant_id = q.merchant_id WHERE failure_rate_pct > 20""",
    ),
)
def x04c(spark, sf):
    week = data.transactions(spark, sf, data.AS_OF_DAY - datetime.timedelta(days=6))
    per = week.groupBy("merchant_id").agg(row_count().alias("txn_count"), pct(count_when(is_failed()), row_count()).alias("failure_rate_pct"))
    bad = per.where("failure_rate_pct > 20").join(data.merchants(spark, sf), "merchant_id")
    return bad.select("merchant_name", "txn_count", "failure_rate_pct")


@query(
    "x05_model_build",
    with_views(
        "gmv",
        """SELECT m.merchant_id, m.merchant_name, m.category, m.city, COALESCE(p.merchant_tier, 'BRONZE') AS current_tier, COALESCE(p.gmv_30d, 0) AS gmv_30d,
           COALESCE(p.avg_failure_rate_pct, 0) AS failure_rate_30d_pct FROM dim_merchant m LEFT JOIN perf p ON p.merchant_id = m.merchant_id""",
        {
            "perf": f"""SELECT merchant_id, SUM(CAST(gmv AS DECIMAL(18,2)))::DOUBLE AS gmv_30d, CAST(SUM(CAST(failure_rate_pct AS DECIMAL(18,2))) AS DOUBLE) / COUNT(failure_rate_pct) AS avg_failure_rate_pct,
                CASE WHEN SUM(CAST(gmv AS DECIMAL(18,2))) >= 1000000 THEN 'PLATINUM' WHEN SUM(CAST(gmv AS DECIMAL(18,2))) >= 500000 THEN 'GOLD'
                 WHEN SUM(CAST(gmv AS DECIMAL(18,2))) >= 100000 THEN 'SILVER' ELSE 'BRONZE' END AS merchant_tier
                FROM gmv WHERE transaction_date >= {AS_OF} - INTERVAL 30 DAY GROUP BY 1"""
        },
    ),
)
def x05(spark, sf):
    """Staging views, daily values as a table, rolling performance, merchant dimension."""
    models = [
        Model("stg_transactions", lambda b: data.staged(spark, sf)),
        Model("stg_merchants", lambda b: data.merchants(spark, sf), tests=(ModelTest("unique", "merchant_id"), ModelTest("not_null", "merchant_id"))),
        Model("int_daily_gmv", lambda b: agg.daily_gmv(b["stg_transactions"], b["stg_merchants"]), "table", (ModelTest("between", "failure_rate_pct", low=0, high=100),)),
        Model("int_merchant_performance", lambda b: agg.rolling_merchant(b["int_daily_gmv"], data.as_of())),
        Model("dim_merchants", lambda b: payments.merchant_dimension(b["stg_merchants"], b["int_merchant_performance"])),
    ]
    return build(spark, models, scratch_path(spark, "models"))["dim_merchants"]


def bronze_feed(spark, sf):
    """Raw rows, of which a few name a merchant that does not exist, written as Bronze."""
    bronze = data.transactions_raw(spark, sf).withColumn(
        "merchant_id", F.when(F.col("k") % 41 == 0, "MXXX").otherwise(F.col("merchant_id"))
    )
    columns = ["transaction_id", "amount", "status", "merchant_id", "customer_id", "transaction_date", "payment_method", "k", "ingestion_timestamp"]
    return written(bronze.select(*columns), "bronze")


def layered_run(spark, sf):
    """Silver and Gold written from a Bronze feed; returns their folder and the counts."""
    out = scratch_path(spark, "layers")
    return out, run(spark, bronze_feed(spark, sf), data.merchants(spark, sf), out, grain="month")


RECORD = "run_id string, status string, error string, rows_in long, rows_valid long, rows_out long, started timestamp, ended timestamp"


def run_record(spark, sf, run_id):
    """The record that a layered run wrote about itself."""
    out = scratch_path(spark, "recorded")
    run_recorded(spark, run_id, bronze_feed(spark, sf), data.merchants(spark, sf), out, grain="month")
    return spark.read.schema(RECORD).json(f"{out}/runs/{run_id}")


@query(
    "s19b_recorded_run",
    with_views(
        "txn_raw",
        """SELECT 'run-7' AS run_id, 'SUCCESS' AS status, '' AS error, COUNT(*) AS rows_in, COUNT(CASE WHEN transaction_id <> '' AND amount >= 0 THEN 1 END) AS rows_valid,
           COUNT(DISTINCT CASE WHEN transaction_id <> '' AND amount >= 0 THEN transaction_id END) AS rows_out, TRUE AS timed FROM txn_raw""",
    ),
)
def s19b(spark, sf):
    """Status, error, times and counts per stage, as the run recorded them."""
    return run_record(spark, sf, "run-7").select(
        "run_id", "status", "error", "rows_in", "rows_valid", "rows_out", (F.col("started") <= F.col("ended")).alias("timed")
    )


@query(
    "x05b_layered_run",
    with_views(
        "txn_raw dim_merchant",
        """SELECT quality_flag, COUNT(*) AS rows, COUNT(DISTINCT transaction_date) AS days, COUNT(DISTINCT merchant_name) AS merchants FROM (
           SELECT b.transaction_date, m.merchant_name, CASE WHEN m.merchant_id IS NULL THEN 'UNMATCHED' ELSE 'CLEAN' END AS quality_flag FROM
           (SELECT DISTINCT ON (transaction_id) transaction_id, transaction_date, CASE WHEN k % 41 = 0 THEN 'MXXX' ELSE merchant_id END AS merchant_id
            FROM txn_raw ORDER BY transaction_id, ingestion_timestamp DESC, amount, merchant_id) b LEFT JOIN dim_merchant m ON m.merchant_id = b.merchant_id) GROUP BY 1""",
    ),
)
def x05b(spark, sf):
    out, _ = layered_run(spark, sf)
    return spark.read.parquet(f"{out}/silver").groupBy("quality_flag").agg(
        row_count().alias("rows"), F.count_distinct("transaction_date").alias("days"), F.count_distinct("merchant_name").alias("merchants")
    )


GOLD_SQL = with_views(
    "txn_raw dim_merchant",
    f"""SELECT 'merchant_performance' AS gold, COALESCE(merchant_id, '') AS key, transaction_date AS day, {REVENUE} AS amount, COUNT(*) AS n,
          {RATE} AS rate, COALESCE(MAX(merchant_name), '') AS label, CAST(NULL AS BIGINT) AS customers, CAST(NULL AS BIGINT) AS merchants FROM s GROUP BY merchant_id, transaction_date
        UNION ALL SELECT 'daily_summary', '', transaction_date, {REVENUE}, COUNT(*), {RATE}, '', COUNT(DISTINCT customer_id), COUNT(DISTINCT merchant_id) FROM s GROUP BY transaction_date
        UNION ALL SELECT 'customer_ltv', customer_id, MIN(transaction_date), {REVENUE}, COUNT(*),
          CAST(SUM(CASE WHEN status = 'COMPLETED' THEN amount ELSE 0 END) AS DOUBLE) / NULLIF(CAST({N_COMPLETED} AS DOUBLE), 0),
          MAX(method) || ' until ' || CAST(MAX(transaction_date) AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
        FROM s JOIN (SELECT customer_id AS c, FIRST(payment_method ORDER BY n DESC, payment_method) AS method FROM
          (SELECT customer_id, payment_method, COUNT(*) AS n FROM s GROUP BY 1, 2) GROUP BY 1) ON c = customer_id GROUP BY customer_id""",
    {
        "s": """SELECT b.*, m.merchant_name FROM
           (SELECT DISTINCT ON (transaction_id) transaction_id, amount, status, customer_id, payment_method, transaction_date, CASE WHEN k % 41 = 0 THEN 'MXXX' ELSE merchant_id END AS merchant_id
            FROM txn_raw ORDER BY transaction_id, ingestion_timestamp DESC, amount, merchant_id) b LEFT JOIN dim_merchant m ON m.merchant_id = b.merchant_id"""
    },
)


def gold_rows(merchant, daily, ltv):
    """The three Gold tables side by side, with one set of columns."""
    nothing = F.lit(None).cast("long")
    shape = ["gold", "key", "day", "amount", "n", "rate", "label", "customers", "merchants"]
    parts = [
        merchant.select(F.lit("merchant_performance"), F.coalesce("merchant_id", F.lit("")), "transaction_date", "total_revenue", "txn_count", "failure_rate_pct", "merchant_name", nothing, nothing),
        daily.select(F.lit("daily_summary"), F.lit(""), "report_date", "total_revenue", "total_txns", "failure_rate_pct", F.lit(""), "unique_customers", "unique_merchants"),
        ltv.select(
            F.lit("customer_ltv"), "customer_id", "first_txn_date", "total_spent", "total_txns", "avg_txn_value",
            F.concat("preferred_payment_method", F.lit(" until "), F.col("last_txn_date").cast("string")), nothing, nothing,
        ),
    ]
    return functools.reduce(lambda a, b: a.unionByName(b), [p.toDF(*shape) for p in parts])


@query("x05d_layered_gold", GOLD_SQL)
def x05d(spark, sf):
    """All Gold tables of a whole layered run."""
    out, _ = layered_run(spark, sf)
    return gold_rows(*[spark.read.parquet(f"{out}/{t}") for t in ("merchant_performance", "daily_summary", "customer_ltv")])


@query("x05e_incremental_gold", GOLD_SQL)
def x05e(spark, sf):
    """The same tables after three batches, of which each touches some years and brings copies of older transactions."""
    out, bronze, merchants = scratch_path(spark, "increments"), bronze_feed(spark, sf), data.merchants(spark, sf)
    for version, batch in enumerate(["k % 3 = 0", "transaction_date < DATE '1995-07-01' AND k % 3 = 1", "transaction_date >= DATE '1995-07-01' AND k % 3 = 1 OR k % 3 = 2"], 1):
        increment.run_batch(spark, bronze.where(batch), merchants, out, version, grain="yyyy")
    return gold_rows(*[increment.read(spark, out, t) for t in ("merchant_performance", "daily_summary", "customer_ltv")])


@query(
    "x05f_distinct_over_any_period",
    with_views(
        "txn_raw",
        """SELECT strftime(transaction_date, '%Y') AS year, COUNT(DISTINCT customer_id) AS unique_customers FROM
           (SELECT DISTINCT ON (transaction_id) transaction_id, transaction_date, customer_id FROM txn_raw ORDER BY transaction_id, ingestion_timestamp DESC, k) GROUP BY 1""",
    ),
)
def x05f(spark, sf):
    """Customers of each year from the daily bitmaps, without the transactions."""
    out = scratch_path(spark, "bitmaps")
    increment.run_batch(spark, bronze_feed(spark, sf), data.merchants(spark, sf), out, 1, grain="yyyy")
    buyers = increment.read(spark, out, "buyers").withColumn("year", F.date_format("transaction_date", "yyyy"))
    return increment.distinct_buyers(buyers, ["year"])


@query(
    "x05c_csv_to_gold",
    with_views(
        "txn_dirty dim_merchant",
        r"""SELECT b.payment_method, COUNT(*) AS rows, COUNT(transaction_date) AS dated, CAST(SUM(CASE WHEN status = 'COMPLETED' THEN amount ELSE 0 END) AS DOUBLE) AS revenue,
           COUNT(m.merchant_id) AS matched FROM (SELECT * FROM (SELECT transaction_id, TRY_CAST(trim(amount) AS DECIMAL(18,2)) AS amount, trim(status) AS status, merchant_id,
             payment_method, CASE WHEN regexp_matches(transaction_date, '^\d{4}-\d{2}-\d{2}$') THEN TRY_CAST(transaction_date AS DATE) END AS transaction_date,
             ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY ingestion_timestamp DESC, TRY_CAST(trim(amount) AS DECIMAL(18,2)), trim(status), merchant_id) AS rn
             FROM txn_dirty WHERE trim(transaction_id) <> '' AND TRY_CAST(trim(amount) AS DECIMAL(18,2)) >= 0) WHERE rn = 1) b
           LEFT JOIN dim_merchant m ON m.merchant_id = b.merchant_id GROUP BY 1""",
    ),
)
def x05c(spark, sf):
    """A damaged CSV feed, ingested as text, typed, cleaned and summed up."""
    path = scratch_path(spark, "csv-feed")
    feed = data.transactions_dirty(spark, sf).withColumnRenamed("ingestion_timestamp", "arrived_at")
    feed.withColumn("arrived_at", F.date_format("arrived_at", "yyyy-MM-dd HH:mm:ss")).write.option("header", True).csv(f"{path}/in")
    ingest_bronze(spark, f"{path}/in", f"{path}/bronze", "run-1", wall_clock("2024-01-31 02:00:00"), F.substring("arrived_at", 1, 7))
    order = [F.desc("arrived_at"), F.asc("amount"), F.asc("status"), F.asc("merchant_id")]
    silver = to_silver(typed(spark.read.parquet(f"{path}/bronze")), data.merchants(spark, sf), order)
    return silver.groupBy("payment_method").agg(
        row_count().alias("rows"), F.count("transaction_date").alias("dated"), agg.when_sum(is_completed(), the_amount()).alias("revenue"),
        count_when(F.col("quality_flag") == "CLEAN").alias("matched"),
    )


HEALTH = f"""SELECT CAST(DATE_DIFF('day', MAX(transaction_date), {AS_OF}) * 24 AS DOUBLE) AS freshness_hours,
   CAST(100 AS DOUBLE) * COUNT(CASE WHEN quality_flag = 'CLEAN' THEN 1 END) / COUNT(*) AS quality_pct,
   CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT transaction_date) AS rows_per_day FROM silver"""


#: Records of nightly runs, as the audit log has them: a run begins with the first event of a day and ends with the last before three o'clock.
RUNS = """SELECT CAST(ts AS DATE) AS run_day, CAST(epoch_us(MAX(ts)) - epoch_us(MIN(ts)) AS DOUBLE) / 60000000 AS minutes FROM events WHERE EXTRACT(HOUR FROM ts) < 3 GROUP BY 1"""
RUNTIME = f"(SELECT minutes FROM ({RUNS}) ORDER BY run_day DESC LIMIT 1)"
#: Minutes a run may take.
RUN_LIMIT = 120
#: Valid rows of a load, in percent, as its record has them.
LOAD = "(SELECT CAST(100 AS DOUBLE) * COUNT(CASE WHEN transaction_id <> '' AND amount >= 0 THEN 1 END) / COUNT(*) FROM txn_raw)"


def recorded_runs(spark, sf):
    """``run_day, started, ended`` of every nightly run."""
    nightly = data.table(spark, sf, "events").where(F.hour("ts") < 3)
    return nightly.groupBy(F.to_date("ts").alias("run_day")).agg(F.min("ts").alias("started"), F.max("ts").alias("ended"))


def health_metrics(spark, sf):
    """One row of pipeline health: Silver as it is, the newest recorded run's time to the microsecond, and a load made now.

    The load is a whole layered run; its own record says how many rows were valid. One that
    fails or takes longer than a run may counts as none.
    """
    record = recorded_runs(spark, sf).orderBy(F.desc("run_day")).limit(1)
    runtime = monitoring.minutes_of(F.col("started"), F.col("ended"))
    in_time = (F.col("status") == "SUCCESS") & (runtime <= RUN_LIMIT)
    load = run_record(spark, sf, "health").select(F.when(in_time, F.lit(100.0) * F.col("rows_valid") / F.col("rows_in")).otherwise(0.0))
    per_day = data.silver(spark, sf).groupBy("transaction_date").agg(row_count().alias("n"), count_when(F.col("quality_flag") == "CLEAN").alias("ok"))
    return per_day.agg(
        (F.datediff(data.as_of(), F.max("transaction_date")) * 24).cast("double").alias("freshness_hours"),
        (F.lit(100.0) * F.sum("ok") / F.sum("n")).alias("quality_pct"),
        (F.sum("n").cast("double") / F.count("transaction_date")).alias("rows_per_day"),
        record.select(runtime).scalar().alias("runtime_minutes"),
        load.scalar().alias("load_valid_pct"),
    )


OBJECTIVES = [
    monitoring.Objective("data_freshness", "freshness_hours", high=24),
    monitoring.Objective("quality", "quality_pct", low=99.9),
    monitoring.Objective("row_count", "rows_per_day", low=17, high=25),
    monitoring.Objective("runtime", "runtime_minutes", high=RUN_LIMIT),
    monitoring.Objective("load", "load_valid_pct", low=95),
]
SLO_SQL = f"""SELECT 'data_freshness' AS objective, freshness_hours AS value, freshness_hours <= 24 AS met FROM h
   UNION ALL SELECT 'quality', quality_pct, quality_pct >= 99.9 FROM h UNION ALL SELECT 'row_count', rows_per_day, rows_per_day BETWEEN 17 AND 25 FROM h
   UNION ALL SELECT 'runtime', {RUNTIME}, {RUNTIME} <= {RUN_LIMIT} FROM h UNION ALL SELECT 'load', {LOAD}, {LOAD} >= 95 FROM h"""


@query("x06_objectives", with_views("txn_raw silver", SLO_SQL, {"h": HEALTH}))
def x06(spark, sf):
    return monitoring.evaluate_objectives(health_metrics(spark, sf), OBJECTIVES)


@query(
    "x07_alert_rules",
    with_views(
        "txn_raw silver",
        f"""SELECT * FROM (SELECT 'data_freshness_breach' AS rule, 'CRITICAL' AS severity, freshness_hours > 24 AS fired FROM h
        UNION ALL SELECT 'quality_threshold_breach', 'CRITICAL', quality_pct < 99.9 FROM h UNION ALL SELECT 'row_count_outside_bounds', 'CRITICAL', rows_per_day NOT BETWEEN 17 AND 25 FROM h
        UNION ALL SELECT 'runtime_approaching_limit', 'WARNING', {RUNTIME} > 120 * 0.9 UNION ALL SELECT 'quality_slightly_below_threshold', 'WARNING', quality_pct < 99.9 AND quality_pct >= 99.85 FROM h
        UNION ALL SELECT 'merchant_failure_rate_spike', 'WARNING', (SELECT MAX(p) > 30 FROM (SELECT {sql_pct(N_FAILED, 'COUNT(*)')} AS p FROM silver GROUP BY merchant_id))
        UNION ALL SELECT 'new_payment_method_detected', 'INFO', (SELECT COUNT(*) > 0 FROM silver WHERE payment_method NOT IN ('CREDIT_CARD', 'UPI'))
        UNION ALL SELECT 'row_count_near_bounds', 'INFO', rows_per_day BETWEEN 17 AND 18 OR rows_per_day BETWEEN 24 AND 25 FROM h
        UNION ALL SELECT 'load_failed', 'CRITICAL', {LOAD} < 95)""",
        {"h": HEALTH},
    ),
)
def x07(spark, sf):
    silver = data.valid_rows(data.bronze(spark, sf))
    rates = silver.groupBy("merchant_id").agg(pct(count_when(is_failed()), row_count()).alias("p"))
    fresh = monitoring.unseen_values(silver, "payment_method", ["CREDIT_CARD", "UPI"])
    metrics = health_metrics(spark, sf).withColumn("max_failure_rate_pct", rates.agg(F.max("p")).scalar()).withColumn(
        "new_methods", fresh.agg(row_count()).scalar()
    )
    return monitoring.evaluate_alerts(metrics, [*monitoring.ALERT_RULES, monitoring.AlertRule("load_failed", "CRITICAL", "load_valid_pct < 95")])


INCIDENT_SQL = with_views(
    "txn_dirty dim_merchant",
    f"""SELECT ROUND(SUM(CASE WHEN m > 0 THEN m END), 2) AS gmv_gap, COUNT(CASE WHEN m > 0 THEN 1 END) AS merchants_affected, MAX(b.n) AS sla_breaches, MAX(rows_read) AS rows_read,
        MAX(ids) AS rows_loaded, MAX(clean - ids) AS rows_skipped, MAX(rows_quarantined) AS rows_quarantined FROM
        (SELECT user_id, ROUND(expected - loaded, 2) AS m FROM ({GAP})) g,
        (SELECT COUNT(*) AS n FROM (SELECT user_id AS merchant_id, ROUND(expected - loaded, 2) AS m FROM ({GAP})) x JOIN ({SLA}) s ON s.merchant_id = x.merchant_id WHERE x.m > s.threshold) b,
        (SELECT COUNT(*) AS rows_read, COUNT(CASE WHEN reason = '' THEN 1 END) AS clean, COUNT(DISTINCT CASE WHEN reason = '' THEN transaction_id END) AS ids,
         COUNT(CASE WHEN reason <> '' THEN 1 END) AS rows_quarantined FROM (SELECT *, {REASON} AS reason FROM feed)) r""",
    {"feed": FEED + " WHERE d.ingestion_timestamp >= TIMESTAMP '2000-06-01'"},
)


@query("x08_incident_summary", INCIDENT_SQL)
def x08(spark, sf):
    gap = recovery.gmv_gap(*_halves(spark, sf), 15, 15)
    load = replay.recover(spark, replay_feed(spark, sf), scratch_path(spark, "incident-target"), datetime.datetime(2000, 6, 1), "recovery")
    return recovery.incident_summary(gap, recovery.sla_breaches(gap, sla_contracts(spark, sf)), load)


#: The outage of 10 January, the days that are checked for it, and the history that says what an hour should bring.
OUTAGE = "ts >= TIMESTAMP '2024-01-10 02:00:00' AND ts < TIMESTAMP '2024-01-10 09:00:00'"
CHECKED_DAYS = [int(datetime.datetime(2024, 1, d, tzinfo=datetime.timezone.utc).timestamp()) for d in (8, 15)]
HISTORY_DAYS = [int(datetime.datetime(2024, 1, d, tzinfo=datetime.timezone.utc).timestamp()) for d in (16, 30)]
SHORTFALL = f"""
WITH loaded AS (SELECT CAST(FLOOR(epoch(ts) / 3600) * 3600 AS BIGINT) AS hour, user_id, CAST(value AS DECIMAL(18,2)) AS v FROM events WHERE NOT ({OUTAGE})),
hourly AS (SELECT hour, COUNT(*) AS n FROM loaded GROUP BY 1),
base AS (SELECT hour % 604800 AS slot, SUM(n) / CAST(2 AS DOUBLE) AS expected FROM hourly WHERE hour >= {HISTORY_DAYS[0]} AND hour < {HISTORY_DAYS[1]} GROUP BY 1),
checked AS (SELECT g.hour, COALESCE(n, 0) AS n, COALESCE(expected, 0) AS expected FROM (SELECT UNNEST(range({CHECKED_DAYS[0]}, {CHECKED_DAYS[1]}, 3600)) AS hour) g
  LEFT JOIN hourly h ON h.hour = g.hour LEFT JOIN base b ON b.slot = g.hour % 604800),
islands AS (SELECT MIN(hour) AS s, MAX(hour) + 3600 AS e, COUNT(*) AS hours, ROUND(SUM(GREATEST(expected - n, 0)), 2) AS records_missing FROM
  (SELECT *, hour - 3600 * ROW_NUMBER() OVER (ORDER BY hour) AS island FROM checked WHERE n < expected * 0.5) GROUP BY island)"""
LABEL_AT = "strftime(to_timestamp({}) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S')"


def outage(spark, sf):
    """Hourly loads without the outage's rows, their weekly baseline and the failure windows."""
    loaded = data.table(spark, sf, "events").where(~F.expr(OUTAGE.replace("TIMESTAMP", "TIMESTAMP_NTZ")))
    amount = money(F.col("value"))
    per_hour = written(incident.hourly(loaded, "ts", amount), "hourly")
    hours = incident.hourly_shortfall(per_hour, incident.weekly_baseline(per_hour, *HISTORY_DAYS), *CHECKED_DAYS)
    per_merchant = written(incident.hourly(loaded.withColumn("merchant_id", F.col("user_id")), "ts", amount, ["merchant_id"]), "merchant-hours")
    return written(incident.failure_windows(hours), "windows"), per_merchant


@query(
    "x08b_failure_windows",
    f"""{SHORTFALL} SELECT {LABEL_AT.format('s')} AS window_start, {LABEL_AT.format('e')} AS window_end, hours, records_missing FROM islands""",
)
def x08b(spark, sf):
    """Every maximal run of hours that brought less than half of what their hour of the week does."""
    windows, _ = outage(spark, sf)
    return windows.select(epoch_label(F.col("start")).alias("window_start"), epoch_label(F.col("end")).alias("window_end"), "hours", "records_missing")


@query(
    "x08c_incident_row",
    f"""{SHORTFALL}, w AS (SELECT * FROM islands ORDER BY records_missing DESC, s LIMIT 1),
    mh AS (SELECT hour, user_id, COUNT(*) AS n, CAST(SUM(v) AS DOUBLE) AS amount FROM loaded GROUP BY 1, 2),
    mb AS (SELECT hour % 604800 AS slot, user_id, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / 2 AS expected FROM mh WHERE hour >= {HISTORY_DAYS[0]} AND hour < {HISTORY_DAYS[1]} GROUP BY 1, 2),
    wh AS (SELECT UNNEST(range(s, e, 3600)) AS hour FROM w),
    lost AS (SELECT b.user_id, CAST(ROUND(SUM(CAST(GREATEST(expected - COALESCE(amount, 0), 0) AS DECIMAL(28,6))), 2) AS DOUBLE) AS missing FROM wh JOIN mb b ON b.slot = wh.hour % 604800
      LEFT JOIN mh m ON m.hour = wh.hour AND m.user_id = b.user_id GROUP BY 1),
    told AS (SELECT user_id, missing FROM lost JOIN ({SLA}) c ON c.merchant_id = user_id WHERE missing > threshold / 10)
    SELECT records_missing, (SELECT COALESCE(ROUND(CAST(SUM(CAST(missing AS DECIMAL(28,2))) AS DOUBLE), 2), 0) FROM lost WHERE missing > 0) AS gmv_gap, {LABEL_AT.format('s')} AS window_start,
      {LABEL_AT.format('e')} AS window_end, (SELECT COUNT(*) FROM lost WHERE missing > 0) AS merchants_affected, (SELECT COUNT(*) FROM told) AS sla_breaches,
      (SELECT COALESCE(string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY missing DESC, CAST(user_id AS VARCHAR)), '') FROM (SELECT * FROM told ORDER BY missing DESC, user_id LIMIT 5)) AS notify_first,
      CASE WHEN (SELECT COUNT(*) FROM told) > 0 THEN {LABEL_AT.format('e + 7200')} END AS notify_by FROM w""",
)
def x08c(spark, sf):
    """The incident as one row: window, records and value missing, who must be told and until when."""
    windows, per_merchant = outage(spark, sf)
    worst = incident.worst_window(windows)
    losses = written(incident.merchant_losses(per_merchant, incident.weekly_baseline(per_merchant, *HISTORY_DAYS, ["merchant_id"]), worst, "merchant_id"), "losses")
    contracts = sla_contracts(spark, sf).withColumn("threshold", F.col("threshold") / 10)
    told = incident.notifications(losses, contracts, worst, "merchant_id")
    return incident.incident_row(worst, losses, told, "merchant_id")


@query(
    "r10b_replay_with_ledger",
    with_views(
        "txn_dirty dim_merchant",
        f"""SELECT run, CAST(rows_read AS BIGINT) AS rows_read, CAST(CASE WHEN run = 'first' THEN noted ELSE noted_later END AS BIGINT) AS duplicates_skipped,
            CASE WHEN run = 'first' THEN ids ELSE 0 END AS rows_loaded, CAST(CASE WHEN run = 'first' THEN clean - noted_clean - ids ELSE clean - noted_later_clean END AS BIGINT) AS rows_skipped,
            CAST(rows_read - CASE WHEN run = 'first' THEN noted ELSE noted_later END - CASE WHEN run = 'first' THEN clean - noted_clean ELSE clean - noted_later_clean END AS BIGINT) AS rows_quarantined
            FROM (SELECT COUNT(*) AS rows_read, COUNT(CASE WHEN reason = '' THEN 1 END) AS clean, COUNT(CASE WHEN before THEN 1 END) AS noted, COUNT(CASE WHEN before AND reason = '' THEN 1 END) AS noted_clean,
              COUNT(DISTINCT CASE WHEN reason = '' AND NOT before THEN transaction_id END) AS ids,
              COUNT(CASE WHEN before OR good THEN 1 END) AS noted_later, COUNT(CASE WHEN (before OR good) AND reason = '' THEN 1 END) AS noted_later_clean
              FROM (SELECT *, COALESCE(transaction_id IN (SELECT transaction_id FROM judged WHERE reason = ''), FALSE) AS good FROM judged)), (VALUES ('first'), ('again')) t(run)""",
        {
            "feed": FEED.replace("SELECT d.k,", "SELECT d.k, d.ingestion_timestamp AS at,") + " WHERE d.ingestion_timestamp >= TIMESTAMP '2000-06-01' AND d.ingestion_timestamp < TIMESTAMP '2000-06-08'",
            "judged": f"SELECT *, {REASON} AS reason, COALESCE(transaction_id <> '' AND k % 4 = 0, FALSE) AS before FROM feed",
        },
    ),
)
def r10b(spark, sf):
    """A week replayed twice; of some rows the ledger knows that they were loaded after the failure began."""
    target, ledger_path = scratch_path(spark, "ledger-target"), scratch_path(spark, "ledger")
    start, now = datetime.datetime(2000, 6, 1), datetime.datetime(2000, 6, 8)
    feed = replay_feed(spark, sf).where(F.col("ingestion_timestamp") < wall_clock(now))
    early = feed.where((F.col("ingestion_timestamp") >= wall_clock(start)) & (F.col("k") % 4 == 0))
    ledger.note_load(early, "transaction_id", ledger_path, datetime.datetime(2000, 6, 2, 5), "nightly")
    ledger.note_load(feed.where("k % 4 = 1"), "transaction_id", ledger_path, datetime.datetime(2000, 5, 30), "before the failure")
    out = None
    for run_id in ("first", "again"):
        counts = ledger.replay(spark, feed, target, ledger_path, start, now, run_id, cause_fixed=True).select(F.lit(run_id).alias("run"), "*")
        out = counts if out is None else out.unionByName(counts)
    return out


@query(
    "x09_load_verification",
    with_views(
        "txn_dirty dim_merchant",
        f"""SELECT ids AS rows_found, CAST(0 AS BIGINT) AS rows_without_id, ids AS rows_expected, TRUE AS verified FROM
            (SELECT COUNT(DISTINCT CASE WHEN reason = '' THEN transaction_id END) AS ids FROM (SELECT *, {REASON} AS reason FROM feed))""",
        {"feed": FEED + " WHERE d.ingestion_timestamp >= TIMESTAMP '2000-06-01'"},
    ),
)
def x09(spark, sf):
    target = scratch_path(spark, "verified-target")
    load = replay.recover(spark, replay_feed(spark, sf), target, datetime.datetime(2000, 6, 1), "recovery")
    return replay.verify(spark, target, "recovery", load)


@query(
    "x10_status_rollup",
    with_views(
        "txn_raw silver",
        f"""SELECT COUNT(*) AS objectives, COUNT(CASE WHEN NOT met THEN 1 END) AS missed, CASE WHEN COUNT(CASE WHEN NOT met AND objective IN ('data_freshness', 'quality', 'load') THEN 1 END) > 0
            THEN 'CRITICAL' WHEN COUNT(CASE WHEN NOT met THEN 1 END) > 0 THEN 'DEGRADED' ELSE 'HEALTHY' END AS status FROM ({SLO_SQL})""",
        {"h": HEALTH},
    ),
)
def x10(spark, sf):
    results = monitoring.evaluate_objectives(health_metrics(spark, sf), OBJECTIVES)
    return monitoring.status_rollup(results, ["data_freshness", "quality", "load"])


NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark",
    "labels", "conversations",
]
_KINDS = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT' THEN 'float'
   WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'BOOLEAN' THEN 'boolean'
   WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'DOUBLE[]' THEN 'array<double>' ELSE column_type END"""


@query(
    "x11_catalogue",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, column_name, {_KINDS} AS data_type, (SELECT COUNT(*) FROM {n}) AS rows FROM (DESCRIBE {n})" for n in NAMES
    ),
)
def x11(spark, sf):
    """Every table's columns with their types, and its rows, as an agent or analyst would list them."""
    out = None
    for name in NAMES:
        df = data.table(spark, sf, name)
        columns = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("data_type")) for c, kind in df.dtypes])
        line = df.agg(row_count().alias("rows")).select(F.lit(name).alias("table_name"), "rows", F.inline(columns))
        out = line if out is None else out.unionByName(line)
    return out
