"""Windows, top-k and set operations are in ``windows`` and ``sets``."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from paylens.functions.dates import bucket_start, epoch_label, wall_clock
from paylens.functions.numeric import money
from paylens.operators import aggregates as agg
from paylens.operators import dedup, silence, windows
from paylens.operators.aggregates import the_amount, row_count
from paylens.plans.payments import incremental
from paylens.queries import data
from paylens.queries.registry import query
from paylens.queries.sqlbase import with_views
from paylens.session import scratch_path, written
from paylens.sources import keyed


@query(
    "w01_day_on_day",
    with_views(
        "gmv",
        """SELECT transaction_date, v AS total_gmv, ROUND(v - LAG(v) OVER (ORDER BY transaction_date), 2) AS day_on_day_change,
           ROUND(CAST(100 AS DOUBLE) * (v - LAG(v) OVER (ORDER BY transaction_date))
             / NULLIF(LAG(v) OVER (ORDER BY transaction_date), 0), 2) AS growth_pct
           FROM (SELECT transaction_date, SUM(CAST(gmv AS DECIMAL(18,2)))::DOUBLE AS v FROM gmv GROUP BY 1)""",
    ),
)
def w01(spark, sf):
    daily = agg.daily_revenue(agg.daily_gmv(data.staged(spark, sf), data.merchants(spark, sf)))
    return windows.day_on_day(daily.select("transaction_date", "total_gmv"), "transaction_date", "total_gmv")


@query(
    "w02_dedup_latest",
    with_views(
        "txn",
        """SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, status, merchant_id, customer_id, transaction_date,
           payment_method, ingestion_timestamp FROM txn""",
    ),
)
def w02(spark, sf):
    return data.transactions(spark, sf).select(
        "transaction_id", the_amount().cast("double").alias("amount"), "status", "merchant_id", "customer_id", "transaction_date",
        "payment_method", "ingestion_timestamp",
    )


@query(
    "w03_mark_duplicates",
    with_views(
        "txn_dirty",
        """SELECT transaction_id, is_duplicate, COUNT(*) AS rows FROM (SELECT transaction_id,
           COUNT(*) OVER (PARTITION BY CASE WHEN trim(transaction_id) <> '' THEN transaction_id END) > 1 AS is_duplicate
           FROM txn_dirty) GROUP BY 1, 2""",
    ),
)
def w03(spark, sf):
    from paylens.functions.text import blank_to_null

    marked = dedup.flag_duplicates(
        data.transactions_dirty(spark, sf).select("transaction_id"), blank_to_null(F.col("transaction_id"))
    )
    return marked.groupBy("transaction_id", "is_duplicate").agg(row_count().alias("rows"))


@query(
    "w04_rolling_loss",
    """SELECT user_id, strftime(to_timestamp(s) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS at, CAST(v AS DOUBLE) AS amount,
       CAST(SUM(v) OVER w AS DOUBLE) AS loss_4h, SUM(v) OVER w > 300 AS breach
       FROM (SELECT user_id, CAST(FLOOR(epoch(ts)) AS BIGINT) AS s, SUM(CAST(value AS DECIMAL(18,2))) AS v FROM events GROUP BY 1, 2)
       WINDOW w AS (PARTITION BY user_id ORDER BY s RANGE BETWEEN 14400 PRECEDING AND CURRENT ROW)""",
)
def w04(spark, sf):
    out = windows.rolling_sum(data.table(spark, sf, "events"), "user_id", "ts", money(F.col("value")), 14400, "loss_4h", 300)
    return out.select(
        "user_id", epoch_label(F.col("second")).alias("at"), F.col("amount").cast("double").alias("amount"),
        F.col("loss_4h").cast("double").alias("loss_4h"), "breach",
    )


SERIES = """SELECT g.bucket, COALESCE(n, 0) AS n FROM (SELECT UNNEST(generate_series(lo, hi, 300)) AS bucket FROM
   (SELECT MIN(b) AS lo, MAX(b) AS hi FROM (SELECT CAST(FLOOR(epoch(ts) / 300) * 300 AS BIGINT) AS b FROM events))) g
   LEFT JOIN (SELECT CAST(FLOOR(epoch(ts) / 300) * 300 AS BIGINT) AS b, COUNT(*) AS n FROM events GROUP BY 1) c ON c.b = g.bucket"""


#: What the alarms over events look at: a year up to the check; rows with other times are counted apart.
CHECKED = [int((at - datetime.datetime(1970, 1, 1)).total_seconds()) for at in (data.EVENTS_AS_OF - datetime.timedelta(days=365), data.EVENTS_AS_OF)]


def all_counts(spark, sf):
    return data.table(spark, sf, "events").groupBy(bucket_start(F.col("ts"), 300).alias("bucket")).agg(row_count().alias("n"))


def five_minute_counts(spark, sf):
    return silence.within(all_counts(spark, sf), "bucket", *CHECKED)


@query(
    "w05_consecutive_breach",
    f"""SELECT bucket, n, SUM(CASE WHEN n < 1 THEN 1 ELSE 0 END) OVER (ORDER BY bucket ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) = 2
        AS alarm FROM ({SERIES})""",
)
def w05(spark, sf):
    counts = written(five_minute_counts(spark, sf), "five-minutes")
    runs = silence.low_runs(counts, "bucket", 300)
    empty = silence.each_bucket(runs.withColumn("first", F.col("start")), "bucket", 300)
    return counts.select("bucket", "n", F.lit(False).alias("alarm")).unionByName(
        empty.select("bucket", F.lit(0).cast("long").alias("n"), (F.col("bucket") > F.col("first")).alias("alarm"))
    )


@query(
    "w05b_silent_runs",
    """SELECT b + 300 AS start, next - 300 AS "end", CAST((next - b) / 300 - 1 AS BIGINT) AS buckets, (next - b) / 300 - 1 >= 2 AS alarm FROM
       (SELECT b, LEAD(b) OVER (ORDER BY b) AS next FROM (SELECT DISTINCT CAST(FLOOR(epoch(ts) / 300) * 300 AS BIGINT) AS b FROM events)) WHERE next - b > 300""",
)
def w05b(spark, sf):
    """Every silence of the feed as one row, with its length, whether or not it raises the alarm."""
    runs = silence.low_runs(written(five_minute_counts(spark, sf), "five-minutes"), "bucket", 300)
    return runs.withColumn("alarm", F.col("buckets") >= 2)


@query(
    "w05c_checked_window",
    f"""SELECT CAST(COUNT(CASE WHEN b >= {CHECKED[0]} AND b < {CHECKED[1]} THEN 1 END) AS BIGINT) AS rows_inside, CAST(COUNT(CASE WHEN b < {CHECKED[0]} THEN 1 END) AS BIGINT) AS rows_before,
        CAST(COUNT(CASE WHEN b >= {CHECKED[1]} THEN 1 END) AS BIGINT) AS rows_after, MIN(b) AS first_bucket, MAX(b) AS last_bucket
        FROM (SELECT CAST(FLOOR(epoch(ts) / 300) * 300 AS BIGINT) AS b FROM events)""",
)
def w05c(spark, sf):
    """Rows that the alarms see, and those whose clock is off by so much that they do not."""
    return silence.window_report(all_counts(spark, sf), "bucket", *CHECKED)


@query(
    "w06_latest_row_per_key",
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
       ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def w06(spark, sf):
    latest = dedup.latest_per_key(data.table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return latest.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "w07_first_seen",
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type
       ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
)
def w07(spark, sf):
    first = dedup.latest_per_key(data.table(spark, sf, "events"), ["user_id", "event_type"], [F.asc("ts"), F.asc("event_id")])
    return first.select("user_id", "event_type", "event_id", "value")


@query(
    "w08_outliers",
    """SELECT event_id, event_type, value FROM events WHERE CAST(value AS DECIMAL(18,2))::DOUBLE >
       3 * (SELECT CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value) FROM events)""",
)
def w08(spark, sf):
    rows = data.table(spark, sf, "events").withColumn("v", money(F.col("value")))
    return windows.above_average(rows, "v", 3).select("event_id", "event_type", "value")


@query(
    "s16_incremental_model",
    with_views(
        "txn_raw txn",
        """SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, status, loaded_at FROM (SELECT *, ROW_NUMBER() OVER
           (PARTITION BY transaction_id ORDER BY is_new DESC, loaded_at DESC, amount, status) AS rn FROM
           (SELECT transaction_id, amount, status, ingestion_timestamp AS loaded_at, 0 AS is_new FROM txn
              WHERE ingestion_timestamp <= TIMESTAMP '1999-06-30'
            UNION ALL SELECT transaction_id, amount, status, ingestion_timestamp, 1 FROM txn_raw WHERE ingestion_timestamp >
              (SELECT MAX(ingestion_timestamp) FROM txn WHERE ingestion_timestamp <= TIMESTAMP '1999-06-30'))) WHERE rn = 1""",
    ),
)
def s16(spark, sf):
    """A first load up to a day, then one of everything newer into the same table."""
    cut = wall_clock("1999-06-30")
    columns = ["transaction_id", "amount", "status", F.col("ingestion_timestamp").alias("loaded_at")]
    target = scratch_path(spark, "incremental")
    first = data.transactions(spark, sf).where(F.col("ingestion_timestamp") <= cut).select(*columns)
    keyed.replace_newer(spark, first, target, "transaction_id", "loaded_at")
    table = keyed.replace_newer(spark, data.transactions_raw(spark, sf).select(*columns), target, "transaction_id", "loaded_at")
    return table.withColumn("amount", F.col("amount").cast("double"))


@query(
    "s16b_incremental_view",
    with_views(
        "txn_raw txn",
        """SELECT status, COUNT(*) AS rows, CAST(SUM(amount) AS DOUBLE) AS total, MAX(loaded_at) AS newest FROM (SELECT *, ROW_NUMBER() OVER
           (PARTITION BY transaction_id ORDER BY is_new DESC, loaded_at DESC, amount, status) AS rn FROM
           (SELECT transaction_id, amount, status, ingestion_timestamp AS loaded_at, 0 AS is_new FROM txn
              WHERE ingestion_timestamp <= TIMESTAMP '1997-06-30'
            UNION ALL SELECT transaction_id, amount, status, ingestion_timestamp, 1 FROM txn_raw WHERE ingestion_timestamp >
              (SELECT MAX(ingestion_timestamp) FROM txn WHERE ingestion_timestamp <= TIMESTAMP '1997-06-30'))) WHERE rn = 1 GROUP BY 1""",
    ),
)
def s16b(spark, sf):
    """The same as one plan over two frames, summed up."""
    columns = ["transaction_id", "amount", "status", F.col("ingestion_timestamp").alias("loaded_at")]
    this = data.transactions(spark, sf).where(F.col("ingestion_timestamp") <= wall_clock("1997-06-30")).select(*columns)
    whole = incremental(data.transactions_raw(spark, sf).select(*columns), this, "transaction_id", "loaded_at")
    return whole.groupBy("status").agg(row_count().alias("rows"), F.sum("amount").cast("double").alias("total"), F.max("loaded_at").alias("newest"))
