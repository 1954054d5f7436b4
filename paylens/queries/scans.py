"""Sources and sinks: each query writes given tables and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paylens.functions import numeric
from paylens.functions.dates import wall_clock
from paylens.functions.text import is_blank
from paylens.operators.aggregates import row_count
from paylens.operators.quality import Check, failing, profile
from paylens.queries import data
from paylens.queries.registry import query
from paylens.queries.sqlbase import with_views
from paylens.session import scratch_path
from paylens.sources import readers, writers


@query(
    "s01_bronze_csv",
    """SELECT o_orderstatus, COUNT(*) AS rows, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
       MIN(strftime(o_orderdate, '%Y-%m-%d')) AS first_day FROM orders GROUP BY 1""",
)
def s01(spark, sf):
    path = scratch_path(spark, "bronze-csv")
    orders = data.table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    orders.write.option("header", True).csv(path)
    text = readers.read_csv_text(spark, path, orders.columns)
    return text.groupBy("o_orderstatus").agg(
        row_count().alias("rows"), numeric.total(numeric.to_amount(F.col("o_totalprice"))).alias("total"), F.min("o_orderdate").alias("first_day")
    )


@query(
    "s02_typed_csv",
    "SELECT c_mktsegment, COUNT(*) AS rows, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance, MAX(c_custkey) AS last_key FROM customer GROUP BY 1",
)
def s02(spark, sf):
    path = scratch_path(spark, "typed-csv")
    people = data.table(spark, sf, "customer")
    people.write.option("header", True).csv(path)
    typed = readers.read_csv_typed(spark, path, people.schema)
    return typed.groupBy("c_mktsegment").agg(
        row_count().alias("rows"), numeric.total(numeric.money(F.col("c_acctbal"))).alias("balance"), F.max("c_custkey").alias("last_key")
    )


@query(
    "s03_unknown_csv",
    """SELECT 'event_id' AS column_name, 'numeric' AS inferred_type, COUNT(DISTINCT event_id) AS unique_count FROM events
       UNION ALL SELECT 'user_id', 'numeric', COUNT(DISTINCT user_id) FROM events UNION ALL SELECT 'event_type', 'string', COUNT(DISTINCT event_type) FROM events
       UNION ALL SELECT 'props', 'string', COUNT(DISTINCT props) FROM events""",
)
def s03(spark, sf):
    path = scratch_path(spark, "unknown-csv")
    data.table(spark, sf, "events").select("event_id", "user_id", "event_type", "props").write.option("header", True).csv(path)
    return profile(readers.read_csv_text(spark, path)).select("column_name", "inferred_type", "unique_count")


@query(
    "s04_damaged_csv",
    """SELECT 'good' AS kind, COUNT(*) AS lines, CAST(SUM(c_custkey) AS BIGINT) AS key_sum FROM customer
       UNION ALL SELECT kind, COUNT(*), NULL FROM (SELECT CASE c_nationkey WHEN 0 THEN 'conflict_start' WHEN 1 THEN 'conflict_middle' ELSE 'header' END AS kind
       FROM customer WHERE c_nationkey < 3) GROUP BY 1""",
)
def s04(spark, sf):
    path = scratch_path(spark, "damaged-csv")
    people = data.table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    line = F.concat_ws(",", "c_custkey", "c_nationkey", "c_acctbal")
    nation = F.col("c_nationkey")
    marker = F.when(nation == 0, "<<<<<<< HEAD").when(nation == 1, "=======").when(nation == 2, "c_custkey,c_nationkey,c_acctbal")
    people.select(F.explode(F.array_compact(F.array(marker, line))).alias("value")).write.text(path)
    full = StructType([*people.schema.fields]).add(readers.CORRUPT, "string")
    rows = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", readers.CORRUPT).csv(path)
    bad = F.col(readers.CORRUPT)
    kind = F.when(bad.isNull(), "good").when(bad.startswith("<<<<<<<"), "conflict_start").when(bad.startswith("======="), "conflict_middle").otherwise("header")
    return rows.groupBy(kind.alias("kind")).agg(
        row_count().alias("lines"), F.sum(F.when(bad.isNull(), F.col("c_custkey"))).alias("key_sum")
    )


PER_FILE = 10_000


@query(
    "s05_json_batches",
    f"""SELECT (SELECT COUNT(*) FROM customer) AS records, (SELECT CAST(SUM(c_custkey) AS BIGINT) FROM customer) AS key_sum,
        (SELECT COUNT(DISTINCT c_custkey // {PER_FILE}) FROM customer WHERE (c_custkey // {PER_FILE}) % 7 = 0) AS broken_files""",
)
def s05(spark, sf):
    """Arrays of a bounded number of records per file; some files come again, cut off at the end."""
    path = scratch_path(spark, "json-batches")
    rows = data.table(spark, sf, "customer")
    chunk = F.floor(F.col("c_custkey") / PER_FILE)
    arrays = rows.groupBy(chunk.alias("chunk")).agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("text"))
    whole = F.struct(F.lit("whole").alias("state"), F.col("text").alias("value"))
    cut = F.struct(F.lit("cut").alias("state"), F.expr("left(text, length(text) - 5)").alias("value"))
    files = arrays.select("chunk", F.inline(F.array_compact(F.array(whole, F.when(F.col("chunk") % 7 == 0, cut)))))
    files.write.partitionBy("chunk", "state").text(path)
    good, broken = readers.read_json_batches(spark, path, rows.schema)
    n_broken = broken.agg(row_count().alias("n")).scalar()
    return good.agg(row_count().alias("records"), F.sum("c_custkey").alias("key_sum")).withColumn("broken_files", n_broken)


@query(
    "s06_partition_scan",
    "SELECT o_orderstatus, COUNT(*) AS rows, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1",
)
def s06(spark, sf):
    path = scratch_path(spark, "by-year")
    writers.replace_partitions(data.table(spark, sf, "orders").withColumn("year", F.year("o_orderdate")), path, ["year"])
    return readers.read_partition(spark, path, "year", 1998).groupBy("o_orderstatus").agg(
        row_count().alias("rows"), numeric.total(numeric.money(F.col("o_totalprice"))).alias("total")
    )


@query("s07_table_folder", "SELECT l_returnflag, COUNT(*) AS rows FROM lineitem GROUP BY 1")
def s07(spark, sf):
    return readers.read_table(spark, f"{sf}/lineitem.parquet").groupBy("l_returnflag").agg(row_count().alias("rows"))


@query("s08_named_table", "SELECT p_brand, COUNT(*) AS parts, CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS price FROM part GROUP BY 1")
def s08(spark, sf):
    writers.materialise(data.table(spark, sf, "part"), "stg_part", "view")
    return spark.table("stg_part").groupBy("p_brand").agg(
        row_count().alias("parts"), numeric.total(numeric.money(F.col("p_retailprice"))).alias("price")
    )


@query(
    "s09_two_feeds",
    with_views(
        "txn txn_dirty",
        """SELECT feed, COUNT(*) AS rows, COUNT(amount) AS with_amount, COUNT(currency) AS with_currency FROM (
           SELECT 'clean' AS feed, CAST(amount AS VARCHAR) AS amount, NULL AS currency FROM txn UNION ALL SELECT 'dirty', amount, currency FROM txn_dirty) GROUP BY 1""",
    ),
)
def s09(spark, sf):
    from paylens.operators.sets import concat_feeds

    clean = data.transactions(spark, sf).select("transaction_id", F.col("amount").cast("string").alias("amount"))
    dirty = data.transactions_dirty(spark, sf).select("transaction_id", "amount", "currency")
    return concat_feeds({"clean": clean, "dirty": dirty}).groupBy("feed").agg(
        row_count().alias("rows"), F.count("amount").alias("with_amount"), F.count("currency").alias("with_currency")
    )


@query(
    "s10_ingestion_metadata",
    """SELECT 'events.parquet' AS source_file, 'run-1' AS pipeline_run_id, TIMESTAMP '2024-01-31 02:00:00' AS ingestion_timestamp, COUNT(*) AS rows FROM events""",
)
def s10(spark, sf):
    at = wall_clock("2024-01-31 02:00:00")
    stamped = readers.with_ingestion_metadata(data.table(spark, sf, "events"), "run-1", at)
    return stamped.groupBy("source_file", "pipeline_run_id", "ingestion_timestamp").agg(row_count().alias("rows"))


@query("s11_idempotent_partitions", "SELECT CAST(ts AS DATE) AS day, COUNT(*) AS rows, CAST(SUM(event_id) AS BIGINT) AS key_sum FROM events GROUP BY 1")
def s11(spark, sf):
    """The second run rewrites the later days; nothing doubles and the early days stay."""
    path = scratch_path(spark, "by-day")
    events = data.table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    writers.replace_partitions(events, path, ["day"])
    late = events.where(F.col("ts") >= wall_clock(data.EVENTS_HALF))
    writers.replace_partitions(late, path, ["day"])
    return spark.read.parquet(path).groupBy("day").agg(row_count().alias("rows"), F.sum("event_id").alias("key_sum"))


@query(
    "s12_hourly_json",
    "SELECT strftime(ts, '%Y-%m-%d') AS dt, CAST(EXTRACT(HOUR FROM ts) AS INTEGER) AS hour, COUNT(*) AS rows FROM events GROUP BY 1, 2",
)
def s12(spark, sf):
    path = scratch_path(spark, "hourly-json")
    writers.write_hourly_json(data.table(spark, sf, "events").select("event_id", "user_id", "value", "ts"), "ts", path)
    rows = spark.read.schema("event_id long, user_id long, value double, dt string, hour int").json(path)
    return rows.groupBy("dt", "hour").agg(row_count().alias("rows"))


BAD_ROW = "transaction_id IS NULL OR trim(transaction_id) = '' OR COALESCE(TRY_CAST(trim(amount) AS DOUBLE) < 0 OR TRY_CAST(trim(amount) AS DOUBLE) > 1000000, TRUE)"


@query(
    "s13_quarantine_sink",
    with_views(
        "txn_dirty",
        f"""SELECT CASE WHEN transaction_id IS NULL OR trim(transaction_id) = '' THEN 'not_null:transaction_id' ELSE 'between:amount' END AS quarantine_reason,
            'bronze/feed' AS quarantine_source, DATE '2024-01-31' AS quarantine_date, COUNT(*) AS rows, CAST(SUM(k) AS BIGINT) AS key_sum
            FROM txn_dirty WHERE {BAD_ROW} GROUP BY 1""",
    ),
)
def s13(spark, sf):
    path = scratch_path(spark, "quarantine")
    checks = [Check("not_null", "transaction_id"), Check("between", "amount", low=0, high=1000000)]
    reason = F.coalesce(*[F.when(failing(c), c.label) for c in checks])
    bad = data.transactions_dirty(spark, sf).where(reason.isNotNull())
    at = wall_clock("2024-01-31 02:00:00")
    for _ in range(2):
        writers.quarantine(bad, reason, "bronze/feed", at, path, "run-1")
    return spark.read.parquet(path).groupBy("quarantine_reason", "quarantine_source", "quarantine_date").agg(
        row_count().alias("rows"), F.sum("k").alias("key_sum")
    )


@query(
    "s14_insert_only_merge",
    """SELECT 'first' AS load, (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'F') AS rows_attempted, (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'F') AS rows_loaded, 0 AS rows_skipped
       UNION ALL SELECT 'second', (SELECT COUNT(*) FROM orders), (SELECT COUNT(*) FROM orders WHERE o_orderstatus <> 'F'), (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'F')
       UNION ALL SELECT 'again', (SELECT COUNT(*) FROM orders), 0, (SELECT COUNT(*) FROM orders)""",
)
def s14(spark, sf):
    path = scratch_path(spark, "merge-target")
    orders = data.table(spark, sf, "orders")
    out = None
    for name, rows in (("first", orders.where("o_orderstatus = 'F'")), ("second", orders), ("again", orders)):
        counts = writers.merge_insert(spark, rows, path, "o_orderkey", [F.desc("o_orderdate"), F.asc("o_totalprice")], name)
        counts = counts.select(F.lit(name).alias("load"), "rows_attempted", "rows_loaded", "rows_skipped")
        out = counts if out is None else out.unionByName(counts)
    return out


@query(
    "s15_insert_or_ignore",
    with_views("txn_raw", "SELECT COUNT(*) AS rows_attempted, COUNT(DISTINCT transaction_id) AS rows_loaded, COUNT(CASE WHEN trim(transaction_id) = '' THEN 1 END) AS rows_rejected, COUNT(*) - COUNT(DISTINCT transaction_id) AS rows_skipped FROM txn_raw"),
)
def s15(spark, sf):
    path = scratch_path(spark, "ignore-target")
    rows = data.transactions_raw(spark, sf).select("transaction_id", "amount", "status", "ingestion_timestamp")
    order = [F.desc("ingestion_timestamp"), F.asc("amount"), F.asc("status")]
    return writers.merge_insert(spark, rows, path, "transaction_id", order, "only")


@query(
    "s17_materialise_models",
    """SELECT p_type, COUNT(*) AS parts, CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS price FROM part GROUP BY 1""",
)
def s17(spark, sf):
    staging = writers.materialise(data.table(spark, sf, "part").select("p_partkey", "p_type", "p_retailprice"), "stg_parts", "view")
    mart = staging.groupBy("p_type").agg(row_count().alias("parts"), numeric.total(numeric.money(F.col("p_retailprice"))).alias("price"))
    return writers.materialise(mart, "mart_parts", "table", scratch_path(spark, "mart"))


@query(
    "s18_partner_feeds",
    with_views(
        "txn dim_merchant",
        """SELECT CASE category WHEN 'Travel' THEN 'partner-a' WHEN 'Grocery' THEN 'partner-b' ELSE 'partner-c' END AS partner_id, COUNT(*) AS rows,
           COUNT(DISTINCT sha256(customer_id)) AS customers, MIN(sha256(customer_id)) AS first_hash FROM txn t JOIN dim_merchant m ON t.merchant_id = m.merchant_id
           WHERE category IN ('Travel', 'Grocery', 'E-Commerce') GROUP BY 1""",
    ),
)
def s18(spark, sf):
    path = scratch_path(spark, "partners")
    partner = F.when(F.col("category") == "Travel", "partner-a").when(F.col("category") == "Grocery", "partner-b").when(
        F.col("category") == "E-Commerce", "partner-c"
    )
    rows = data.transactions(spark, sf).join(data.merchants(spark, sf).select("merchant_id", "category"), "merchant_id")
    writers.partner_feeds(rows.select("transaction_id", "customer_id", "merchant_id", "category", "amount", "status"), partner, "customer_id", path)
    return spark.read.parquet(path).groupBy("partner_id").agg(
        row_count().alias("rows"), F.count_distinct("customer_id").alias("customers"), F.min("customer_id").alias("first_hash")
    )


@query(
    "s19_run_metadata",
    with_views(
        "txn_dirty",
        """SELECT 'run-1' AS run_id, 'SUCCESS' AS status, COUNT(*) AS rows_in, COUNT(CASE WHEN trim(transaction_id) <> '' THEN 1 END) AS rows_out FROM txn_dirty""",
    ),
)
def s19(spark, sf):
    """Rows in are counted on the source, rows out on the files that were written."""
    rows = data.transactions_dirty(spark, sf)
    out = scratch_path(spark, "run-output")
    rows.where(~is_blank(F.col("transaction_id"))).select("transaction_id", "amount", "k").write.parquet(out)
    facts = {"run_id": "run-1", "status": "SUCCESS", "rows_in": rows.count(), "rows_out": spark.read.parquet(out).count()}
    path = scratch_path(spark, "run-metadata")
    writers.write_run_metadata(spark, facts, path)
    return spark.read.schema("run_id string, status string, rows_in long, rows_out long").json(path)


@query(
    "s20_missing_source",
    """SELECT 'events' AS source, 'loaded' AS status, COUNT(*) AS rows FROM events UNION ALL SELECT 'refunds', 'source_missing', 0
       UNION ALL SELECT 'orders', 'loaded', COUNT(*) FROM orders""",
)
def s20(spark, sf):
    out = None
    for name in ("events", "refunds", "orders"):
        rows, status = readers.read_or_skip(spark, f"{sf.rstrip('/')}/{name}.parquet")
        counted = (rows if rows is not None else spark.range(0)).agg(row_count().alias("rows"))
        line = counted.select(F.lit(name).alias("source"), F.lit(status).alias("status"), "rows")
        out = line if out is None else out.unionByName(line)
    return out


@query(
    "s21_object_inventory",
    """SELECT 'day=' || strftime(ts, '%Y-%m-%d') AS folder, CAST(1 AS BIGINT) AS files, CAST(SUM(strlen(printf('%d,%s', event_id, event_type)) + 1) AS BIGINT) AS bytes
       FROM events GROUP BY 1""",
)
def s21(spark, sf):
    """Files and bytes below each day's folder; lines of known length make the bytes known."""
    path = scratch_path(spark, "inventory")
    line = F.concat_ws(",", "event_id", "event_type").alias("value")
    days = data.table(spark, sf, "events").select(line, F.col("ts").cast("date").alias("day"))
    days.repartition("day").write.partitionBy("day").text(path)
    stock = readers.folder_inventory(readers.list_objects(spark, path, "*.txt"))
    return stock.select(F.regexp_extract("folder", "([^/]+)$", 1).alias("folder"), "files", "bytes")


@query("s22_latest_object", "SELECT 'run=3' AS latest, COUNT(*) AS rows FROM orders WHERE o_orderstatus = 'P'")
def s22(spark, sf):
    """Three reports written one after another; the newest is found by its time and read."""
    path = scratch_path(spark, "reports")
    orders = data.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    for run, status in enumerate(["F", "O", "P"], start=1):
        orders.where(F.col("o_orderstatus") == status).write.parquet(f"{path}/run={run}")
    newest = readers.latest_object(readers.list_objects(spark, path, "*.parquet"))
    run = F.regexp_extract(newest.select("path").scalar(), "(run=[0-9]+)", 1)
    reports = spark.read.parquet(path).withColumn("latest", F.concat(F.lit("run="), F.col("run").cast("string")))
    return reports.where(F.col("latest") == run).groupBy("latest").agg(row_count().alias("rows"))
