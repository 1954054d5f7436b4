"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from paylens.functions import dates, masking, numeric
from paylens.functions import text as txt
from paylens.operators.aggregates import the_amount, row_count
from paylens.queries import data
from paylens.queries.registry import query
from paylens.queries.sqlbase import AS_OF, with_views


@query(
    "e01_case_and_trim",
    with_views(
        "txn_dirty",
        "SELECT upper(trim(status)) AS status, lower(trim(payment_method)) AS method, COUNT(*) AS rows FROM txn_dirty GROUP BY 1, 2",
    ),
)
def e01(spark, sf):
    clean = txt.trim_strings(data.transactions_dirty(spark, sf))
    return clean.groupBy(F.upper("status").alias("status"), F.lower("payment_method").alias("method")).agg(row_count().alias("rows"))


@query("e02_substring_concat", "SELECT c_custkey, substr(c_name, 1, 8) || '/' || c_mktsegment AS code FROM customer")
def e02(spark, sf):
    code = F.concat(F.substring("c_name", 1, 8), F.lit("/"), F.col("c_mktsegment"))
    return data.table(spark, sf, "customer").select("c_custkey", code.alias("code"))


@query(
    "e03_prefix_match",
    """SELECT lang, COUNT(CASE WHEN regexp_matches(text, '^(?:[A-Z][a-z]+ [a-z]+)') THEN 1 END) AS matched, COUNT(*) AS docs
       FROM documents GROUP BY 1""",
)
def e03(spark, sf):
    hit = txt.matches_from_start(F.col("text"), "[A-Z][a-z]+ [a-z]+")
    return data.table(spark, sf, "documents").groupBy("lang").agg(numeric.count_when(hit).alias("matched"), row_count().alias("docs"))


@query(
    "e04_regex_extract",
    """SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title,
       regexp_extract(url, '^(https?)://', 1) AS scheme FROM pages""",
)
def e04(spark, sf):
    return data.table(spark, sf, "pages").select(
        "page_id",
        F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("url", "^(https?)://", 1).alias("scheme"),
    )


@query("e05_sha256", "SELECT c_custkey, sha256(c_name) AS name_hash FROM customer")
def e05(spark, sf):
    return data.table(spark, sf, "customer").select("c_custkey", masking.hash_id(F.col("c_name")).alias("name_hash"))


@query("e06_fingerprint", "SELECT doc_id, substr(md5(text), 1, 12) AS print FROM documents")
def e06(spark, sf):
    return data.table(spark, sf, "documents").select("doc_id", txt.fingerprint(F.col("text")).alias("print"))


@query(
    "e07_casts",
    with_views(
        "txn_dirty",
        """SELECT COUNT(TRY_CAST(trim(amount) AS DOUBLE)) AS doubles, COUNT(TRY_CAST(trim(amount) AS DECIMAL(10,2))) AS decimals,
           COUNT(TRY_CAST(customer_id AS BIGINT)) AS ids, CAST(MAX(TRY_CAST(trim(amount) AS DECIMAL(10,2))) AS DOUBLE) AS largest FROM txn_dirty""",
    ),
)
def e07(spark, sf):
    text = F.trim(the_amount())
    return data.transactions_dirty(spark, sf).agg(
        F.count(text.try_cast("double")).alias("doubles"), F.count(text.try_cast("decimal(10,2)")).alias("decimals"),
        F.count(F.col("customer_id").try_cast("long")).alias("ids"), F.max(text.try_cast("decimal(10,2)")).cast("double").alias("largest"),
    )


@query(
    "e08_truncation",
    """SELECT CAST(ts AS DATE) AS day, date_trunc('hour', ts) AS hour, CAST(date_trunc('month', ts) AS DATE) AS month,
       CAST(date_trunc('year', ts) AS DATE) AS year, COUNT(*) AS n FROM events GROUP BY 1, 2, 3, 4""",
)
def e08(spark, sf):
    ts = F.col("ts")
    return data.table(spark, sf, "events").groupBy(
        ts.cast("date").alias("day"), F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour"),
        F.date_trunc("month", ts).cast("date").alias("month"), F.date_trunc("year", ts).cast("date").alias("year"),
    ).agg(row_count().alias("n"))


@query(
    "e09_boundary_differences",
    """SELECT l_orderkey, l_linenumber, l_partkey, DATE_DIFF('day', o_orderdate, l_shipdate) AS days, DATE_DIFF('minute', o_orderdate, l_shipdate)
       AS minutes, CAST(DATE_DIFF('year', o_orderdate, l_shipdate) AS INTEGER) AS years FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)
def e09(spark, sf):
    start, end = F.col("o_orderdate"), F.col("l_shipdate")
    lines = data.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    orders = data.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return lines.join(orders, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.datediff(end, start).cast("long").alias("days"),
        dates.minutes_between(start, end).alias("minutes"), dates.years_between(start, end).alias("years"),
    )


@query("e10_hour", "SELECT CAST(EXTRACT(HOUR FROM ts) AS INTEGER) AS hour, COUNT(*) AS n FROM events GROUP BY 1")
def e10(spark, sf):
    return data.table(spark, sf, "events").groupBy(F.hour("ts").alias("hour")).agg(row_count().alias("n"))


@query(
    "e11_date_arithmetic",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) - 30 AS month_ago, CAST(o_orderdate AS DATE) + 7 AS next_week,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month FROM orders""",
)
def e11(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return data.table(spark, sf, "orders").select(
        "o_orderkey", F.date_sub(day, 30).alias("month_ago"), F.date_add(day, 7).alias("next_week"), F.add_months(day, 1).alias("next_month")
    )


@query("e12_format_timestamp", "SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS label FROM events")
def e12(spark, sf):
    return data.table(spark, sf, "events").select("event_id", dates.hour_label(F.col("ts")).alias("label"))


@query(
    "e13_strict_dates",
    with_views(
        "txn_dirty",
        r"""SELECT CASE WHEN transaction_date IS NOT NULL AND (NOT regexp_matches(transaction_date, '^\d{4}-\d{2}-\d{2}$')
           OR TRY_CAST(transaction_date AS DATE) IS NULL) THEN 'INVALID_DATE' ELSE transaction_date END AS day, COUNT(*) AS rows
           FROM txn_dirty GROUP BY 1""",
    ),
)
def e13(spark, sf):
    return data.transactions_dirty(spark, sf).groupBy(dates.mark_bad_date(F.col("transaction_date")).alias("day")).agg(row_count().alias("rows"))


@query(
    "e14_date_repair",
    with_views(
        "txn_dirty",
        r"""SELECT CASE WHEN regexp_matches(transaction_date, '^\d{2}-\d{2}-\d{4}$') THEN
           substr(transaction_date, 7, 4) || '-' || substr(transaction_date, 4, 2) || '-' || substr(transaction_date, 1, 2)
           ELSE transaction_date END AS day, COUNT(*) AS rows FROM txn_dirty GROUP BY 1""",
    ),
)
def e14(spark, sf):
    fixed = dates.iso_from_day_first(F.col("transaction_date"))
    return data.transactions_dirty(spark, sf).groupBy(fixed.alias("day")).agg(row_count().alias("rows"))


@query(
    "e15_field_rename_repair",
    with_views(
        "txn dim_merchant",
        """SELECT merchant_name, COUNT(*) AS rows FROM (SELECT CASE WHEN k % 2 = 0 THEN m.merchant_name END AS a,
           CASE WHEN k % 2 = 1 THEN m.merchant_name END AS b, COALESCE(a, b) AS merchant_name FROM txn t
           JOIN dim_merchant m ON t.merchant_id = m.merchant_id) GROUP BY 1""",
    ),
)
def e15(spark, sf):
    per = data.transactions(spark, sf).groupBy("merchant_id", (F.col("k") % 2).alias("side")).agg(row_count().alias("n"))
    named = per.join(data.merchants(spark, sf), "merchant_id")
    feed = named.select(
        "n", F.when(F.col("side") == 0, F.col("merchant_name")).alias("merchant_name"),
        F.when(F.col("side") == 1, F.col("merchant_name")).alias("merchant_nm"),
    )
    fixed = feed.select("n", txt.first_present(feed, ["merchant_name", "merchant_nm"]).alias("merchant_name"))
    return fixed.groupBy("merchant_name").agg(F.sum("n").alias("rows"))


@query(
    "e16_round_and_percent",
    """SELECT l_suppkey, ROUND(CAST(100 AS DOUBLE) * COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) / NULLIF(COUNT(*), 0), 2) AS pct,
       ROUND(SUM(CAST(l_quantity AS DECIMAL(18,2))::DOUBLE) / COUNT(*), 2) AS avg_qty FROM lineitem GROUP BY 1""",
)
def e16(spark, sf):
    back = F.col("l_returnflag") == "R"
    return data.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        numeric.pct(numeric.count_when(back), row_count()).alias("pct"),
        F.round(numeric.ratio(numeric.total(numeric.money(F.col("l_quantity"))), row_count()), 2).alias("avg_qty"),
    )


@query(
    "e17_conditionals",
    """SELECT CASE WHEN value > 200 THEN 'large' WHEN value > 50 THEN 'medium' ELSE 'small' END AS size,
       COALESCE(NULLIF(event_type, 'error'), 'none') AS kind, COUNT(*) AS n FROM events GROUP BY 1, 2""",
)
def e17(spark, sf):
    size = F.when(F.col("value") > 200, "large").when(F.col("value") > 50, "medium").otherwise("small")
    kind = F.coalesce(F.nullif(F.col("event_type"), F.lit("error")), F.lit("none"))
    return data.table(spark, sf, "events").groupBy(size.alias("size"), kind.alias("kind")).agg(row_count().alias("n"))


@query(
    "e18_numeric_coercion",
    with_views(
        "txn_dirty",
        """SELECT status, COUNT(n) AS parsed, COUNT(*) - COUNT(n) AS unparsed, COUNT(CASE WHEN n < 0 THEN 1 END) AS negative
           FROM (SELECT status, TRY_CAST(trim(amount) AS DOUBLE) AS n FROM txn_dirty) GROUP BY 1""",
    ),
)
def e18(spark, sf):
    number = numeric.to_number(the_amount())
    return data.transactions_dirty(spark, sf).groupBy("status").agg(
        F.count(number).alias("parsed"), (row_count() - F.count(number)).alias("unparsed"), numeric.count_when(number < 0).alias("negative")
    )


@query("e19_json_path", "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, COUNT(*) AS n FROM events GROUP BY 1")
def e19(spark, sf):
    k = F.get_json_object("props", "$.k").try_cast("long")
    return data.table(spark, sf, "events").groupBy(k.alias("k")).agg(row_count().alias("n"))


# Contact fields of a customer, made from its key.
CONTACT = """SELECT c_custkey, '+919' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS phone,
   lower(replace(c_name, '#', '.')) || '@mail.example' AS email, lpad(CAST(c_custkey AS VARCHAR), 12, '5') AS account,
   'ABCDE' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || 'F' AS pan FROM customer"""


def contacts(spark, sf):
    key = F.col("c_custkey").cast("string")
    return data.table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit("+919"), F.lpad(key, 9, "0")).alias("phone"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@mail.example")).alias("email"),
        F.lpad(key, 12, "5").alias("account"),
        F.concat(F.lit("ABCDE"), F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0"), F.lit("F")).alias("pan"),
    )


@query(
    "e20_masks",
    f"""SELECT c_custkey, repeat('X', length(phone) - 4) || right(phone, 4) AS phone,
        substr(sha256(split_part(email, '@', 1)), 1, 12) || '@' || split_part(email, '@', 2) AS email,
        'tok_' || substr(sha256('vault' || account), 1, 16) AS account, regexp_replace(regexp_replace(pan, '[A-Z]', 'A', 'g'), '[0-9]', '9', 'g') AS pan,
        'Person-' || substr(sha256(CAST(c_custkey AS VARCHAR)), 1, 8) AS pseudonym FROM ({CONTACT})""",
)
def e20(spark, sf):
    return contacts(spark, sf).select(
        "c_custkey", masking.last_four(F.col("phone")).alias("phone"), masking.hashed_mailbox(F.col("email")).alias("email"),
        masking.token(F.col("account"), "vault").alias("account"), masking.shape_token(F.col("pan")).alias("pan"),
        masking.pseudonym(F.col("c_custkey")).alias("pseudonym"),
    )


@query(
    "e21_tenure",
    f"""SELECT o_custkey, CAST(DATE_DIFF('day', MIN(o_orderdate)::DATE, {AS_OF}) AS INTEGER) AS account_age_days,
        CAST(DATE_DIFF('year', MIN(o_orderdate)::DATE, {AS_OF}) AS INTEGER) AS account_age_years FROM orders GROUP BY 1""",
)
def e21(spark, sf):
    first = F.min("o_orderdate").cast("date")
    return data.table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.datediff(data.as_of(), first).alias("account_age_days"), dates.years_between(first, data.as_of()).alias("account_age_years")
    )
