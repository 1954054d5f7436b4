"""Personal data and governance."""

from __future__ import annotations

from pyspark.sql import functions as F

from paylens.operators import privacy
from paylens.operators.aggregates import row_count
from paylens.queries import data
from paylens.queries.registry import query
from paylens.queries.scalars import CONTACT, contacts
from paylens.queries.sets import drifted_feed
from paylens.queries.sqlbase import with_views

CONTACT_COLUMNS = ["phone", "email", "account", "pan"]


def rates_sql(columns, source):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, {j} AS o, '{kind}' AS pii_type, '{cat}' AS category, '{tier}' AS sensitivity,
            AVG(CASE WHEN regexp_matches(trim(CAST({c} AS VARCHAR)), '{p}') THEN 1.0 ELSE 0.0 END)::DOUBLE AS rate FROM {source} WHERE {c} IS NOT NULL"""
        for c in columns
        for j, (kind, p, cat, tier) in enumerate(privacy.PII_PATTERNS)
    )


HINT = (
    "CASE "
    + " ".join(f"WHEN contains(lower(column_name), '{part}') THEN '{kind}'" for part, kind in privacy.NAME_HINTS)
    + " END"
)


def findings_sql(columns, source):
    return f"""SELECT column_name, pii_type, category, sensitivity, CASE WHEN rate > 0.5 THEN 'high' ELSE 'medium' END AS confidence,
        ROUND(rate, 4) AS match_rate FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY
        CASE WHEN pii_type = {HINT} THEN 0 ELSE 1 END, o) AS rn FROM ({rates_sql(columns, source)}) WHERE rate > 0.2) WHERE rn = 1"""


@query("p01_detect_columns", findings_sql(CONTACT_COLUMNS, f"({CONTACT})"))
def p01(spark, sf):
    return privacy.detect(contacts(spark, sf), CONTACT_COLUMNS)


@query(
    "p02_dataset_tier",
    f"""SELECT COUNT(*) AS pii_columns, CASE MAX(w) WHEN 3 THEN 'Restricted' WHEN 2 THEN 'Confidential' WHEN 1 THEN 'Internal' ELSE 'Public' END AS dataset_tier,
        CASE MAX(w) WHEN 3 THEN 'BLOCK load until PII masked' WHEN 2 THEN 'Mask PII before load' WHEN 1 THEN 'Internal systems only' ELSE 'No restrictions' END AS load_restriction
        FROM (SELECT CASE sensitivity WHEN 'Restricted' THEN 3 WHEN 'Confidential' THEN 2 WHEN 'Internal' THEN 1 ELSE 0 END AS w FROM ({findings_sql(CONTACT_COLUMNS, f"({CONTACT})")}))""",
)
def p02(spark, sf):
    return privacy.dataset_tier(privacy.detect(contacts(spark, sf), CONTACT_COLUMNS))


@query(
    "p03_masking_plan",
    f"""SELECT c_custkey, repeat('X', length(phone) - 4) || right(phone, 4) AS phone,
        substr(sha256(split_part(email, '@', 1)), 1, 12) || '@' || split_part(email, '@', 2) AS email,
        'tok_' || substr(sha256('vault' || account), 1, 16) AS account,
        regexp_replace(regexp_replace(pan, '[A-Z]', 'A', 'g'), '[0-9]', '9', 'g') AS pan FROM ({CONTACT})""",
)
def p03(spark, sf):
    people = contacts(spark, sf)
    plan = privacy.masking_plan(privacy.detect(people, CONTACT_COLUMNS))
    return privacy.apply_masks(people, plan, "c_custkey", "vault")


def redact_sql(text):
    for pattern, mark in privacy.REDACTIONS:
        text = f"regexp_replace({text}, '{pattern}', '{mark}', 'g')"
    return text


@query(
    "p04_redact_text",
    f"SELECT doc_id, md5({redact_sql('text')}) AS text_hash, length({redact_sql('text')}) AS n, {redact_sql('text')} <> text AS changed FROM documents",
)
def p04(spark, sf):
    clean = data.table(spark, sf, "documents").select("doc_id", "text", privacy.redact(F.col("text")).alias("clean"))
    return clean.select(
        "doc_id", F.md5("clean").alias("text_hash"), F.length("clean").cast("long").alias("n"), (F.col("clean") != F.col("text")).alias("changed")
    )


@query(
    "p05_destructive_statements",
    """SELECT event_type, COUNT(*) AS statements, COUNT(CASE WHEN regexp_matches(upper(s), '(^|[^A-Z0-9_])(DROP|DELETE|INSERT|UPDATE|TRUNCATE|ALTER|CREATE)($|[^A-Z0-9_])')
       THEN 1 END) AS destructive FROM (SELECT event_type, CASE event_type WHEN 'error' THEN 'drop table t' || event_id WHEN 'signup' THEN 'select dropped from t'
       WHEN 'view' THEN 'x; Truncate t' ELSE 'select 1' END AS s FROM events) GROUP BY 1""",
)
def p05(spark, sf):
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.concat(F.lit("drop table t"), F.col("event_id").cast("string")))
        .when(kind == "signup", F.lit("select dropped from t"))
        .when(kind == "view", F.lit("x; Truncate t"))
        .otherwise(F.lit("select 1"))
    )
    return data.table(spark, sf, "events").groupBy("event_type").agg(
        row_count().alias("statements"), F.count_if(privacy.destructive(text)).alias("destructive")
    )


@query("p05b_destructive_in_documents", """SELECT lang, COUNT(CASE WHEN regexp_matches(upper(text), '(^|[^A-Z0-9_])(DROP|DELETE|INSERT|UPDATE|TRUNCATE|ALTER|CREATE)($|[^A-Z0-9_])')
   THEN 1 END) AS destructive, COUNT(*) AS docs FROM documents GROUP BY 1""")
def p05b(spark, sf):
    return data.table(spark, sf, "documents").groupBy("lang").agg(
        F.count_if(privacy.destructive(F.col("text"))).alias("destructive"), row_count().alias("docs")
    )


@query(
    "p06_leaked_columns",
    with_views(
        "txn_raw",
        findings_sql(["merchant_nm", "cust_ph", "risk_score"], "feed"),
        {
            "feed": """SELECT merchant_id AS merchant_nm, '+919' || lpad(customer_id, 9, '0') AS cust_ph, CAST(l_discount * 10 AS VARCHAR) AS risk_score FROM txn_raw"""
        },
    ),
)
def p06(spark, sf):
    feed = drifted_feed(spark, sf).withColumn("risk_score", F.col("risk_score").cast("string"))
    return privacy.new_sensitive_columns(feed, ["transaction_id", "amount", "merchant_id", "status"])


#: All columns of the given tables but vectors, numbers with decimals and times, which no pattern describes.
SURFACE_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"],
    "events": ["event_id", "user_id", "event_type", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}
SURFACE = " UNION ALL ".join(
    [f"""SELECT 'contacts' AS table_name, * FROM ({findings_sql(CONTACT_COLUMNS, f"({CONTACT})")})"""]
    + [f"SELECT '{name}' AS table_name, * FROM ({findings_sql(columns, name)})" for name, columns in SURFACE_COLUMNS.items()]
)


def pii_surface(spark, sf):
    given = {name: (data.table(spark, sf, name), columns) for name, columns in SURFACE_COLUMNS.items()}
    return privacy.surface({"contacts": (contacts(spark, sf), CONTACT_COLUMNS), **given})


@query("p07_surface_inventory", SURFACE)
def p07(spark, sf):
    return pii_surface(spark, sf)


@query(
    "a34_catalogue_summary",
    f"""SELECT CASE sensitivity WHEN 'Restricted' THEN 'CRITICAL' WHEN 'Confidential' THEN 'HIGH' WHEN 'Internal' THEN 'MEDIUM' ELSE 'LOW' END AS severity,
        COUNT(*) AS pii_columns, COUNT(DISTINCT table_name) AS tables FROM ({SURFACE}) GROUP BY 1""",
)
def a34(spark, sf):
    graded = pii_surface(spark, sf).withColumn("severity", privacy.severity_of(F.col("sensitivity")))
    per = graded.groupBy("severity").agg(row_count().alias("pii_columns"), F.count_distinct("table_name").alias("tables"))
    return per.orderBy(privacy.severity_rank(F.col("severity")))
