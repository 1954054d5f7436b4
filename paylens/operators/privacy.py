"""Personal data: detection, tiers, masking, redaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions import masking

# Kind, whole-value pattern, category, sensitivity; and their order.
PII_PATTERNS = [
    ("pan_number", r"^[A-Z]{5}[0-9]{4}[A-Z]$", "Financial ID", "Restricted"),
    ("aadhaar_number", r"^[0-9]{4}\s?[0-9]{4}\s?[0-9]{4}$", "Government ID", "Restricted"),
    ("phone_number", r"^(\+91)?[7-9][0-9]{9}$", "Contact", "Confidential"),
    ("email_address", r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$", "Contact", "Confidential"),
    ("account_number", r"^[0-9]{9,18}$", "Financial ID", "Restricted"),
    ("credit_card", r"^[0-9]{4}[\s\-]?[0-9]{4}[\s\-]?[0-9]{4}[\s\-]?[0-9]{4}$", "Financial ID", "Restricted"),
    ("full_name", r"^[A-Z][a-z]+ [A-Z][a-z]+$", "Identity", "Confidential"),
    ("ip_address", r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$", "Technical", "Internal"),
]
# Tiers from open to strict, match rates of the confidences, restrictions by tier.
TIERS = ["Public", "Internal", "Confidential", "Restricted"]
HIGH_RATE, MEDIUM_RATE = 0.5, 0.2
LOAD_RESTRICTION = {
    "Public": "No restrictions",
    "Internal": "Internal systems only",
    "Confidential": "Mask PII before load",
    "Restricted": "BLOCK load until PII masked",
}
# Parts of column names, and the kind they speak of.
NAME_HINTS = [
    ("pan", "pan_number"), ("aadhaar", "aadhaar_number"), ("phone", "phone_number"), ("mobile", "phone_number"),
    ("_ph", "phone_number"), ("email", "email_address"), ("account", "account_number"), ("acct", "account_number"),
    ("card", "credit_card"), ("full_name", "full_name"),
]
# What is taken out of free text, in this order.
REDACTIONS = [
    (r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}", "[EMAIL]"),
    (r"[0-9]{4}[ \-]?[0-9]{4}[ \-]?[0-9]{4}[ \-]?[0-9]{4}", "[CARD]"),
    (r"(?:\+91)?[7-9][0-9]{9}", "[PHONE]"),
]
# Words that change data.
DESTRUCTIVE_WORDS = ["DROP", "DELETE", "INSERT", "UPDATE", "TRUNCATE", "ALTER", "CREATE"]


def match_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of non-null values of each column that match each pattern whole.

    One aggregate over all rows; the wide result is then unpivoted.
    """
    aggs = []
    for i, column in enumerate(columns):
        text = F.trim(F.col(column).cast("string"))
        aggs += [F.avg(text.rlike(p).cast("double")).alias(f"m{i}_{j}") for j, (_, p, _, _) in enumerate(PII_PATTERNS)]
    cells = [
        F.struct(
            F.lit(column).alias("column_name"), F.lit(j).alias("pattern_order"), F.lit(kind).alias("pii_type"),
            F.lit(category).alias("category"), F.lit(tier).alias("sensitivity"),
            F.coalesce(F.col(f"m{i}_{j}"), F.lit(0.0)).alias("match_rate"),
        )
        for i, column in enumerate(columns)
        for j, (kind, _, category, tier) in enumerate(PII_PATTERNS)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def hinted_type(column: Column) -> Column:
    """Kind of data a column name speaks of, null if none."""
    name = F.lower(column)
    return F.coalesce(*[F.when(F.contains(name, F.lit(part)), F.lit(kind)) for part, kind in NAME_HINTS])


def detect(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Personal-data columns with type and confidence.

    A column name that speaks of one of the matching types decides between patterns
    that overlap (an account number also looks like a national id); else the first
    pattern in order does. Every row is looked at.
    """
    rates = match_rates(df, columns).where(F.col("match_rate") > MEDIUM_RATE)
    hinted = (F.col("pii_type") == hinted_type(F.col("column_name"))).cast("int")
    best = F.min(
        F.struct(
            -F.coalesce(hinted, F.lit(0)), F.col("pattern_order"), F.col("pii_type"), F.col("category"),
            F.col("sensitivity"), F.col("match_rate"),
        )
    ).alias("b")
    found = rates.groupBy("column_name").agg(best)
    return found.select(
        "column_name", "b.pii_type", "b.category", "b.sensitivity",
        F.when(F.col("b.match_rate") > HIGH_RATE, "high").otherwise("medium").alias("confidence"),
        F.round("b.match_rate", 4).alias("match_rate"),
    )


def tier_order(tier: Column) -> Column:
    return F.coalesce(*[F.when(tier == name, i) for i, name in enumerate(TIERS)])


def dataset_tier(findings: DataFrame) -> DataFrame:
    """The strictest tier of all findings and what it restricts."""
    worst = F.coalesce(F.max(tier_order(F.col("sensitivity"))), F.lit(0))
    tier = F.element_at(F.array(*[F.lit(t) for t in TIERS]), F.col("worst") + 1)
    rule = F.element_at(F.array(*[F.lit(LOAD_RESTRICTION[t]) for t in TIERS]), F.col("worst") + 1)
    return findings.agg(F.count(F.lit(1)).alias("pii_columns"), worst.alias("worst")).select(
        "pii_columns", tier.alias("dataset_tier"), rule.alias("load_restriction")
    )


def mask(kind: str, value: Column, entity_id: Column, salt: str) -> Column:
    """The mask for one kind of personal data; ``salt`` is the secret of the tokens."""
    if kind in ("aadhaar_number", "phone_number"):
        return masking.last_four(value)
    if kind == "email_address":
        return masking.hashed_mailbox(value)
    if kind == "full_name":
        return masking.pseudonym(entity_id)
    if kind in ("account_number", "credit_card"):
        return masking.token(value, salt)
    if kind == "pan_number":
        return masking.shape_token(value)
    return masking.hash_id(value)


def apply_masks(df: DataFrame, plan: dict[str, str], entity: str, salt: str) -> DataFrame:
    """Mask the columns of ``plan`` (column to kind) in one projection."""
    return df.withColumns({c: mask(kind, F.col(c), F.col(entity), salt) for c, kind in plan.items()})


def masking_plan(findings: DataFrame) -> dict[str, str]:
    """Column to kind, from findings; as many rows as the table has columns."""
    return {r["column_name"]: r["pii_type"] for r in findings.select("column_name", "pii_type").collect()}


def redact(text: Column) -> Column:
    for pattern, mark in REDACTIONS:
        text = F.regexp_replace(text, pattern, mark)
    return text


def destructive(text: Column) -> Column:
    """Whether a text holds a statement that changes or removes data.

    The plain search comes first: most texts hold none of the words, and the pattern,
    which asks for whole words, is slower by far.
    """
    upper = F.upper(text)
    holds = F.lit(False)
    for word in DESTRUCTIVE_WORDS:
        holds = holds | F.contains(upper, F.lit(word))
    words = "|".join(DESTRUCTIVE_WORDS)
    return F.when(holds, upper.rlike(rf"(^|[^A-Z0-9_])({words})($|[^A-Z0-9_])")).when(text.isNotNull(), False)


def guard_status(sql: Column, known_tables: Sequence[str]) -> Column:
    """First rule a logged statement breaks, ``ok`` if none."""
    upper = F.upper(F.trim(sql))
    known = F.lit(False)
    for name in known_tables:
        known = known | F.contains(upper, F.lit(name.upper()))
    return (
        F.when(F.coalesce(upper, F.lit("")) == "", "empty")
        .when(~F.startswith(upper, F.lit("SELECT")), "not_select")
        .when(destructive(upper), "forbidden_keyword")
        .when(~known, "unknown_table")
        .when(~F.contains(upper, F.lit(" WHERE ")), "full_scan")
        .otherwise("ok")
    )


def surface(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Findings of several tables under each other."""
    out = None
    for name, (df, columns) in tables.items():
        found = detect(df, columns).withColumn("table_name", F.lit(name))
        out = found if out is None else out.unionByName(found)
    return out


def severity_of(tier: Column) -> Column:
    return (
        F.when(tier == "Restricted", "CRITICAL").when(tier == "Confidential", "HIGH").when(tier == "Internal", "MEDIUM")
        .otherwise("LOW")
    )


def severity_rank(severity: Column) -> Column:
    return F.when(severity == "CRITICAL", 0).when(severity == "HIGH", 1).when(severity == "MEDIUM", 2).otherwise(3)


def new_sensitive_columns(df: DataFrame, contract_columns: Sequence[str]) -> DataFrame:
    """Personal-data findings among columns the contract does not name."""
    extra = [c for c in df.columns if c not in contract_columns]
    return detect(df, extra)
