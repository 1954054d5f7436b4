"""Shared views of the comparison SQL, as common table expressions."""

from __future__ import annotations

VIEWS = {
    "txn_raw": """
SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount,
       CASE l.l_returnflag WHEN 'A' THEN 'COMPLETED' WHEN 'R' THEN 'FAILED' ELSE 'PENDING' END AS status,
       CAST(l.l_suppkey AS VARCHAR) AS merchant_id,
       CAST(o.o_custkey AS VARCHAR) AS customer_id,
       CAST(l.l_shipdate AS DATE) AS transaction_date,
       CASE WHEN o.o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'CREDIT_CARD'
            WHEN o.o_orderpriority = '3-MEDIUM' THEN 'DEBIT_CARD' ELSE 'UPI' END AS payment_method,
       l.l_orderkey * 10 + l.l_linenumber AS k,
       l.l_shipdate AS ingestion_timestamp, l.l_partkey, l.l_suppkey, l.l_extendedprice,
       l.l_quantity, l.l_discount, l.l_tax, l.l_returnflag
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "txn": """
SELECT * FROM (SELECT r.*, ROW_NUMBER() OVER (PARTITION BY transaction_id
   ORDER BY ingestion_timestamp DESC, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax,
            l_returnflag) AS rn
   FROM txn_raw r) q WHERE rn = 1""",
    "dim_merchant": """
SELECT CAST(s.s_suppkey AS VARCHAR) AS merchant_id, s.s_name AS merchant_name,
       CASE s.s_nationkey % 5 WHEN 0 THEN 'Food Delivery' WHEN 1 THEN 'E-Commerce' WHEN 2 THEN 'Entertainment'
            WHEN 3 THEN 'Travel' ELSE 'Grocery' END AS category, n.n_name AS city
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "dim_customer": """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
       CASE WHEN c_acctbal >= 6000 THEN 'GOLD' WHEN c_acctbal >= 2000 THEN 'SILVER' ELSE 'BRONZE' END AS tier,
       c_nationkey, c_mktsegment, c_acctbal
FROM customer""",
    "txn_dirty": """
SELECT k,
       CASE WHEN k % 23 = 0 THEN '' WHEN k % 23 = 1 THEN NULL ELSE transaction_id END AS transaction_id,
       CASE WHEN k % 29 = 0 THEN '' WHEN k % 29 = 1 THEN '-' || CAST(amount AS VARCHAR)
            WHEN k % 29 = 2 THEN 'abc' ELSE CAST(amount AS VARCHAR) END AS amount,
       CASE WHEN k % 31 = 0 THEN '99-99-9999'
            WHEN k % 31 = 1 THEN substr(CAST(transaction_date AS VARCHAR),9,2) || '-'
                 || substr(CAST(transaction_date AS VARCHAR),6,2) || '-' || substr(CAST(transaction_date AS VARCHAR),1,4)
            ELSE CAST(transaction_date AS VARCHAR) END AS transaction_date,
       CASE WHEN k % 37 = 0 THEN 'XYZ' ELSE 'INR' END AS currency,
       CASE WHEN k % 41 = 0 THEN 'MXXX' ELSE merchant_id END AS merchant_id,
       CASE WHEN k % 43 = 0 THEN '  ' || status || ' ' ELSE status END AS status,
       customer_id, payment_method, ingestion_timestamp
FROM txn_raw""",
    "bronze": """
SELECT transaction_id, amount, status,
       CASE WHEN k % 41 = 0 THEN 'MXXX' ELSE merchant_id END AS merchant_id,
       customer_id, transaction_date, payment_method, k, ingestion_timestamp
FROM txn""",
    "silver": """
SELECT b.transaction_id, b.amount, b.status, b.merchant_id, b.customer_id, b.transaction_date, b.payment_method,
       b.k, b.ingestion_timestamp, m.merchant_name, m.category, m.city,
       CASE WHEN m.merchant_id IS NULL THEN 'UNMATCHED' ELSE 'CLEAN' END AS quality_flag
FROM bronze b LEFT JOIN dim_merchant m ON b.merchant_id = m.merchant_id
WHERE b.transaction_id IS NOT NULL AND b.amount >= 0""",
    "staged": "SELECT * FROM txn WHERE transaction_id IS NOT NULL AND amount > 0",
    "gmv": """
SELECT t.transaction_date, t.merchant_id, m.merchant_name, m.category,
       COUNT(t.transaction_id) AS transaction_count,
       CAST(SUM(CASE WHEN t.status = 'COMPLETED' THEN t.amount ELSE 0 END) AS DOUBLE) AS gmv,
       CAST(SUM(CASE WHEN t.status = 'FAILED' THEN t.amount ELSE 0 END) AS DOUBLE) AS failed_amount,
       COUNT(CASE WHEN t.status = 'FAILED' THEN 1 END) AS failed_count,
       ROUND(CAST(100 AS DOUBLE) * COUNT(CASE WHEN t.status = 'FAILED' THEN 1 END) / COUNT(t.transaction_id), 2)
         AS failure_rate_pct
FROM staged t JOIN dim_merchant m ON t.merchant_id = m.merchant_id GROUP BY ALL""",
}
NEEDS = {
    "txn": ["txn_raw"],
    "txn_dirty": ["txn_raw"],
    "bronze": ["txn"],
    "silver": ["bronze", "dim_merchant"],
    "staged": ["txn"],
    "gmv": ["staged", "dim_merchant"],
}
AS_OF = "DATE '2001-11-05'"

#: Why a repaired record of a feed (with merchant names a and b) cannot be loaded; blank if it can.
REASON = """CASE WHEN transaction_id IS NULL OR trim(transaction_id) = '' THEN 'null_transaction_id' WHEN COALESCE(a, b) IS NULL THEN 'null_merchant_name'
   WHEN amount IS NULL OR trim(amount) = '' OR TRY_CAST(trim(amount) AS DOUBLE) <= 0 THEN 'zero_or_negative_amount'
   WHEN TRY_CAST(trim(amount) AS DOUBLE) IS NULL OR NOT isfinite(TRY_CAST(trim(amount) AS DOUBLE)) THEN 'invalid_amount'
   WHEN TRY_CAST(CASE WHEN regexp_matches(transaction_date, '^[0-9][0-9]-[0-9][0-9]-[0-9][0-9][0-9][0-9]$') THEN
     substr(transaction_date, 7, 4) || '-' || substr(transaction_date, 4, 2) || '-' || substr(transaction_date, 1, 2) ELSE transaction_date END AS DATE) IS NULL
   THEN 'invalid_date' ELSE '' END"""

REVENUE = "CAST(SUM(CASE WHEN status = 'COMPLETED' THEN amount ELSE 0 END) AS DOUBLE)"
N_FAILED = "COUNT(CASE WHEN status = 'FAILED' THEN 1 END)"
N_COMPLETED = "COUNT(CASE WHEN status = 'COMPLETED' THEN 1 END)"


def pct(num: str, den: str, digits: int = 2) -> str:
    return f"ROUND(CAST(100 AS DOUBLE) * {num} / NULLIF({den}, 0), {digits})"


def with_views(names: str, body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with the named views, and those they need, in front of it."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in names.split():
        add(name)
    parts = [f"{n} AS ({VIEWS[n].strip()})" for n in wanted]
    parts += [f"{n} AS ({text.strip()})" for n, text in (extra or {}).items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()
