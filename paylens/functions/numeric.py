"""Money, rates, tiers and numeric coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spend and revenue bands, fee rates, limits.
MERCHANT_TIERS = [(1000000, "PLATINUM"), (500000, "GOLD"), (100000, "SILVER")]
MERCHANT_TIER_FLOOR = "BRONZE"
COMPLIANCE_LIMIT = 50000
FEE_RATES = {"CREDIT_CARD": 0.02, "DEBIT_CARD": 0.015, "UPI": 0.0}


def money(value: Column) -> Column:
    """Exact decimal for summing; parquet amounts arrive as doubles."""
    return value.cast("decimal(18,2)")


def total(value: Column) -> Column:
    """Exact sum, given out as a double."""
    return F.sum(value).cast("double")


def when_sum(condition: Column, value: Column) -> Column:
    """Sum of ``value`` where ``condition`` holds, 0 where it never does."""
    zero = F.lit(0).cast("decimal(18,2)")
    return F.sum(F.when(condition, value).otherwise(zero)).cast("double")


def count_when(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def ratio(num: Column, den: Column) -> Column:
    """Division that gives null for a zero denominator (ANSI mode raises)."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    return F.round(F.lit(100.0) * num / F.nullif(den.cast("double"), F.lit(0.0)), digits)


def mean_of(value_sum: Column, n: Column) -> Column:
    """Mean from an exact sum; left unrounded."""
    return ratio(value_sum, n)


def to_number(text: Column) -> Column:
    """Numeric coercion: anything unparsable, blanks included, is null."""
    return F.trim(text).try_cast("double")


def to_amount(text: Column) -> Column:
    return F.trim(text).try_cast("decimal(18,2)")


def merchant_tier(revenue: Column) -> Column:
    bands = F
    for floor, label in MERCHANT_TIERS:
        bands = bands.when(revenue >= floor, F.lit(label))
    return bands.otherwise(MERCHANT_TIER_FLOOR)


def spend_segment(spent: Column) -> Column:
    """VIP above 5000, High from 1000, Mid from 200, Low below."""
    return (
        F.when(spent > 5000, "VIP").when(spent >= 1000, "High").when(spent >= 200, "Mid").otherwise("Low")
    )


def compliance_flag(amount: Column) -> Column:
    return F.when(amount > COMPLIANCE_LIMIT, "requires_review").otherwise("ok")


def fee_rate(method: Column) -> Column:
    """Rate by payment method; null for a method without a rate."""
    rates = F
    for name, rate in FEE_RATES.items():
        rates = rates.when(method == name, F.lit(rate))
    return rates
