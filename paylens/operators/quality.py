"""Declarative quality checks, profiling, fixes, quarantine and load decisions.

A suite is a list of ``Check``; it compiles to Column predicates, and one grouped
pass over the table evaluates all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions.dates import mark_bad_date, strict_date
from paylens.functions.numeric import to_number
from paylens.functions.text import blank_to_null, is_blank, matches_from_start, trim_strings
from paylens.operators.aggregates import row_count, exact_median
from paylens.operators.dedup import flag_duplicates, top_per_key

# The gates of load decisions.
REJECT_ABOVE_PCT = 20.0
ALERT_ABOVE_PCT = 10.0
NUMERIC_SHARE = 0.5


@dataclass(frozen=True)
class Check:
    """One expectation on a column, or on the table if ``kind`` starts with ``table``.

    ``nulls`` says whether a missing value fails the check or is skipped by it.
    """

    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    pattern: str | None = None
    severity: str = "high"
    nulls: str = "fail"

    @property
    def label(self) -> str:
        return f"{self.kind}:{self.column}" if self.column else self.kind


ROW_KINDS = {"not_null", "between", "in_set", "regex", "strict_date"}
TABLE_KINDS = {"row_count", "mean", "minimum"}


def failing(check: Check) -> Column:
    """True where a row fails ``check``; uniqueness is not a property of one row."""
    col = F.col(check.column).cast("string")
    if check.kind == "not_null":
        return is_blank(col)
    if check.kind == "between":
        number = to_number(col)
        bad = F.lit(False)
        if check.low is not None:
            bad = bad | (number < check.low)
        if check.high is not None:
            bad = bad | (number > check.high)
        bad = bad | number.isNull()
    elif check.kind == "in_set":
        bad = ~col.isin(*check.values)
    elif check.kind == "regex":
        bad = ~matches_from_start(col, check.pattern)
    elif check.kind == "strict_date":
        bad = strict_date(col).isNull()
    else:
        raise ValueError(f"no row predicate for {check.kind}")
    if check.nulls == "skip":
        return F.when(is_blank(col), False).otherwise(F.coalesce(bad, F.lit(True)))
    return F.coalesce(bad, F.lit(True))


def run_suite(df: DataFrame, suite: Sequence[Check]) -> DataFrame:
    """One row per check: failed rows, status and severity.

    The table is read once and grouped by the first unique key, with the row checks as
    partial sums beside the key's count; a second, tiny step adds the groups up. A
    further unique check takes one more grouped pass. A check whose column is missing
    reports ``error``.
    """
    present = [c for c in suite if c.column is None or c.column in df.columns]
    missing = [c for c in suite if c not in present]
    rows = [c for c in present if c.kind in ROW_KINDS]
    tables = [c for c in present if c.kind in TABLE_KINDS]
    uniques = [c for c in present if c.kind == "unique"]

    measures, finals = [], []
    for i, check in enumerate(rows):
        measures.append(F.sum(failing(check).cast("long")).alias(f"f{i}"))
        finals.append(F.coalesce(F.sum(f"f{i}"), F.lit(0)).cast("double").alias(f"v{i}"))
    for i, check in enumerate(tables):
        if check.kind == "row_count":
            continue
        number = to_number(F.col(check.column).cast("string"))
        measures += [F.sum(number).alias(f"s{i}"), F.count(number).alias(f"c{i}"), F.min(number).alias(f"m{i}")]
    measures.append(row_count().alias("n"))

    if uniques:
        grouped = df.groupBy(blank_to_null(F.col(uniques[0].column).cast("string")).alias("_key")).agg(*measures)
    else:
        grouped = df.agg(*measures)
    finals.append(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("rows"))
    for i, check in enumerate(tables):
        if check.kind == "mean":
            finals.append((F.sum(f"s{i}") / F.nullif(F.sum(f"c{i}").cast("double"), F.lit(0.0))).alias(f"t{i}"))
        elif check.kind == "minimum":
            finals.append(F.min(f"m{i}").alias(f"t{i}"))
        else:
            finals.append(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias(f"t{i}"))
    if uniques:
        finals.append(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("double").alias("u0"))
    wide = grouped.agg(*finals)

    out = [_row(c, F.col(f"v{i}"), F.col(f"v{i}") == 0) for i, c in enumerate(rows)]
    out += [_row(c, F.round(F.col(f"t{i}"), 4), _in_range(F.col(f"t{i}"), c)) for i, c in enumerate(tables)]
    if uniques:
        out.append(_row(uniques[0], F.col("u0"), F.col("u0") == 0))
    out += [
        F.struct(
            F.lit(c.kind).alias("check_name"), F.lit(c.column or "").alias("column_name"),
            F.lit(c.severity).alias("severity"), F.lit(None).cast("double").alias("value"),
            F.lit("error").alias("status"),
        )
        for c in missing
    ]
    result = wide.select(F.inline(F.array(*out)))
    for check in uniques[1:]:
        per_key = df.groupBy(blank_to_null(F.col(check.column).cast("string")).alias("_key")).agg(row_count().alias("n"))
        count = per_key.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("double").alias("u"))
        result = result.unionByName(count.select(F.inline(F.array(_row(check, F.col("u"), F.col("u") == 0)))))
    return result


def _row(check: Check, value: Column, ok: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check_name"),
        F.lit(check.column or "").alias("column_name"),
        F.lit(check.severity).alias("severity"),
        value.alias("value"),
        F.when(F.coalesce(ok, F.lit(False)), "pass").otherwise("fail").alias("status"),
    )


def _in_range(value: Column, check: Check) -> Column:
    ok = value.isNotNull()
    if check.low is not None:
        ok = ok & (value >= check.low)
    if check.high is not None:
        ok = ok & (value <= check.high)
    return ok


def flag_failures(df: DataFrame, suite: Sequence[Check], reason: str = "_quarantine_reason") -> DataFrame:
    """Add the failed checks of each row, joined in suite order; blank if none failed."""
    flags, flagged = [], df
    for i, check in enumerate(suite):
        if check.kind == "unique":
            flagged = flag_duplicates(flagged, blank_to_null(F.col(check.column).cast("string")), f"_dup{i}")
            flags.append(F.when(F.col(f"_dup{i}"), check.label))
        else:
            flags.append(F.when(failing(check), check.label))
    return flagged.withColumn(reason, F.concat_ws("; ", *flags)).select(*df.columns, reason)


def critical_reasons(df: DataFrame, suite: Sequence[Check]) -> DataFrame:
    """Every row with its failed critical checks; written by reason, one pass feeds both sinks."""
    return flag_failures(df, [c for c in suite if c.severity == "critical"])


def quarantine_split(df: DataFrame, suite: Sequence[Check]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every critical check, and the rest with reasons."""
    marked = critical_reasons(df, suite)
    clean = marked.where("_quarantine_reason = ''").drop("_quarantine_reason")
    return clean, marked.where("_quarantine_reason <> ''")


def load_decision(total_rows: Column, quarantined: Column, critical_failed: Column) -> list[Column]:
    """Decision and alert from the counts of a run."""
    share = F.round(F.lit(100.0) * quarantined / F.nullif(total_rows.cast("double"), F.lit(0.0)), 1)
    decision = (
        F.when(share > REJECT_ABOVE_PCT, "reject_all").when(quarantined > 0, "quarantine_and_load").otherwise("load_clean")
    )
    alert = (share > ALERT_ABOVE_PCT) | critical_failed
    return [share.alias("quarantine_pct"), decision.alias("load_decision"), alert.alias("alert_required")]


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, value): the histogram that profiles and drift read.

    The columns are unpivoted inside each task and counted before the shuffle, so
    frequent values travel once per task and no column is handled by one task.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), blank_to_null(F.col(c).cast("string")).alias("value")) for c in columns]
    )
    return df.select(F.inline(pairs)).groupBy("column_name", "value").agg(row_count().alias("n"))


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: nulls, distinct values, inferred type, numeric range.

    Blank counts as null. A column is numeric if more than half of its rows parse.
    """
    counts = value_counts(df, columns or df.columns)
    n, number = F.col("n"), to_number(F.col("value"))
    weighted = F.sum(number * n)
    parsed = F.coalesce(F.sum(F.when(number.isNotNull(), n)), F.lit(0))
    per = counts.groupBy("column_name").agg(
        F.sum("n").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), n)), F.lit(0)).alias("null_count"),
        F.count("value").alias("unique_count"),
        parsed.alias("parsed"),
        F.min(number).alias("lo"),
        F.max(number).alias("hi"),
        (weighted / F.nullif(parsed.cast("double"), F.lit(0.0))).alias("avg"),
        F.coalesce(F.sum(F.when(number < 0, n)), F.lit(0)).alias("neg"),
    )
    numeric = F.col("parsed") > F.col("total_rows") * NUMERIC_SHARE
    return per.select(
        "column_name", "total_rows", "null_count",
        F.round(F.lit(100.0) * F.col("null_count") / F.col("total_rows"), 1).alias("null_pct"),
        "unique_count",
        F.round(F.lit(100.0) * F.col("unique_count") / F.col("total_rows"), 1).alias("uniqueness_pct"),
        F.when(numeric, "numeric").otherwise("string").alias("inferred_type"),
        F.when(numeric, F.col("lo")).alias("min_value"),
        F.when(numeric, F.col("hi")).alias("max_value"),
        F.when(numeric, F.round("avg", 2)).alias("mean_value"),
        F.when(numeric, F.col("neg")).alias("negative_count"),
    )


def quick_profile(df: DataFrame, columns: Sequence[str], rsd: float = 0.01) -> DataFrame:
    """Null and approximate distinct counts per column, without any shuffle of values.

    For first looks at very large tables; ``profile`` is the exact one.
    """
    aggs = [row_count().alias("n")]
    for c in columns:
        text = blank_to_null(F.col(c).cast("string"))
        aggs += [F.count(text).alias(f"c_{c}"), F.approx_count_distinct(text, rsd).alias(f"d_{c}")]
    out = [
        F.struct(F.lit(c).alias("column_name"), (F.col("n") - F.col(f"c_{c}")).alias("null_count"), F.col(f"d_{c}").alias("distinct_estimate"))
        for c in columns
    ]
    return df.agg(*aggs).select(F.inline(F.array(*out)))


def top_values(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    counts = value_counts(df, columns).where("value IS NOT NULL")
    return top_per_key(counts, ["column_name"], [F.desc("n"), F.asc("value")], k)


def null_fractions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing share per column in one aggregate, turned from wide to long."""
    wide = df.agg(
        *[
            F.round(F.lit(100.0) * F.count(F.when(is_blank(F.col(c).cast("string")), 1)) / row_count(), 4).alias(c)
            for c in columns
        ]
    )
    return wide.unpivot([], list(columns), "column_name", "null_pct")


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Filled cells over all cells, in percent."""
    filled = F.lit(0)
    for c in columns:
        filled = filled + F.count(F.when(~is_blank(F.col(c).cast("string")), 1))
    return df.agg(
        row_count().alias("total_rows"),
        F.round(F.lit(100.0) * filled / F.nullif((row_count() * len(columns)).cast("double"), F.lit(0.0)), 1).alias("completeness_pct"),
    )


def auto_fix(df: DataFrame, amount: str = "amount", day: str = "transaction_date") -> DataFrame:
    """Fill missing amounts with the median, mark bad dates, trim all strings.

    ``fix_log`` tells how many rows each fix touches. Runs after the checks, on the
    untouched rows.
    """
    median = exact_median(df, to_number(F.col(amount)).cast("decimal(18,2)")).scalar()
    fixed = df.withColumn(amount, F.coalesce(blank_to_null(F.col(amount)), median.cast("string")))
    return trim_strings(fixed.withColumn(day, mark_bad_date(F.col(day))))


def fix_log(df: DataFrame, amount: str = "amount", day: str = "transaction_date") -> DataFrame:
    strings = [c for c, kind in df.dtypes if kind == "string"]
    padded = F.lit(False)
    for c in strings:
        padded = padded | F.coalesce(F.col(c) != F.trim(F.col(c)), F.lit(False))
    wide = df.agg(
        F.count(F.when(is_blank(F.col(amount)), 1)).alias("null_amount_filled_with_median"),
        F.count(F.when(F.col(day).isNotNull() & strict_date(F.col(day)).isNull(), 1)).alias("invalid_dates_marked"),
        F.count(F.when(padded, 1)).alias("whitespace_stripped"),
    )
    return wide.unpivot([], wide.columns, "fix", "rows_affected")


def scorecard(df: DataFrame, expected: Sequence[str], key: str) -> DataFrame:
    """Null rate, duplicate rate, schema match and a 0-100 score, in one grouped pass.

    The score gives 40 points for filled cells, 40 for unrepeated keys, 20 for the schema.
    """
    present = [c for c in expected if c in df.columns]
    match = 1 if len(present) == len(expected) else 0
    nulls = [F.count(F.when(is_blank(F.col(c).cast("string")), 1)).alias(f"n_{c}") for c in present]
    per_key = df.groupBy(F.col(key).alias("_key")).agg(row_count().alias("n"), *nulls)
    rows = F.sum("n")
    cells = F.lit(0)
    for c in present:
        cells = cells + F.sum(f"n_{c}")
    null_rate = cells / (rows * len(present)).cast("double")
    dup_rate = (rows - F.count("_key")) / rows.cast("double")
    score = 40 * (1 - null_rate) + 40 * (1 - dup_rate) + 20 * match
    return per_key.agg(
        rows.alias("total_rows"),
        *[F.round(F.lit(100.0) * F.sum(f"n_{c}") / rows, 4).alias(f"null_rate_{c}") for c in present],
        F.round(dup_rate * 100, 4).alias("duplicate_rate"),
        F.lit(match).alias("schema_match"),
        F.round(score, 2).alias("overall_quality_score"),
    )


def layer_summary(df: DataFrame, amount: str, status: str) -> DataFrame:
    """Rows, null rate of every column, range and mean of the amount, rows per status; as name/value pairs.

    One pass: everything is summed per status, and the few statuses are summed up again.
    """
    number = F.col(amount).cast("double")
    per = df.groupBy(status).agg(
        row_count().alias("n"), F.min(number).alias("lo"), F.max(number).alias("hi"),
        F.sum(F.col(amount)).alias("s"), F.count(amount).alias("c"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(df.columns)],
    )
    head = per.agg(
        *[F.round(100.0 * F.sum(f"null_{i}") / F.sum("n"), 4).alias(f"null_rate_{c}") for i, c in enumerate(df.columns)],
        F.sum("n").cast("double").alias("total_rows"), F.min("lo").alias("amount_min"), F.max("hi").alias("amount_max"),
        F.round(F.sum("s").cast("double") / F.sum("c"), 2).alias("amount_mean"),
        F.count(status).cast("double").alias("unique_statuses"),
    )
    names = head.unpivot([], head.columns, "metric", "value")
    status_rows = per.select(F.concat(F.lit("status_"), F.col(status)).alias("metric"), F.col("n").cast("double").alias("value"))
    return names.unionByName(status_rows)


def domain_violations(df: DataFrame, merchants: DataFrame, as_of: Column) -> DataFrame:
    """One row per violated business rule per transaction.

    ``df`` has typed amount and date. An instant payment above 100000, a date after
    ``as_of``, an unknown status, an unknown merchant and a completed zero amount are violations.
    """
    known = merchants.select("merchant_id", F.lit(True).alias("_known"))
    joined = df.join(known, "merchant_id", "left")
    amount, status = F.col("amount"), F.col("status")
    rules = F.array_compact(
        F.array(
            F.when((F.col("payment_method") == "UPI") & (amount > 100000), "upi_over_limit"),
            F.when(F.col("transaction_date") > as_of, "future_date"),
            F.when(~status.isin("COMPLETED", "FAILED", "PENDING"), "unknown_status"),
            F.when(F.col("_known").isNull(), "unknown_merchant"),
            F.when((status == "COMPLETED") & (amount == 0), "zero_completed"),
        )
    )
    return joined.select("transaction_id", F.explode(rules).alias("violation"))


def verdict(as_of: Column, currencies: Sequence[str], category: str = "category") -> Column:
    """PASS, QUARANTINE or FLAG for one transaction."""
    amount = F.col("amount")
    bad = (
        is_blank(F.col("transaction_id"))
        | F.coalesce(amount < 0, F.lit(True))
        | ~F.coalesce(F.col("currency").isin(*currencies), F.lit(False))
        | F.coalesce(F.col("transaction_date") > as_of, F.lit(True))
    )
    large = (amount > 500000) & is_blank(F.col(category))
    return F.when(bad, "QUARANTINE").when(large, "FLAG").otherwise("PASS")


def small_sample_guard(rates: DataFrame, hits: str, n: str, min_rows: int = 30) -> DataFrame:
    """Mark rates on few rows and add the lower Wilson bound (95 %)."""
    z = 1.96
    size = F.col(n).cast("double")
    p = F.col(hits) / F.nullif(size, F.lit(0.0))
    centre = p + z * z / (2 * size)
    margin = z * F.sqrt(p * (1 - p) / size + z * z / (4 * size * size))
    bound = F.greatest((centre - margin) / (1 + z * z / size), F.lit(0.0))
    return rates.withColumn("reliable", F.col(n) >= min_rows).withColumn("wilson_low", F.round(bound, 4))


def compare_profiles(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both profiles side by side per column, with the gap of means and null rates."""
    keep = ["column_name", "total_rows", "null_pct", "unique_count", "mean_value"]
    a = profile(left, columns).select(*keep)
    b = profile(right, columns).select("column_name", *[F.col(c).alias(f"other_{c}") for c in keep[1:]])
    return a.join(b, "column_name", "full").withColumn(
        "mean_gap", F.round(F.col("other_mean_value") - F.col("mean_value"), 2)
    )


def drop_missing_key(df: DataFrame, key: str) -> DataFrame:
    return df.where(~is_blank(F.col(key)))


def numbers_or_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Coerce to number; whatever is missing or unparsable becomes 0."""
    return df.withColumns({c: F.coalesce(to_number(F.col(c)), F.lit(0.0)) for c in columns})


def add_or_drop(df: DataFrame, column: str) -> DataFrame:
    """Drop ``column`` if the frame has it, otherwise add it as null."""
    return df.drop(column) if column in df.columns else df.withColumn(column, F.lit(None).cast("string"))
