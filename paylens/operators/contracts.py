"""Data contracts, model tests and scan checks on top of the quality predicates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions.dates import strict_date
from paylens.functions.numeric import count_when, ratio, to_number
from paylens.functions.text import blank_to_null, is_blank, matches_from_start
from paylens.operators.aggregates import row_count


@dataclass(frozen=True)
class Field:
    """One field of a data contract."""

    name: str
    required: bool = True
    pattern: str | None = None
    values: tuple = ()
    positive: bool = False
    is_date: bool = False


def validate_contract(df: DataFrame, contract: Sequence[Field]) -> DataFrame:
    """Violations per rule, all rules in one aggregate. A missing value breaks every rule."""
    rules: list[tuple[str, str, Column]] = []
    for f in contract:
        text = F.col(f.name).cast("string")
        if f.required:
            rules.append(("required", f.name, is_blank(text)))
        if f.pattern:
            rules.append(("format", f.name, ~F.coalesce(matches_from_start(text, f.pattern), F.lit(False))))
        if f.values:
            rules.append(("enum", f.name, ~F.coalesce(text.isin(*f.values), F.lit(False))))
        if f.positive:
            rules.append(("positive", f.name, ~F.coalesce(to_number(text) > 0, F.lit(False))))
        if f.is_date:
            rules.append(("date", f.name, strict_date(text).isNull()))
    wide = df.agg(*[count_when(bad).alias(f"r{i}") for i, (_, _, bad) in enumerate(rules)])
    lines = [
        F.struct(F.lit(rule).alias("rule"), F.lit(name).alias("field"), F.col(f"r{i}").alias("violations"))
        for i, (rule, name, _) in enumerate(rules)
    ]
    return wide.select(F.inline(F.array(*lines)))


@dataclass(frozen=True)
class ModelTest:
    """not_null, unique, accepted_values, relationships or between; nulls pass the last three."""

    test: str
    column: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None


def model_tests(df: DataFrame, tests: Sequence[ModelTest], parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Failures per test; 0 passes.

    Row tests share one aggregate. Uniqueness counts repeated keys and relationships
    count per key before joining the parent, so a hot key is one row there.
    """
    parents = parents or {}
    rows = [t for t in tests if t.test in ("not_null", "accepted_values", "between")]
    out = None
    if rows:
        wide = df.agg(*[count_when(_broken(t)).alias(f"t{i}") for i, t in enumerate(rows)])
        out = wide.select(F.inline(F.array(*[_line(t, F.col(f"t{i}")) for i, t in enumerate(rows)])))
    for t in tests:
        if t.test == "unique":
            per = df.where(F.col(t.column).isNotNull()).groupBy(t.column).agg(row_count().alias("n"))
            count = per.agg(count_when(F.col("n") > 1).alias("f"))
        elif t.test == "relationships":
            per = df.where(F.col(t.column).isNotNull()).groupBy(t.column).agg(row_count().alias("n"))
            lost = per.join(parents[t.column].select(t.column), t.column, "left_anti")
            count = lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("f"))
        else:
            continue
        line = count.select(F.inline(F.array(_line(t, F.col("f")))))
        out = line if out is None else out.unionByName(line)
    return out


def _broken(t: ModelTest) -> Column:
    col = F.col(t.column)
    if t.test == "not_null":
        return col.isNull()
    if t.test == "accepted_values":
        return ~col.isin(*t.values)
    bad = F.lit(False)
    if t.low is not None:
        bad = bad | (col < t.low)
    if t.high is not None:
        bad = bad | (col > t.high)
    return bad


def _line(t: ModelTest, failures: Column) -> Column:
    return F.struct(
        F.lit(t.test).alias("test"), F.lit(t.column).alias("column_name"), failures.alias("failures"), (failures == 0).alias("passed")
    )


@dataclass(frozen=True)
class ScanChecks:
    """row_count > 0, missing = 0, duplicated values = 0, minimum >= x, invalid = 0."""

    missing: list[str] = field(default_factory=list)
    duplicate: list[str] = field(default_factory=list)
    minimum: dict[str, float] = field(default_factory=dict)
    valid: dict[str, list[str]] = field(default_factory=dict)


def scan_checks(df: DataFrame, checks: ScanChecks) -> DataFrame:
    """Check, value and outcome. ``duplicate`` counts values held by several rows."""
    aggs, names = [row_count().cast("double").alias("c0")], ["row_count"]
    good = [F.col("c0") > 0]

    def add(name: str, value: Column, ok) -> None:
        alias = f"c{len(names)}"
        aggs.append(value.cast("double").alias(alias))
        names.append(name)
        good.append(ok(F.col(alias)))

    for c in checks.missing:
        add(f"missing_count({c})", count_when(is_blank(F.col(c))), lambda v: v == 0)
    for c, low in checks.minimum.items():
        add(f"min({c})", F.min(to_number(F.col(c).cast("string"))), lambda v, low=low: v >= low)
    for c, values in checks.valid.items():
        add(f"invalid_count({c})", count_when(~is_blank(F.col(c)) & ~F.col(c).isin(*values)), lambda v: v == 0)
    lines = [_outcome(F.lit(n), F.col(f"c{i}"), good[i]) for i, n in enumerate(names)]
    out = df.agg(*aggs).select(F.inline(F.array(*lines)))
    for c in checks.duplicate:
        per = df.groupBy(blank_to_null(F.col(c)).alias("key")).agg(row_count().alias("n"))
        n = per.agg(count_when(F.col("key").isNotNull() & (F.col("n") > 1)).cast("double").alias("n"))
        out = out.unionByName(n.select(F.inline(F.array(_outcome(F.lit(f"duplicate_count({c})"), F.col("n"), F.col("n") == 0)))))
    return out


def _outcome(name: Column, value: Column, ok: Column) -> Column:
    return F.struct(
        name.alias("check_name"), value.alias("value"), F.when(F.coalesce(ok, F.lit(False)), "pass").otherwise("fail").alias("outcome")
    )


def silver_checks(silver: DataFrame) -> DataFrame:
    """The ten standing checks of the Silver table, from one grouped pass.

    Grouping by id first gives the duplicate count; everything else adds up.
    """
    amount, status = F.col("amount"), F.col("status")
    parts = {
        "n": row_count(), "a": F.count("amount"), "s": F.count("status"), "d": F.count("transaction_date"),
        "neg": count_when(amount < 0), "bad_s": count_when(~status.isin("COMPLETED", "FAILED", "PENDING")),
        "bad_q": count_when(~F.col("quality_flag").isin("CLEAN", "UNMATCHED")), "total": F.sum("amount"),
    }
    per_id = silver.groupBy("transaction_id").agg(*[c.alias(k) for k, c in parts.items()])
    sums = {k: F.sum(k).alias(k) for k in parts}
    ids = F.count("transaction_id").alias("ids")
    null_ids = F.sum(F.when(F.col("transaction_id").isNull(), F.col("n")).otherwise(0)).alias("null_ids")
    wide = per_id.agg(*sums.values(), ids, null_ids)
    n = F.col("n")
    mean = ratio(F.col("total"), F.col("a"))
    checks = [
        ("row_count", n, n > 0),
        ("null_transaction_id", F.col("null_ids"), F.col("null_ids") == 0),
        ("null_amount", n - F.col("a"), n == F.col("a")),
        ("null_status", n - F.col("s"), n == F.col("s")),
        ("null_transaction_date", n - F.col("d"), n == F.col("d")),
        ("negative_amount", F.col("neg"), F.col("neg") == 0),
        ("duplicate_transaction_id", n - F.col("ids"), n == F.col("ids")),
        ("invalid_status", F.col("bad_s"), F.col("bad_s") == 0),
        ("invalid_quality_flag", F.col("bad_q"), F.col("bad_q") == 0),
        ("mean_amount", mean, mean.between(100, 5000)),
    ]
    lines = [
        F.struct(
            F.lit(name).alias("check_name"), value.cast("double").alias("value"),
            F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
        )
        for name, value, ok in checks
    ]
    return wide.select(F.inline(F.array(*lines)))


def blocked_customers(legitimate: DataFrame, customer: str, amount: Column, thresholds: Sequence[float]) -> DataFrame:
    """Legitimate customers and transactions a limit would block, per threshold.

    One maximum and a few counts per customer answer every threshold at once.
    """
    per = legitimate.groupBy(customer).agg(*[count_when(amount > t).alias(f"n{i}") for i, t in enumerate(thresholds)])
    wide = per.agg(
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(thresholds))],
        *[count_when(F.col(f"n{i}") > 0).alias(f"c{i}") for i in range(len(thresholds))],
    )
    lines = [
        F.struct(F.lit(t).alias("threshold"), F.col(f"c{i}").alias("customers_blocked"), F.col(f"n{i}").alias("transactions_blocked"))
        for i, t in enumerate(thresholds)
    ]
    return wide.select(F.inline(F.array(*lines)))
