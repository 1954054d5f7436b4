"""Service objectives, alert rules and status."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Objective:
    """A metric must lie within [low, high]."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


def minutes_of(started: Column, ended: Column) -> Column:
    """Runtime in minutes, exact to the microsecond and never rounded: 129 minutes do not meet a limit of 120."""
    passed = ended.cast("timestamp_ntz") - started.cast("timestamp_ntz")
    return F.round(passed.cast("interval second").cast("decimal(20,6)") * 1_000_000, 0).cast("double") / 60_000_000


def within(value: Column, low: float | None, high: float | None) -> Column:
    ok = value.isNotNull()
    if low is not None:
        ok = ok & (value >= low)
    if high is not None:
        ok = ok & (value <= high)
    return F.coalesce(ok, F.lit(False))


def evaluate_objectives(metrics: DataFrame, objectives: Sequence[Objective]) -> DataFrame:
    """One row per objective from a one-row metrics frame."""
    lines = [
        F.struct(
            F.lit(o.name).alias("objective"), F.col(o.metric).cast("double").alias("value"),
            within(F.col(o.metric), o.low, o.high).alias("met"),
        )
        for o in objectives
    ]
    return metrics.select(F.inline(F.array(*lines)))


def status_rollup(results: DataFrame, critical: Sequence[str]) -> DataFrame:
    """CRITICAL if a critical objective is missed, DEGRADED if any is, else HEALTHY."""
    missed = F.count(F.when(~F.col("met"), 1))
    bad = F.count(F.when(~F.col("met") & F.col("objective").isin(*critical), 1))
    return results.agg(
        F.count(F.lit(1)).alias("objectives"), missed.alias("missed"),
        F.when(bad > 0, "CRITICAL").when(missed > 0, "DEGRADED").otherwise("HEALTHY").alias("status"),
    )


@dataclass(frozen=True)
class AlertRule:
    """Fires where ``condition`` (SQL over the metrics frame) holds."""

    name: str
    severity: str
    condition: str


# The standing alert rules.
ALERT_RULES = [
    AlertRule("data_freshness_breach", "CRITICAL", "freshness_hours > 24"),
    AlertRule("quality_threshold_breach", "CRITICAL", "quality_pct < 99.9"),
    AlertRule("row_count_outside_bounds", "CRITICAL", "rows_per_day NOT BETWEEN 17 AND 25"),
    AlertRule("runtime_approaching_limit", "WARNING", "runtime_minutes > 120 * 0.9"),
    AlertRule("quality_slightly_below_threshold", "WARNING", "quality_pct < 99.9 AND quality_pct >= 99.85"),
    AlertRule("merchant_failure_rate_spike", "WARNING", "max_failure_rate_pct > 30"),
    AlertRule("new_payment_method_detected", "INFO", "new_methods > 0"),
    AlertRule("row_count_near_bounds", "INFO", "rows_per_day BETWEEN 17 AND 18 OR rows_per_day BETWEEN 24 AND 25"),
]


def evaluate_alerts(metrics: DataFrame, rules: Sequence[AlertRule] = tuple(ALERT_RULES)) -> DataFrame:
    lines = [
        F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"),
            F.coalesce(F.expr(r.condition), F.lit(False)).alias("fired"),
        )
        for r in rules
    ]
    return metrics.select(F.inline(F.array(*lines)))


def unseen_values(df: DataFrame, column: str, known: Sequence[str]) -> DataFrame:
    """Values outside the known set, with their number of rows."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).where(~F.col(column).isin(*known))
