"""Metric registry: a business measure is written once and grouped by anything."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Metric:
    name: str
    expression: str
    about: str


METRICS = {
    m.name: m
    for m in [
        Metric("total_revenue", "CAST(SUM(CASE WHEN status = 'COMPLETED' THEN amount ELSE 0 END) AS DOUBLE)", "money that moved"),
        Metric("failure_rate_pct", "ROUND(100.0D * COUNT_IF(status = 'FAILED') / COUNT(*), 2)", "failed over all, in percent"),
        Metric("completed_transaction_count", "COUNT_IF(status = 'COMPLETED')", "finished transactions"),
        Metric("transaction_count", "COUNT(*)", "all transactions"),
    ]
}


def metric(facts: DataFrame, names: Sequence[str], by: Sequence[str] = (), dims: dict[str, tuple[str, DataFrame]] | None = None) -> DataFrame:
    """The named metrics grouped by fact or dimension columns.

    ``dims`` maps a dimension column to its key and frame; a dimension is joined only if
    one of its columns is asked for.
    """
    rows = facts
    joined = set()
    for column in by:
        if column in facts.columns or dims is None or column not in dims:
            continue
        key, dim = dims[column]
        wanted = [c for c in by if dims.get(c, (None, None))[1] is dim]
        if key not in joined:
            rows = rows.join(dim.select(key, *wanted), key)
            joined.add(key)
    return rows.groupBy(*by).agg(*[F.expr(METRICS[n].expression).alias(n) for n in names])
