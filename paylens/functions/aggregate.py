"""Aggregate and table functions of a user's own, callable from SQL.

An aggregate function over Arrow arrays holds its whole group, so it comes as a pair: the
partial one turns a bounded part of a group into a state, the final one joins states. A
table function sees the rows of one key in order, a batch at a time, and keeps what it
needs between them; it never holds a key's rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts that a group is cut into before its states are joined.
PARTS = 64


def register_aggregate(
    spark: SparkSession, name: str, partial: Callable[[pa.Array], dict], state: str, final: Callable[[pa.Array], object], returns: str
) -> tuple:
    """Register ``<name>_partial`` and ``<name>``: values to a state (a struct), states to a value."""

    def to_state(values: pa.Array) -> dict:
        return partial(values)

    def to_value(states: pa.Array) -> object:
        return final(states)

    to_state.__annotations__ = {"values": pa.Array, "return": dict}
    to_value.__annotations__ = {"states": pa.Array, "return": object}
    first, second = F.arrow_udf(to_state, state), F.arrow_udf(to_value, returns)
    return spark.udf.register(f"{name}_partial", first), spark.udf.register(name, second)


def aggregate_in_parts(df: DataFrame, keys: list[str], value: Column, partial, final, out: str, parts: int = PARTS) -> DataFrame:
    """The pair applied to groups of any size: no task holds more than a part of a group."""
    part = F.pmod(F.monotonically_increasing_id(), F.lit(parts))
    states = df.select(*keys, value.alias("_value"), part.alias("_part")).groupBy(*keys, "_part").agg(partial("_value").alias("_state"))
    return states.groupBy(*keys).agg(final("_state").alias(out))


def register_geometric_mean(spark: SparkSession, name: str = "geometric_mean") -> tuple:
    """Geometric mean of positive numbers, null without any; also ``<name>_partial``."""
    # Functions inside a function travel to the workers by value, so they need no copy of this package.

    def partial(values: pa.Array) -> dict:
        positive = pc.filter(values, pc.fill_null(pc.greater(values, 0), False))
        return {"n": len(positive), "logs": pc.sum(pc.ln(positive)).as_py() or 0.0}

    def final(states: pa.Array) -> float | None:
        import math

        n = sum(s["n"] for s in states.to_pylist())
        return math.exp(math.fsum(s["logs"] for s in states.to_pylist()) / n) if n else None

    return register_aggregate(spark, name, partial, "n bigint, logs double", final, "double")


def register_sessions(spark: SparkSession, name: str = "sessions", gap: int = 1800):
    """Register a table function: visits of each key, split where ``gap`` seconds or more pass without a row.

    Called as ``sessions(TABLE(SELECT key, second FROM ...) PARTITION BY key ORDER BY second)``;
    gives ``key, started, ended, events``.
    """

    class Sessions:
        def __init__(self) -> None:
            self.key = self.started = self.ended = None
            self.events = 0

        def _closed(self) -> pa.Table:
            return pa.table({
                "key": pa.array([self.key], pa.int64()), "started": pa.array([self.started], pa.int64()), "ended": pa.array([self.ended], pa.int64()),
                "events": pa.array([self.events], pa.int64()),
            })

        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            for key, second in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if self.events and second - self.ended >= gap:
                    yield self._closed()
                    self.events = 0
                if not self.events:
                    self.key, self.started = key, second
                self.ended, self.events = second, self.events + 1

        def terminate(self) -> Iterator[pa.Table]:
            if self.events:
                yield self._closed()

    function = F.arrow_udtf(Sessions, returnType="key bigint, started bigint, ended bigint, events bigint")
    return spark.udtf.register(name, function)
