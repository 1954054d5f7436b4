"""Schema drift, value drift and distribution drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paylens.operators.quality import value_counts

# Widening order of the numeric types.
WIDTH = {"tinyint": 1, "smallint": 2, "int": 3, "bigint": 4, "float": 5, "double": 6}

ADD, DROP, FLAG, HALT = "ADD_TO_SCHEMA", "DROP_SILENTLY", "FLAG_ANOMALY", "HALT"


def schema_changes(expected: StructType, actual: StructType) -> list[tuple[str, str, str, str]]:
    """(column, change, expected type, actual type) for every difference."""
    want = {f.name: f.dataType.simpleString() for f in expected}
    have = {f.name: f.dataType.simpleString() for f in actual}
    changes = [(c, "removed", want[c], "") for c in want if c not in have]
    changes += [(c, "new", "", have[c]) for c in have if c not in want]
    changes += [(c, "type_changed", want[c], have[c]) for c in want if c in have and want[c] != have[c]]
    return changes


def decide(change: str, before: str, after: str) -> str:
    """What to do about one change of a column."""
    if change == "removed":
        return HALT
    if change == "new":
        return FLAG if after in WIDTH or after.startswith("decimal") else ADD
    widening = before in WIDTH and after in WIDTH and WIDTH[after] > WIDTH[before]
    return ADD if widening else FLAG


def severity(changes: Sequence[tuple[str, str, str, str]], nullable: dict[str, bool] | None = None) -> str:
    """NONE, LOW, HIGH or BREAKING over all changes of a schema."""
    nullable = nullable or {}
    worst = 0
    for column, change, before, after in changes:
        if change == "removed":
            level = 3
        elif change == "type_changed":
            level = 2 if decide(change, before, after) == ADD else 3
        else:
            level = 1 if nullable.get(column, True) else 2
        worst = max(worst, level)
    return ["NONE", "LOW", "HIGH", "BREAKING"][worst]


def drift_report(actual: DataFrame, expected: StructType) -> DataFrame:
    """One row per change: the action, the rows it touches, the severity of the whole.

    A new column touches the rows that fill it, a changed type those whose value the
    expected type cannot hold, a removed column all rows. One pass counts them all.
    """
    changes = schema_changes(expected, actual.schema)
    level = severity(changes, {f.name: f.nullable for f in actual.schema})
    counts, out = [], []
    for i, (column, change, before, after) in enumerate(changes):
        if change == "removed":
            touched = F.count(F.lit(1))
        elif change == "new":
            touched = F.count(column)
        else:
            touched = F.count(F.when(F.col(column).isNotNull() & F.col(column).try_cast(before).isNull(), 1))
        counts.append(touched.alias(f"n{i}"))
        words = {
            "column_name": column, "change": change, "expected_type": before, "actual_type": after,
            "action": decide(change, before, after), "severity": level,
        }
        out.append(F.struct(*[F.lit(v).alias(k) for k, v in words.items()], F.col(f"n{i}").alias("rows_touched")))
    if not changes:
        empty = "column_name string, change string, expected_type string, actual_type string, action string, severity string, rows_touched long"
        return actual.sparkSession.createDataFrame([], empty)
    return actual.agg(*counts).select(F.inline(F.array(*out)))


def evolve(df: DataFrame, expected: StructType) -> DataFrame:
    """Bring a frame to the expected columns, keeping what the rules keep.

    Missing columns come back as nulls of their type, widened ones are cast, narrowed or
    changed ones are cast where possible and flagged, new numeric ones stay with a flag.
    """
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    out: list[Column] = []
    for field in expected:
        want = field.dataType.simpleString()
        if field.name not in have:
            out.append(F.lit(None).cast(want).alias(field.name))
        elif have[field.name] == want:
            out.append(F.col(field.name))
        else:
            cast = F.col(field.name).try_cast(want)
            out.append(cast.alias(field.name))
            if decide("type_changed", want, have[field.name]) == FLAG:
                lost = F.col(field.name).isNotNull() & cast.isNull()
                out.append(lost.alias(f"{field.name}_anomaly"))
    for name, kind in have.items():
        if name in expected.fieldNames():
            continue
        out.append(F.col(name))
        if decide("new", "", kind) == FLAG:
            out.append(F.lit(True).alias(f"{name}_anomaly"))
    return df.select(*out)


def lost_predicates(before: DataFrame, after: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """Rows each metric's filter keeps before and after a schema change.

    ``after`` is brought back to the old columns, so a filter on a dropped column sees
    nulls: it keeps no row and raises no error, which is what this check shows.
    """
    restored = evolve(after, before.schema)
    old = before.agg(*[F.count(F.when(c, 1)).alias(m) for m, c in metrics.items()])
    new = restored.agg(*[F.count(F.when(c, 1)).alias(m) for m, c in metrics.items()])
    a = old.unpivot([], list(metrics), "metric", "rows_before")
    b = new.unpivot([], list(metrics), "metric", "rows_after")
    both = a.join(b, "metric")
    return both.withColumn("broken", (F.col("rows_before") > 0) & (F.col("rows_after") == 0))


def domain_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: distinct values on each side, on one side only, and whether it drifted."""
    a = value_counts(reference, columns).where("value IS NOT NULL").withColumnRenamed("n", "n_ref")
    b = value_counts(current, columns).where("value IS NOT NULL").withColumnRenamed("n", "n_cur")
    both = a.join(b, ["column_name", "value"], "full")
    return both.groupBy("column_name").agg(
        F.count("n_ref").alias("reference_values"),
        F.count("n_cur").alias("current_values"),
        F.count(F.when(F.col("n_cur").isNull(), 1)).alias("only_reference"),
        F.count(F.when(F.col("n_ref").isNull(), 1)).alias("only_current"),
        (F.count("n_ref") + F.count("n_cur") > 2 * F.count(F.when(F.col("n_ref").isNotNull() & F.col("n_cur").isNotNull(), 1))).alias(
            "drifted"
        ),
    )


def drift_share(per_column: DataFrame) -> DataFrame:
    drifted = F.count(F.when(F.col("drifted"), 1))
    return per_column.agg(
        F.count(F.lit(1)).alias("columns_compared"),
        drifted.alias("columns_drifted"),
        F.round(drifted / F.count(F.lit(1)).cast("double"), 2).alias("drift_share"),
        (drifted > 0).alias("dataset_drifted"),
    )


def category_shares(reference: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Share of every value on both sides; a side without it has share 0."""
    return _shares(reference.groupBy(F.col(column).cast("string").alias("bin")), current.groupBy(F.col(column).cast("string").alias("bin")))


def binned_shares(reference: DataFrame, current: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Shares over equal bins between the reference's smallest and largest value."""
    lo = reference.agg(F.min(column)).scalar().cast("double")
    hi = reference.agg(F.max(column)).scalar().cast("double")
    where = F.floor((F.col(column).cast("double") - lo) / F.nullif(hi - lo, F.lit(0.0)) * bins)
    bin_no = F.least(F.greatest(F.coalesce(where, F.lit(0)), F.lit(0)), F.lit(bins - 1)).cast("string").alias("bin")
    return _shares(reference.groupBy(bin_no), current.groupBy(bin_no))


def _shares(reference, current) -> DataFrame:
    """Both sides counted in full; only the counts are joined."""
    a = reference.agg(F.count(F.lit(1)).alias("a"))
    b = current.agg(F.count(F.lit(1)).alias("b"))
    both = a.join(b, "bin", "full").fillna(0, ["a", "b"])
    size_a, size_b = a.agg(F.sum("a")).scalar().cast("double"), b.agg(F.sum("b")).scalar().cast("double")
    return both.select("bin", (F.col("a") / size_a).alias("p"), (F.col("b") / size_b).alias("q"))


def stability_report(reference: DataFrame, current: DataFrame, numeric: Sequence[str], categories: Sequence[str], share: float = 0.5) -> DataFrame:
    """Stability index of every column, and the dataset's verdict: drifted if ``share`` of its columns are."""
    parts = [(c, binned_shares(reference, current, c)) for c in numeric] + [(c, category_shares(reference, current, c)) for c in categories]
    rows = None
    for name, shares in parts:
        line = stability_index(shares).select(F.lit(name).alias("column_name"), "psi", "drifted")
        rows = line if rows is None else rows.unionByName(line)
    # One row for each column.
    whole = Window.partitionBy(F.lit(0))
    return rows.withColumn("dataset_drifted", F.count_if("drifted").over(whole) >= share * F.count(F.lit(1)).over(whole))


def stability_index(shares: DataFrame, floor: float = 0.0001, limit: float = 0.2) -> DataFrame:
    """Population stability index of binned shares and whether it exceeds ``limit``."""
    p, q = F.greatest(F.col("p"), F.lit(floor)), F.greatest(F.col("q"), F.lit(floor))
    index = F.sum((q - p) * F.ln(q / p))
    return shares.agg(F.round(index, 6).alias("psi"), (index > limit).alias("drifted"))
