"""Bronze to Silver to Gold.

Each layer is a written table, so a lost executor costs one stage and the three Gold
tables read Silver instead of recomputing it.
"""

from __future__ import annotations

import datetime
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.dates import strict_date
from paylens.functions.numeric import to_amount
from paylens.functions.text import is_blank, trim_strings
from paylens.operators import aggregates
from paylens.operators.dedup import latest_per_key
from paylens.operators.joins import enrich
from paylens.session import freeing_shuffles
from paylens.sources.readers import read_csv_text, with_ingestion_metadata
from paylens.sources.writers import replace_partitions, write_run_metadata

HALT_SHARE = 0.05


class QualityHalt(RuntimeError):
    """Too many rows failed; Silver was not written."""


@dataclass
class StageCounts:
    rows_in: int
    rows_valid: int
    rows_out: int


def valid_rows(bronze: DataFrame, mode: str = "silver") -> DataFrame:
    """Rows with an id and an amount that the layer accepts.

    ``silver`` keeps zero amounts; ``staging`` and ``replay`` do not.
    """
    return bronze.where(is_valid(mode))


def is_valid(mode: str = "silver") -> Column:
    keep = F.col("amount") >= 0 if mode == "silver" else F.col("amount") > 0
    return ~is_blank(F.col("transaction_id")) & keep


def latest_first() -> list[Column]:
    """Which copy of a transaction counts: the newest, and of equal ones always the same."""
    return [F.desc("ingestion_timestamp"), F.asc("k"), F.asc("amount"), F.asc("merchant_id")]


def to_silver(bronze: DataFrame, merchants: DataFrame, order: list | None = None) -> DataFrame:
    """Filter, keep the latest copy per id, add merchant fields and the flag."""
    order = order or latest_first()
    return enrich(latest_per_key(valid_rows(bronze), ["transaction_id"], order), merchants, "merchant_id")


def ingest_bronze(spark: SparkSession, source: str, out: str, run_id: str, at: Column, period: Column | None = None) -> str:
    """CSV to Bronze: every column as text, with load time, file and run, in folders by date.

    ``period`` names another folder, such as the month when years are loaded at once.
    Returns ``loaded``, or ``source_missing`` if there is nothing to read that day.
    """
    try:
        rows = read_csv_text(spark, source)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" in str(problem.getCondition()):
            return "source_missing"
        raise
    stamped = with_ingestion_metadata(rows, run_id, at)
    folder = period if period is not None else strict_date(F.col("transaction_date")).cast("string")
    replace_partitions(stamped.withColumn("date", F.coalesce(folder, F.lit("unknown"))), out, ["date"])
    return "loaded"


def typed(bronze: DataFrame) -> DataFrame:
    """Bronze text to types; what does not parse becomes null and fails the rules below."""
    trimmed = trim_strings(bronze)
    return trimmed.withColumns(
        {"amount": to_amount(F.col("amount")), "transaction_date": strict_date(F.col("transaction_date"))}
    )


def gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    return {
        "merchant_performance": aggregates.merchant_performance(silver, daily=True),
        "customer_ltv": aggregates.customer_ltv(silver),
        "daily_summary": aggregates.daily_summary(silver),
    }


def check_gate(rows_in: int, rows_valid: int, limit: float = HALT_SHARE) -> None:
    """Raise if more than ``limit`` of the rows failed."""
    if rows_in and (rows_in - rows_valid) / rows_in > limit:
        raise QualityHalt(f"{rows_in - rows_valid} of {rows_in} rows failed, limit {limit:.0%}")


def run(
    spark: SparkSession, bronze: DataFrame, merchants: DataFrame, out: str, halt: float = HALT_SHARE, grain: str = "day"
) -> StageCounts:
    """Write Silver and the Gold tables below ``out``, each run replacing its own periods.

    A daily run uses ``day`` folders; a load of years of history uses ``month``, since a
    folder per day would hold few rows. The gate reads two counters over the raw rows
    before anything is written. Rows out are counted on the written files, from their
    footers; a counter inside the write would count a task twice that ran twice.
    """
    seen = bronze.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(~is_blank(F.col("transaction_id")) & (F.col("amount") >= 0), 1)).alias("ok"),
    ).first()
    check_gate(seen["n"], seen["ok"], halt)
    write_periods(to_silver(bronze, merchants), f"{out}/silver", "transaction_date", grain)
    stored = spark.read.parquet(f"{out}/silver")
    golds = gold_tables(stored)
    write_periods(golds["merchant_performance"], f"{out}/merchant_performance", "transaction_date", grain, gather=grain == "day")
    write_periods(golds["daily_summary"], f"{out}/daily_summary", "report_date", grain)
    golds["customer_ltv"].write.mode("overwrite").parquet(f"{out}/customer_ltv")
    return StageCounts(seen["n"], seen["ok"], stored.count())


def run_recorded(
    spark: SparkSession, run_id: str, bronze: DataFrame | None, merchants: DataFrame, out: str, **options
) -> str:
    """``run`` with a JSON record below ``out``/runs whether it succeeds, fails or is skipped."""
    facts = {"run_id": run_id, "status": "SKIPPED", "error": "", "rows_in": 0, "rows_valid": 0, "rows_out": 0}
    facts["started"] = str(datetime.datetime.now(datetime.timezone.utc))
    try:
        if bronze is not None:
            facts.update(asdict(run(spark, bronze, merchants, out, **options)), status="SUCCESS")
    except Exception as problem:
        facts.update(status="FAILED", error=str(problem))
        raise
    finally:
        facts["ended"] = str(datetime.datetime.now(datetime.timezone.utc))
        write_run_metadata(spark, facts, f"{out}/runs/{run_id}")
    return facts["status"]


def write_periods(df: DataFrame, path: str, day: str, grain: str, gather: bool = True) -> None:
    """Replace the periods of ``df``; without ``gather`` rows are written where they lie, a file a period for each task."""
    with freeing_shuffles(df.sparkSession):
        if grain == "day":
            replace_partitions(df, path, [day], gather=gather)
        else:
            replace_partitions(df.withColumn("month", F.date_format(day, "yyyy-MM")), path, ["month"], gather=gather)
