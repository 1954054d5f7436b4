"""A key that holds a third of all rows: results stay whole and the work is split."""

import contextlib

import pytest
from pyspark.sql import functions as F

from paylens.operators import quality
from paylens.operators.dedup import flag_duplicates, latest_per_key
from paylens.operators.joins import enrich

ROWS = 600_000


@contextlib.contextmanager
def settings(spark, **values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SMALL_LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def skewed(spark):
    """Every third row has the same merchant and id."""
    n = F.col("id")
    return spark.range(0, ROWS, 1, 8).select(
        F.when(n % 3 == 0, F.lit("hot")).otherwise(n.cast("string")).alias("transaction_id"),
        F.when(n % 3 == 0, F.lit("M0")).otherwise(F.concat(F.lit("M"), (n % 5000).cast("string"))).alias("merchant_id"),
        F.sha2(n.cast("string"), 256).alias("note"),
        n.alias("v"),
    )


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_duplicate_flags_split_the_hot_key(spark, skewed):
    with settings(spark, **SMALL_LIMITS):
        out = flag_duplicates(skewed, F.col("transaction_id")).groupBy("is_duplicate").agg(F.count("*").alias("n"), F.max("note"))
        got = {r["is_duplicate"]: r["n"] for r in out.collect()}
        assert got == {True: ROWS // 3, False: ROWS - ROWS // 3}
        assert "skew=true" in final_plan(out)


def test_enrichment_splits_the_hot_merchant(spark, skewed):
    dim = spark.range(5000).select(F.concat(F.lit("M"), F.col("id").cast("string")).alias("merchant_id"), F.col("id").alias("name"))
    with settings(spark, **SMALL_LIMITS):
        out = enrich(skewed, dim, "merchant_id").groupBy("quality_flag").agg(F.count("*").alias("n"), F.max("note"))
        assert {r["quality_flag"]: r["n"] for r in out.collect()} == {"CLEAN": ROWS}
        assert "skew=true" in final_plan(out)


def test_dedup_sends_one_row_per_task_for_the_hot_key(spark, skewed):
    best = latest_per_key(skewed.where("transaction_id = 'hot'"), ["transaction_id"], [F.desc("v")])
    assert best.count() == 1 and best.first()["v"] == ROWS - 3
    assert "WindowGroupLimit" in final_plan(best)


def test_suite_and_profile_stay_whole(spark, skewed):
    checks = [quality.Check("unique", "transaction_id"), quality.Check("not_null", "merchant_id")]
    got = {r["check_name"]: r["value"] for r in quality.run_suite(skewed, checks).collect()}
    assert got == {"unique": float(ROWS // 3), "not_null": 0.0}
    seen = {r["column_name"]: (r["total_rows"], r["unique_count"]) for r in quality.profile(skewed, ["transaction_id", "merchant_id"]).collect()}
    assert seen["transaction_id"] == (ROWS, ROWS - ROWS // 3 + 1)
    assert seen["merchant_id"][0] == ROWS


def test_user_model_from_sql(spark):
    from paylens.functions.udf import register_model

    register_model(spark, "shout", lambda s: s.str.upper(), "string")
    assert spark.sql("SELECT shout('ok') AS t").first()["t"] == "OK"
