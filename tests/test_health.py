"""Health queries over tables of a few rows."""

import datetime
import decimal

import pytest

from paylens.operators import aggregates as agg
from paylens.plans import increment, medallion
from paylens.queries import lifecycle


@pytest.fixture
def folder(spark, tmp_path):
    day = datetime.datetime(2001, 11, 4)
    lines = [(i, 1, 1, 1, 1.0, 10.0, 0.0, 0.0, "A", "O", day) for i in range(1, 41)]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "orders": ([(i, 7, "2-HIGH") for i in range(1, 41)], "o_orderkey long, o_custkey long, o_orderpriority string"),
        "supplier": ([(1, "S", 0)], "s_suppkey long, s_name string, s_nationkey int"), "nation": ([(0, "N")], "n_nationkey int, n_name string"),
        "events": ([(1, datetime.datetime(2024, 1, 1, 1)), (2, datetime.datetime(2024, 1, 1, 2))], "event_id long, ts timestamp_ntz"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_health_takes_a_whole_load(spark, folder, monkeypatch):
    runs, whole = [], lifecycle.run_recorded
    monkeypatch.setattr(lifecycle, "run_recorded", lambda *a, **k: runs.append(whole(*a, **k)))
    found = {r["objective"]: (r["value"], r["met"]) for r in lifecycle.x06(spark, folder).collect()}
    assert runs == ["SUCCESS"] and found["load"] == (100.0, True) and found["runtime"] == (60.0, True)
    late = "'x' AS run_id, 'SUCCESS' AS status, '' AS error, 40L AS rows_in, 40L AS rows_valid, 40L AS rows_out, TIMESTAMP '2024-01-01 00:00:00' AS started, TIMESTAMP '2024-01-01 02:01:00' AS ended"
    monkeypatch.setattr(lifecycle, "run_record", lambda spark, sf, run_id: spark.sql(f"SELECT {late}"))
    assert {r["rule"]: r["fired"] for r in lifecycle.x07(spark, folder).collect()}["load_failed"]
    assert lifecycle.x10(spark, folder).first()["status"] == "CRITICAL"


def test_daily_revenue_counts_merchants_without_hash_tables(spark):
    day = datetime.date(2024, 1, 1)
    rows = [(day, "a", 1.5, 2, 0.5, 10.0), (day, "a", 1.5, 2, 0.5, 10.0), (day, "b", 1.0, 1, 0.0, None), (day, None, 2.0, 1, 0.0, 40.0), (None, "a", 3.0, 1, 0.0, 0.0)]
    gmv = spark.createDataFrame(rows, "transaction_date date, merchant_id string, gmv double, transaction_count long, failed_amount double, failure_rate_pct double")
    found = agg.daily_revenue(gmv)
    assert {tuple(r) for r in found.collect()} == {(day, 6.0, 6, 2, 1.0, 20.0), (None, 3.0, 1, 1, 0.0, 0.0)}
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate(") == 2, plan


def test_a_grouping_is_not_shuffled_again_before_it_is_written(spark, tmp_path, monkeypatch):
    gathered = []
    put, replace = increment._put, medallion.replace_partitions
    monkeypatch.setattr(increment, "_put", lambda *a, gather=False: gathered.append((a[2], gather)) or put(*a, gather=gather))
    monkeypatch.setattr(medallion, "replace_partitions", lambda df, path, by, fmt="parquet", gather=True: gathered.append((path.rsplit("/", 1)[1], gather)) or replace(df, path, by, fmt, gather))
    txn = "transaction_id string, amount decimal(18,2), status string, merchant_id string, customer_id string, transaction_date date, payment_method string, k long, ingestion_timestamp timestamp_ntz"
    at = datetime.datetime(2024, 1, 2)
    rows = [(f"t{i % 8}", decimal.Decimal(i), "COMPLETED", "M1", f"c{i % 3}", datetime.date(2024, 1 + i % 2, 1), "UPI", i, at) for i in range(12)]
    merchants = spark.createDataFrame([("M1", "one", "Travel", "X")], "merchant_id string, merchant_name string, category string, city string")
    bronze = spark.createDataFrame(rows, txn)
    increment.run_batch(spark, bronze, merchants, f"{tmp_path}/batches", 1)
    medallion.run(spark, bronze, merchants, f"{tmp_path}/whole", grain="month")
    wide = {name for name, moved in gathered if moved}
    assert wide == {"silver", "daily_summary"}
    for name in ("silver", "merchant_performance", "daily_summary"):
        whole = spark.read.parquet(f"{tmp_path}/whole/{name}").drop("month")
        assert sorted(map(str, increment.read(spark, f"{tmp_path}/batches", name).select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
