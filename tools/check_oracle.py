"""Run registered queries beside their SQL in DuckDB and compare whole results.

usage: check_oracle.py [--sf DIR] [name-prefix ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if str(s.dtype).startswith("datetime64"):
            df[c] = s.astype("datetime64[us]").astype(str).replace("NaT", "<null>")
        elif s.dtype == object or str(s.dtype) in ("str", "string"):
            df[c] = s.map(lambda v: "<null>" if v is None or v is pd.NaT or (isinstance(v, float) and np.isnan(v)) else str(v))
        elif str(s.dtype).startswith("float"):
            df[c] = s.map(lambda v: "<null>" if pd.isna(v) else repr(float(v)))
        else:
            df[c] = s.map(lambda v: "<null>" if pd.isna(v) else str(v))
    return df.astype(str).sort_values(list(df.columns)).reset_index(drop=True)


def main() -> int:
    from paylens import queries
    from paylens.session import build_session

    args = sys.argv[1:]
    folder = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        folder, args = args[1], args[2:]
    spark = build_session("check", 8)
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = 0
    for name, q in queries.load().items():
        if args and not any(name.startswith(a) for a in args):
            continue
        t0 = time.time()
        try:
            frame = q.run(spark, folder)
            kinds = dict(frame.dtypes)
            plan = frame._jdf.queryExecution().executedPlan().toString()
            for word in ("CartesianProduct", "BroadcastNestedLoopJoin"):
                if word in plan:
                    print(f"PLAN  {name}: {word}", flush=True)
            got = frame.toPandas()
        except Exception as e:
            bad += 1
            print(f"ERROR {name}: {str(e)[:1500]}", flush=True)
            continue
        took = time.time() - t0
        if q.sql is None:
            print(f"rows  {name}: {len(got)} rows {took:.2f}s", flush=True)
            continue
        t0 = time.time()
        try:
            rel = con.sql(q.sql)
            types = dict(zip(rel.columns, map(str, rel.types)))
            want = rel.df()
        except Exception as e:
            bad += 1
            print(f"SQLERR {name}: {str(e)[:1500]}", flush=True)
            continue
        duck = time.time() - t0
        a, b = normal(got), normal(want)
        note = ""
        pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
        for c, k in kinds.items():
            if c in types and pairs.get(k) != types[c]:
                note += f" type {c}: {k} vs {types[c]};"
        if list(a.columns) != list(b.columns):
            bad += 1
            print(f"COLS  {name}: {list(a.columns)} vs {list(b.columns)}", flush=True)
        elif len(a) != len(b) or not a.equals(b):
            bad += 1
            print(f"DIFF  {name}: {len(a)} vs {len(b)} rows {note}", flush=True)
            m = a.merge(b, how="outer", indicator=True)
            print(m[m["_merge"] != "both"].head(6).to_string(max_colwidth=60))
        else:
            flag = "TYPES" if note else "ok   "
            if not len(a):
                flag = "EMPTY"
            print(f"{flag} {name}: {len(a)} rows {took:.2f}s (duck {duck:.2f}s){note}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
