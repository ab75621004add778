"""Compare every query with its SQL on DuckDB: python check.py [folder] [name ...]"""

from __future__ import annotations

import importlib
import os
import sys
import time

import duckdb
import pandas as pd

from tastegraph.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    columns = []
    for name in frame.columns:
        values = frame[name]
        if pd.api.types.is_float_dtype(values):
            columns.append(["NULL" if pd.isna(v) else repr(float(v)) for v in values])
        else:
            columns.append(["NULL" if v is None or v is pd.NA or (isinstance(v, float) and v != v) else str(v) for v in values])
    return sorted(zip(*columns))


def compare(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"COLUMNS {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"ROWS {len(spark_frame)} / {len(sql_frame)}"
    kinds = {
        c: (str(spark_frame[c].dtype), str(sql_frame[c].dtype))
        for c in spark_frame.columns
        if spark_frame[c].dtype.kind != sql_frame[c].dtype.kind and "O" not in (spark_frame[c].dtype.kind + sql_frame[c].dtype.kind)
    }
    if kinds:
        return f"TYPES {kinds}"
    a, b = normal(spark_frame), normal(sql_frame)
    if a == b:
        return "ok"
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    return f"VALUES {len(diff)} differ, first {str(diff[0])[:600]}"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    modules = [m for m in wanted if m.startswith("@")]
    if modules:
        loaded = [importlib.import_module(f"tastegraph.plans.{m[1:]}_queries") for m in modules]
        queries = {k: v for m in loaded for k, v in m.QUERIES.items()}
        oracles = {k: v for m in loaded for k, v in m.ORACLES.items()}
    else:
        from tastegraph.plans import all_oracles, all_queries

        queries, oracles = all_queries(), all_oracles()
    wanted = [w for w in wanted if not w.startswith("@")] or list(queries)
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    con = connect(folder)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            got = queries[name](spark, folder).toPandas()
            took = time.time() - start
            start = time.time()
            if name in oracles:
                result = compare(got, con.execute(oracles[name]).fetchdf())
            else:
                result = "rows only" if len(got) else "NO ROWS"
        except Exception as error:  # report and go on with the next query
            result, took, got = f"ERROR {str(error)[:1500]}", time.time() - start, []
        failed += result not in ("ok", "rows only")
        print(f"{name:28s} {len(got):8d} rows {took:6.1f}s sql {time.time() - start:5.1f}s  {result}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
