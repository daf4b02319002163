"""Run registered queries on Spark and their expected SQL on DuckDB, and compare row for row.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder, name, query, sql):
    """(message, seconds); the message is empty when both sides agree in names, types and values."""
    t = time.time()
    df = query(spark, folder)
    got_rows = [tuple(r) for r in df.collect()]
    took = time.time() - t
    if sql is None:
        return "", took, len(got_rows)
    rel = con.execute(sql)
    want_cols = [d[0] for d in rel.description]
    want_types = {d[0]: str(d[1]) for d in rel.description}
    want = _rows(want_cols, rel.fetchall())
    got = _rows(df.columns, got_rows)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}", took, len(got)
    for c, kind in df.dtypes:
        if kinds.get(kind, kind.upper()) != want_types[c]:
            return f"type of {c}: {kind} != {want_types[c]}", took, len(got)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}", took, len(got)
    for g, w in zip(got, want):
        if g != w:
            return f"{sorted(df.columns)}\n  spark {g}\n  duck  {w}", took, len(got)
    return "", took, len(got)


def main(argv):
    import __spark_entry__ as entry
    from funnelworks.session import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    if os.environ.get("PLAIN_SESSION"):  # a session as others may create it, without any of our settings
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = build_session(8)
    con = duck(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv[1:] or queries:
        try:
            message, took, n = compare(spark, con, folder, name, queries[name], sqls.get(name))
        except Exception as e:  # noqa: BLE001 - a report of all failures is wanted
            message, took, n = f"{type(e).__name__}: {str(e)[:1500]}", 0.0, 0
        bad += bool(message)
        mark = "FAIL" if message else ("ok" if name in sqls else "rows")
        print(f"{mark:4} {name:40} {n:7} rows {took:6.2f}s {message}", flush=True)
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
