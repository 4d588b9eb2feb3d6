"""Runs queries on Spark and in DuckDB and compares rows, column names and types.

As a program: ``python tests/oracle.py <folder> [name ...]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pyarrow as pa

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(df, con, sql: str) -> str:
    """Empty string when equal, else what differs."""
    got = df.toArrow()
    want = con.sql(sql).to_arrow_table()
    names = sorted(got.column_names)
    if names != sorted(want.column_names):
        return f"columns: only spark {set(names) - set(want.column_names)}, only sql {set(want.column_names) - set(names)}"
    kinds = []
    for n in names:
        a, b = got.schema.field(n).type, want.schema.field(n).type
        a, b = (pa.string() if pa.types.is_large_string(t) else t for t in (a, b))
        if a != b:
            kinds.append(f"{n}: {a} vs {b}")
    if kinds:
        return "types: " + ", ".join(kinds)
    if got.num_rows != want.num_rows:
        return f"rows: spark {got.num_rows}, sql {want.num_rows}"
    con.register("got_rows", got)
    con.register("want_rows", want)
    cols = ", ".join(f'"{n}"' for n in names)
    try:
        extra = [con.execute(f"SELECT {cols} FROM {x} EXCEPT ALL SELECT {cols} FROM {y} ORDER BY ALL").fetchall()
                 for x, y in (("got_rows", "want_rows"), ("want_rows", "got_rows"))]
    finally:
        con.unregister("got_rows")
        con.unregister("want_rows")
    if extra[0] or extra[1]:
        return f"values: {len(extra[0])} differ, {names}\n   spark {extra[0][:1]}\n   sql   {extra[1][:1]}"
    return ""


def main(folder: str, names: list[str]) -> int:
    from tillcast.plans import QUERIES, SQL
    from tillcast.session import local_session

    spark = local_session(8, "oracle", shuffle_partitions=8)
    con = connect(folder)
    bad = 0
    for name in names or list(QUERIES):
        t0 = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in SQL:
                n, why = "", compare(df, con, SQL[name])
            else:
                rows = df.toArrow().num_rows
                n, why = f" rows-only {rows}", ""
        except Exception as e:  # report and go on with the next query
            n, why = "", f"{type(e).__name__}: {str(e)[:900]}"
        bad += bool(why)
        print(f"{'FAIL' if why else 'ok  '} {name} {time.time() - t0:.1f}s{n} {why}", flush=True)
        spark.catalog.clearCache()
    print(f"{bad} failed of {len(names or QUERIES)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
