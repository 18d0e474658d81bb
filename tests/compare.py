"""Run registered queries and compare them with their SQL statements in DuckDB.

``python tests/compare.py [sf] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from __spark_entry__ import oracle_sql, queries


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(names: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    start = time.time()
    df = queries()[name](spark, sf_dir)
    got = df.collect()
    took = time.time() - start
    sql = oracle_sql().get(name)
    if sql is None:
        return True, f"rows only ({len(got)}) {took:.2f}s"
    relation = con.execute(sql)
    columns = [d[0] for d in relation.description]
    want = relation.fetchall()
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if a == b:
        types = " ".join(f"{c}:{t}" for c, t in df.dtypes)
        return True, f"{len(a)} rows {took:.2f}s" + (f"  [{types}]" if os.environ.get("TYPES") else "")
    diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
    return False, f"rows {len(a)} vs {len(b)}; columns {sorted(columns)}; first differences {diff}"


if __name__ == "__main__":
    from skyweave.session import build_session

    sf = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    session = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    duck = connect(sf)
    bad = 0
    for key in sys.argv[2:] or queries():
        try:
            ok, note = compare(session, duck, sf, key)
        except Exception as exc:  # report and go on
            ok, note = False, f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += not ok
        print("ok  " if ok else "FAIL", key, note, flush=True)
    print("failures:", bad)
