"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Comparison: same column names, same row count, same multiset of rows
(values rendered as text, columns sorted by name), as the driver does.

    python tests/oracle_check.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from wishrank.sources.tables import TABLES, table_path  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "\0NULL"
    if isinstance(v, float) and v.is_integer():
        v = int(v)
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, con, sf_dir: str, key: str) -> dict:
    t0 = time.time()
    df = entry.queries()[key](spark, sf_dir)
    s_cols = df.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in df.collect()])
    t1 = time.time()
    res = con.execute(entry.oracle_sql()[key])
    o_cols = [d[0] for d in res.description]
    o_rows = rows_of(o_cols, res.fetchall())
    t2 = time.time()
    out = {
        "key": key,
        "spark_rows": len(s_rows),
        "oracle_rows": len(o_rows),
        "cols_match": sorted(s_cols) == sorted(o_cols),
        "values_match": s_rows == o_rows,
        "spark_s": round(t1 - t0, 2),
        "oracle_s": round(t2 - t1, 2),
    }
    if not out["cols_match"]:
        out["cols"] = (s_cols, o_cols)
    if not out["values_match"]:
        ss, oo = set(s_rows), set(o_rows)
        out["only_spark"] = list(ss - oo)[:3]
        out["only_oracle"] = list(oo - ss)[:3]
    return out


def main(argv):
    from wishrank.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(entry.oracle_sql())
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        r = compare(spark, con, sf_dir, k)
        ok = r["cols_match"] and r["values_match"]
        bad += not ok
        print(("OK  " if ok else "FAIL"), r, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
