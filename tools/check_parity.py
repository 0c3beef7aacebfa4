"""Run every registered query in Spark and its oracle in DuckDB; compare.

Usage: python tools/check_parity.py [sf_dir] [name ...]
Compares row count, column names and values (order-insensitive, floats to
1e-9 relative). Prints one line per query and a summary.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, float(f"{v:.10g}"))
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return (3, int(v))
    if isinstance(v, int):
        return (2, float(v))
    return (4, str(v))


def rows_of(records, cols):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in records)


def close(a, b):
    if a[0] != b[0]:
        return False
    if a[0] == 2:
        x, y = a[1], b[1]
        return x == y or abs(x - y) <= 1e-9 * max(abs(x), abs(y), 1e-12)
    return a == b


def compare(spark_df, con, sql):
    t0 = time.time()
    srows = [r.asDict(recursive=True) for r in spark_df.collect()]
    scols = sorted(spark_df.columns)
    t1 = time.time()
    rel = con.sql(sql)
    ocols = sorted(rel.columns)
    orows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    if scols != ocols:
        return False, f"columns differ: spark-only={set(scols)-set(ocols)} oracle-only={set(ocols)-set(scols)}", t1 - t0
    if len(srows) != len(orows):
        return False, f"rows {len(srows)} vs {len(orows)}", t1 - t0
    a, b = rows_of(srows, scols), rows_of(orows, scols)
    for ra, rb in zip(a, b):
        if not all(close(x, y) for x, y in zip(ra, rb)):
            diff = [(c, x, y) for c, x, y in zip(scols, ra, rb) if not close(x, y)]
            return False, f"value mismatch e.g. {diff[:3]}", t1 - t0
    return True, f"{len(srows)} rows", t1 - t0


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from cardlens.plans.queries import ORACLE, QUERIES
    from cardlens.session import get_session

    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    ok = bad = 0
    for name, fn in QUERIES.items():
        if names and name not in names:
            continue
        sql = ORACLE.get(name)
        try:
            df = fn(spark, sf_dir)
            if sql is None:
                n = df.count()
                print(f"ROWS  {name}: {n} rows (no oracle)")
                continue
            good, msg, secs = compare(df, con, sql)
        except Exception as exc:  # noqa: BLE001
            good, msg, secs = False, f"ERROR {type(exc).__name__}: {str(exc)[:400]}", 0
        ok += good
        bad += not good
        print(f"{'OK  ' if good else 'FAIL'}  {name}: {msg} ({secs:.2f}s)", flush=True)
    print(f"SUMMARY ok={ok} fail={bad}")


if __name__ == "__main__":
    main()
