"""Run registered queries in Spark and their oracle SQL in DuckDB and compare.

Usage: python tools/compare.py [sf_dir] [name ...]

Compares, per query: column names (sorted), row count, and the multiset of
rows with floats rounded to 6 digits. Prints one line per query and a summary.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from opinari.plans.registry import ORACLE, QUERIES, load_all  # noqa: E402
from opinari.session import build_session  # noqa: E402
from opinari.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)):
        return int(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        r = round(f, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(norm(r[i]) for i in order) for r in rows]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    load_all()
    spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    ok = bad = rows_only = 0
    for name, fn in QUERIES.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in ORACLE:
            print(f"ROWS  {name}: {len(srows)} rows  {ts:.1f}s")
            rows_only += 1
            continue
        try:
            cur = con.execute(ORACLE[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        msg = []
        if sorted(scols) != sorted(dcols):
            msg.append(f"cols spark={sorted(scols)} duck={sorted(dcols)}")
        if len(srows) != len(drows):
            msg.append(f"rows spark={len(srows)} duck={len(drows)}")
        if not msg:
            a, b = Counter(rows_of(scols, srows)), Counter(rows_of(dcols, drows))
            if a != b:
                only_s = list((a - b).elements())[:2]
                only_d = list((b - a).elements())[:2]
                msg.append(f"values differ: spark-only {str(only_s)[:300]} duck-only {str(only_d)[:300]}")
        if msg:
            print(f"FAIL  {name}: " + "; ".join(msg))
            bad += 1
        else:
            print(f"OK    {name}: {len(srows)} rows  {ts:.1f}s")
            ok += 1
    print(f"summary ok={ok} fail={bad} rows_only={rows_only}")
    spark.stop()


if __name__ == "__main__":
    main()
