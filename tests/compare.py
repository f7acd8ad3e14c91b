"""Run registered queries and their DuckDB oracles side by side.

Mirrors the driver's gate: row count, column names, and an order-insensitive
hash of the values (columns sorted by name, floats rounded).

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.12g}"  # sums of doubles may differ in the last digits
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):
        return norm(float(v))
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    import duckdb
    from __spark_entry__ import oracle_sql, queries
    from parcelflow.session import local_session

    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, orc = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
        ts = time.time() - t0
        if name not in orc:
            print(f"{name:40s} spark={len(rows):7d} rows-only {ts:.1f}s")
            continue
        t1 = time.time()
        res = con.execute(orc[name])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        to = time.time() - t1
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ok = len(rows) == len(orows) and sorted(cols) == sorted(ocols) and h1 == h2
        bad += not ok
        print(f"{name:40s} spark={len(rows):7d} oracle={len(orows):7d} "
              f"{'OK ' if ok else 'BAD'} {ts:.1f}s/{to:.1f}s")
        if not ok:
            if sorted(cols) != sorted(ocols):
                print("   cols", sorted(cols), sorted(ocols))
            s1, s2 = set(l1), set(l2)
            for x in sorted(s1 - s2)[:3]:
                print("   spark :", x[:300])
            for x in sorted(s2 - s1)[:3]:
                print("   oracle:", x[:300])
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
