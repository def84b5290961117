"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return ("~",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("f", round(v, 6))
    if isinstance(v, Decimal):
        return ("f", round(float(v), 6))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("f", float(v))
    if isinstance(v, datetime):
        return ("t", v.isoformat())
    if isinstance(v, date):
        return ("t", datetime(v.year, v.month, v.day).isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(norm(x) for x in v))
    if isinstance(v, dict):
        return ("m", tuple(sorted((str(k), norm(x)) for k, x in v.items())))
    return ("s", str(v))


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows), sorted(cols)


def main():
    from __spark_entry__ import oracle_sql, queries
    from tradeflow.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in sqls:
            print(f"NOSQL {name}: {len(srows)} rows {dt:.1f}s")
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        a, ac = rows_of(scols, srows)
        b, bc = rows_of(dcols, drows)
        if ac != bc:
            print(f"FAIL {name}: columns {ac} vs {bc}")
            bad += 1
        elif a != b:
            diff = [r for r in a if r not in set(b)][:3]
            diff2 = [r for r in b if r not in set(a)][:3]
            print(f"FAIL {name}: rows {len(a)} vs {len(b)}; spark-only {diff}; duck-only {diff2}")
            bad += 1
        else:
            print(f"OK   {name}: {len(a)} rows {dt:.1f}s")
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
