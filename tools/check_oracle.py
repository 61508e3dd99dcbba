"""Run registered queries in Spark and their SQL oracles in DuckDB; compare.

    python tools/check_oracle.py [--sf-dir DIR] [key ...]

Reports per key: rows (spark/duckdb), column names, exact value match
(order-insensitive multiset of rows, columns sorted by name) and a match
with floats rounded to 6 decimals.  Keys without an oracle are run and their
row count printed.
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from sparkdeck.plans.bindings import TABLES  # noqa: E402
from sparkdeck.plans.registry import ORACLES, QUERIES, load_all  # noqa: E402
from sparkdeck.session import build_session  # noqa: E402


def _norm(v, digits):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) if digits is not None else v
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _bag(rows, cols, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i], digits) for i in order) for r in rows)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--plain-session", action="store_true",
                    help="use SparkSession defaults (as a driver might) instead of build_session")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    load_all()
    keys = a.keys or list(QUERIES)
    if a.plain_session:
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session(shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf_dir}/{t}.parquet')")
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            df = QUERIES[k](spark, a.sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{k:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in ORACLES:
            print(f"{k:28s} rows={len(rows):7d} (no oracle) {ts:.1f}s cols={cols}")
            continue
        try:
            res = con.execute(ORACLES[k])
            dcols = [x[0] for x in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{k:28s} SQL-ERROR {str(e)[:300]}")
            bad += 1
            continue
        same_cols = sorted(cols) == sorted(dcols)
        exact = same_cols and _bag(rows, cols, None) == _bag(drows, dcols, None)
        approx = same_cols and _bag(rows, cols, 6) == _bag(drows, dcols, 6)
        ok = same_cols and len(rows) == len(drows) and exact
        bad += 0 if ok else 1
        print(f"{k:28s} {'OK ' if ok else 'BAD'} rows={len(rows)}/{len(drows)} cols={'same' if same_cols else (cols, dcols)}"
              f" exact={exact} approx6={approx} {ts:.1f}s")
        if not exact and same_cols:
            sb, db = _bag(rows, cols, None), _bag(drows, dcols, None)
            print("   spark-only:", list((sb - db).items())[:3])
            print("   duck-only: ", list((db - sb).items())[:3])
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
