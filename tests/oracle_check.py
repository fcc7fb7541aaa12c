"""Run every registered query next to its DuckDB oracle and compare.

Usage: python tests/oracle_check.py [--plain] [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of the values
(columns sorted by name, floats rounded to 6 digits).
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6))
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main(argv):
    plain = "--plain" in argv
    argv = [a for a in argv if a != "--plain"]
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from ipcforge.session import get_session

    if plain:  # a session with Spark's defaults, as an outside driver would create it
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    else:
        spark = get_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(exc)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in oracle:
            print(f"rows {name}: {len(rows)} rows ({dt:.1f}s), no oracle")
            continue
        try:
            cur = con.execute(oracle[name])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(exc)[:400]}")
            bad += 1
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ok = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and h1 == h2
        print(f"{'OK  ' if ok else 'FAIL'} {name}: {len(rows)} vs {len(orows)} rows ({dt:.1f}s)")
        if not ok:
            bad += 1
            if sorted(cols) != sorted(ocols):
                print("   columns", sorted(cols), sorted(ocols))
            s1, s2 = set(l1), set(l2)
            for x in sorted(s1 - s2)[:3]:
                print("   spark only ", x)
            for x in sorted(s2 - s1)[:3]:
                print("   oracle only", x)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
