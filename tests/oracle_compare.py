"""Run every registered query on Spark and its SQL on DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = os.environ.get("STRICT") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v) if STRICT else round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return [cols[i] for i in order], out


def digest(rows):
    return hashlib.sha1(repr(rows).encode()).hexdigest()[:12]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from pyspark.sql import SparkSession
    import __spark_entry__ as E
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", os.environ.get("DRIVER_MEMORY", "4g")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = df.collect()
            scols, srows = canon(df.columns, srows)
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in sql:
            print(f"---- {name}: spark only, rows={len(srows)} ({t1-t0:.1f}s)")
            continue
        try:
            cur = con.execute(sql[name])
            dcols = [d[0] for d in cur.description]
            dcols, drows = canon(dcols, cur.fetchall())
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        ok = scols == dcols and srows == drows
        print(f"{'ok  ' if ok else 'FAIL'} {name}: rows spark={len(srows)} duck={len(drows)} "
              f"({t1-t0:.1f}s)")
        if not ok:
            bad += 1
            if scols != dcols:
                print("   cols spark:", scols, "\n   cols duck: ", dcols)
            else:
                ss, dd = set(srows), set(drows)
                print("   spark-only:", list(ss - dd)[:3])
                print("   duck-only: ", list(dd - ss)[:3])
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
