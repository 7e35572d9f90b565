"""Run registered queries on Spark and their SQL on DuckDB, compare like the driver does.

usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from lathe.session import get_spark  # noqa: E402
from lathe.sources.files import TABLES  # noqa: E402
import __spark_entry__ as E  # noqa: E402


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in args if not a.startswith("/")]
    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = os_.get(name)
        if sql is None:
            print(f"ROWS  {name}: {len(rows)} rows ({ts:.1f}s) no oracle")
            continue
        try:
            cur = con.execute(sql)
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        c1, r1 = canon(cols, rows)
        c2, r2 = canon(ocols, orows)
        if c1 != c2:
            print(f"FAIL  {name}: columns {c1} vs {c2}")
            bad += 1
        elif r1 != r2:
            s1, s2 = set(r1), set(r2)
            diff = [x for x in r1 if x not in s2][:3]
            diff2 = [x for x in r2 if x not in s1][:3]
            print(f"FAIL  {name}: rows {len(r1)} vs {len(r2)}; spark-only {diff}; oracle-only {diff2}")
            bad += 1
        else:
            print(f"OK    {name}: {len(rows)} rows ({ts:.1f}s)")
    print(f"failures: {bad}")
    spark.stop()


if __name__ == "__main__":
    main()
