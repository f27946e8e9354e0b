"""Run catalog queries in Spark and their SQL twins in DuckDB; compare results.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if os.environ.get("ORACLE_STRICT") == "1" else round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def rows_of(columns, records):
    cols = sorted(columns)
    idx = [list(columns).index(c) for c in cols]
    out = [tuple(_norm(r[i]) for i in idx) for r in records]
    return cols, sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    dres = con.execute(sql)
    dcols = [d[0] for d in dres.description]
    drows = dres.fetchall()
    t2 = time.time()
    scols, s = rows_of(sdf.columns, srows)
    dc, d = rows_of(dcols, drows)
    ok = scols == dc and len(s) == len(d) and s == d
    msg = ""
    if scols != dc:
        msg = f"columns differ: spark={scols} duck={dc}"
    elif len(s) != len(d):
        msg = f"rows differ: spark={len(s)} duck={len(d)}"
    elif s != d:
        diffs = [(a, b) for a, b in zip(s, d) if a != b][:3]
        msg = f"values differ, e.g. {diffs}"
    return ok, len(s), t1 - t0, t2 - t1, msg


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from carelens.session import local_session
    import __spark_entry__ as e
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"ROWS-ONLY {name:28s} rows={n} spark={time.time()-t0:.2f}s", flush=True)
            continue
        try:
            ok, n, ts, td, msg = compare(spark, con, sf_dir, name, fn, sqls[name])
        except Exception as ex:  # noqa: BLE001
            ok, n, ts, td, msg = False, -1, 0, 0, f"error: {type(ex).__name__}: {str(ex)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name:28s} rows={n} spark={ts:.2f}s duck={td:.2f}s {msg}", flush=True)
    print(f"failures: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
