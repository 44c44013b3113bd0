"""Run registered Spark queries and their DuckDB oracle side by side.

Usage: python tests/oracle_harness.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
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
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def rows_spark(df):
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, sorted(out, key=_key)


def rows_duck(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in data]
    return cols, sorted(out, key=_key)


def close(a, b) -> bool:
    if len(a) != len(b):
        return False
    for x, y in zip(a, b):
        if isinstance(x, float) or isinstance(y, float):
            if x is None or y is None:
                return x is None and y is None
            if not math.isclose(float(x), float(y), rel_tol=1e-7, abs_tol=1e-9):
                return False
        elif x != y:
            return False
    return True


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sc, sr = rows_spark(fn(spark, sf_dir))
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(sr), spark_s=round(t1 - t0, 2), note="rows-only")
    dc, dr = rows_duck(con, sql)
    if sc != dc:
        return dict(name=name, ok=False, note=f"columns differ: {sc} vs {dc}")
    if len(sr) != len(dr):
        return dict(name=name, ok=False, note=f"row count {len(sr)} vs {len(dr)}")
    bad = [(a, b) for a, b in zip(sr, dr) if not close(a, b)]
    return dict(name=name, ok=not bad, rows=len(sr), spark_s=round(t1 - t0, 2),
                note=f"{len(bad)} rows differ, first {bad[:2]}" if bad else "")


def main(argv):
    from clipstat.session import local_session
    import __spark_entry__ as E

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    pats = argv[1:]
    spark = local_session(8)
    qs, orc = E.queries(), E.oracle_sql()
    fails = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            r = compare(spark, duck(sf_dir), name, fn, orc.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=name, ok=False, note=f"{type(e).__name__}: {str(e)[:400]}")
        fails += r["ok"] is False
        print(r, flush=True)
    print(f"FAILED {fails}" if fails else "ALL OK")
    return fails


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
