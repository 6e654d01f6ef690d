"""Run registered queries against their DuckDB oracle (like the driver).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive multiset of
rows. Floats are compared exactly and, separately, after rounding to 9
significant digits (reported as ``approx``).
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, approx: bool):
    if v is None:
        return None
    try:
        import pandas as pd
        if v is pd.NaT or v is pd.NA:
            return None
    except Exception:  # pragma: no cover
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if approx and v != 0 and math.isfinite(v):
            return float(f"{v:.9g}")
        return v
    if hasattr(v, "item"):
        return _norm(v.item(), approx)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(pdf, approx: bool):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x, approx) for x in rec))
    return cols, sorted(out, key=repr)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sp = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    ok = con.execute(sql).df()
    res = {"name": name, "spark_rows": len(sp), "oracle_rows": len(ok), "sec": round(t1 - t0, 2)}
    c1, r1 = rows_of(sp, False)
    c2, r2 = rows_of(ok, False)
    res["schema"] = c1 == c2
    res["exact"] = res["schema"] and r1 == r2
    _, a1 = rows_of(sp, True)
    _, a2 = rows_of(ok, True)
    res["approx"] = res["schema"] and a1 == a2
    if not res["approx"]:
        res["cols"] = (c1, c2)
        if res["schema"]:
            s1, s2 = set(a1), set(a2)
            res["only_spark"] = sorted(s1 - s2, key=repr)[:3]
            res["only_oracle"] = sorted(s2 - s1, key=repr)[:3]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from reelmart.session import local_session
    spark = local_session(8, 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name}: no oracle (rows {fn_rows(spark, qs[name], sf_dir)})")
            continue
        try:
            r = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and continue
            bad += 1
            print(f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        flag = "OK " if r["exact"] else ("~OK" if r["approx"] else "BAD")
        bad += 0 if r["approx"] else 1
        print(f"{flag} {name}: rows {r['spark_rows']}/{r['oracle_rows']} {r['sec']}s"
              + ("" if r["approx"] else f" {r.get('cols')} spark={r.get('only_spark')} "
                 f"oracle={r.get('only_oracle')}"))
    print("failures:", bad)
    return bad


def fn_rows(spark, fn, sf_dir):
    return fn(spark, sf_dir).count()


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
