"""Run registered queries in Spark and their oracle SQL in DuckDB; compare
row counts, column names and order-insensitive values (doubles to 1e-6)."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, names, sf_dir, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names:
        t = time.time()
        df = qs[name](spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        ts = time.time() - t
        rel = con.sql(sqls[name])
        dcols = rel.columns
        drows = rel.fetchall()
        ok_cols = sorted(scols) == sorted(dcols)
        a, b = canon(scols, srows), canon(dcols, drows)
        ok = ok_cols and len(a) == len(b) and a == b
        results[name] = ok
        if verbose:
            print(f"{name:22s} spark={len(srows):6d} duck={len(drows):6d} cols={'ok' if ok_cols else 'DIFF'} "
                  f"{'MATCH' if ok else 'MISMATCH'} {ts:.1f}s", flush=True)
            if not ok_cols:
                print("   spark:", scols, "\n   duck: ", dcols)
            elif not ok:
                sa, sb = set(a), set(b)
                print("   only spark:", list(sa - sb)[:3])
                print("   only duck: ", list(sb - sa)[:3])
    return results


if __name__ == "__main__":
    from shopfloor.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    import __spark_entry__ as E
    names = sys.argv[2:] or list(E.queries())
    res = compare(spark, names, sf)
    print(sum(res.values()), "/", len(res), "match")
