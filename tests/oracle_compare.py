"""Compare registered Spark queries with their DuckDB twins.

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of the values (exact, and with a 1e-9 relative float tolerance
reported separately).  Usable from pytest and as a script:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    import datetime
    import decimal

    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def _sort_key(row):
    return tuple((0, "") if v is None else (1, repr(v)) for v in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols, rel_tol=1e-9):
    res = {"rows_spark": len(spark_rows), "rows_duck": len(duck_rows)}
    res["cols_match"] = sorted(spark_cols) == sorted(duck_cols)
    if not res["cols_match"]:
        res["cols_spark"] = spark_cols
        res["cols_duck"] = duck_cols
        res["exact"] = res["approx"] = False
        return res
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    s = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=_sort_key)
    d = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=_sort_key)
    res["exact"] = s == d
    if res["exact"]:
        res["approx"] = True
        return res

    def close(a, b):
        if isinstance(a, float) and isinstance(b, float):
            return math.isclose(a, b, rel_tol=rel_tol, abs_tol=1e-12)
        return a == b

    ok = len(s) == len(d)
    bad = []
    if ok:
        for a, b in zip(s, d):
            if not all(close(x, y) for x, y in zip(a, b)):
                ok = False
                bad.append((a, b))
                if len(bad) >= 3:
                    break
    res["approx"] = ok
    if not ok:
        sset, dset = set(s), set(d)
        res["only_spark"] = list(sset - dset)[:3]
        res["only_duck"] = list(dset - sset)[:3]
        res["columns"] = order
    return res


def run(sf_dir: str, names=None, spark=None):
    import __spark_entry__ as E

    from marketlens.session import local_session

    spark = spark or local_session()
    con = duck_connection(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in sql:
            out[name] = {"rows_spark": len(rows), "oracle": None, "spark_sec": round(t1 - t0, 2)}
            continue
        cur = con.execute(sql[name])
        dcols = [c[0] for c in cur.description]
        drows = cur.fetchall()
        r = compare(rows, df.columns, drows, dcols)
        r["spark_sec"] = round(t1 - t0, 2)
        out[name] = r
    return out


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    res = run(sf, names)
    bad = 0
    for k, v in res.items():
        flag = "OK " if v.get("exact") else ("~  " if v.get("approx") else ("-- " if v.get("oracle", 1) is None else "BAD"))
        if flag == "BAD":
            bad += 1
        print(flag, k, {x: y for x, y in v.items() if x not in ("exact", "approx")})
    print("mismatches:", bad, "of", len(res))
