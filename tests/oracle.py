"""Side-by-side check of every registered query against its DuckDB oracle.

Usage: python tests/oracle.py [sf_dir] [name ...]

Rows are compared as multisets after sorting columns by name.  Two verdicts
are printed per query: ``exact`` (values equal after Decimal/float
normalisation to a canonical string) and ``close`` (floats within 1e-9
relative).  This mirrors the driver's row-count + schema + value-hash gate.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from custos.sources.tables import BASE_TABLES, table_path  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _canon(v, close: bool):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        v = float(v) if close else format(v.normalize(), "f")
        if not close:
            return v
    if isinstance(v, float):
        if close:
            return float(f"{v:.9g}")
        return repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_canon(x, close) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _canon(x, close)) for k, x in v.items()))
    return v


def rows_of(cols, rows, close):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_canon(r[i], close) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    out = {"name": name, "spark_rows": len(srows), "duck_rows": len(drows),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    out["schema"] = sorted(scols) == sorted(dcols)
    if not out["schema"]:
        out["cols"] = (sorted(scols), sorted(dcols))
        return out
    out["exact"] = rows_of(scols, srows, False) == rows_of(dcols, drows, False)
    a, b = rows_of(scols, srows, True), rows_of(dcols, drows, True)
    out["close"] = a == b
    if not out["close"]:
        out["only_spark"] = list((a - b).items())[:3]
        out["only_duck"] = list((b - a).items())[:3]
    elif not out["exact"]:
        ea, eb = rows_of(scols, srows, False), rows_of(dcols, drows, False)
        out["exact_diff"] = (list((ea - eb).items())[:2], list((eb - ea).items())[:2])
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not os.path.isdir(a)]
    import __spark_entry__ as E
    from custos.session import get_session
    spark = get_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        if name not in sqls:
            try:
                n = qs[name](spark, sf_dir).count()
                print(f"{name:32s} rows-only rows={n}")
            except Exception as e:  # noqa: BLE001
                bad += 1
                print(f"{name:32s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        try:
            r = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:32s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        ok = r.get("exact") and r["spark_rows"] == r["duck_rows"]
        bad += 0 if ok else 1
        print(f"{name:32s} {'OK ' if ok else 'BAD'} " + " ".join(f"{k}={v}" for k, v in r.items() if k != "name"))
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
