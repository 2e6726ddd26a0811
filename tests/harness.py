"""Spark result vs DuckDB oracle: row count, column names, multiset of values.

Usage: ``python tests/harness.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, f"{v:.9g}")
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (1, f"{float(v):.9g}") if abs(v) < 2**53 else (1, str(v))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return (3, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (4, repr([_norm(x) for x in v]))
    return (5, str(v))


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return cols, out


def compare(spark, name: str, sf_dir: str, fn, sql: str, con=None) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    con = con or duck(sf_dir)
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    scols, s = canon(df.columns, srows)
    dc, d = canon(dcols, drows)
    ok = scols == dc and s == d
    plan = df._jdf.queryExecution().executedPlan().toString()
    info = {"name": name, "ok": ok, "spark_rows": len(srows), "oracle_rows": len(drows),
            "spark_sec": round(t1 - t0, 2), "cartesian": plan.count("CartesianProduct")}
    if scols != dc:
        info["columns"] = (scols, dc)
    elif not ok:
        ss, dd = set(s), set(d)
        info["only_spark"] = sorted(ss - dd)[:3]
        info["only_oracle"] = sorted(dd - ss)[:3]
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from docrel.session import get_session
    import __spark_entry__ as E
    spark = get_session("local[8]", 8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in (names or list(qs)):
        try:
            info = compare(spark, n, sf_dir, qs[n], sqls[n], con) if n in sqls else {"name": n, "ok": None}
        except Exception as e:  # report and go on
            info = {"name": n, "ok": False, "error": repr(e)[:400]}
        bad += info["ok"] is False
        print(info, flush=True)
    print(f"{len(names or qs) - bad} ok / {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
