"""Spark-vs-DuckDB comparison in the shape of the correctness gate:
row count, column names, order-insensitive value hash.

    python -m tests.oracle_harness /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(base, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        try:
            v = v.item()
        except Exception:
            pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr), [columns[i] for i in order]


def digest(rows) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update(repr(r).encode())
    return h.hexdigest()[:16]


def compare(spark, con, name, fn, sql, base):
    t0 = time.time()
    sdf = fn(spark, base)
    s_cols = sdf.columns
    s_rec = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    d = con.execute(sql)
    d_cols = [c[0] for c in d.description]
    d_rec = d.fetchall()
    s_rows, s_names = rows_of(s_cols, s_rec)
    d_rows, d_names = rows_of(d_cols, d_rec)
    ok = (len(s_rows) == len(d_rows), s_names == d_names, digest(s_rows) == digest(d_rows))
    status = "OK " if all(ok) else "BAD"
    print(f"{status} {name:28s} rows={len(s_rows)}/{len(d_rows)} cols={ok[1]} hash={ok[2]} spark={t1 - t0:.1f}s",
          flush=True)
    if not all(ok):
        if not ok[1]:
            print("   spark:", s_names, "\n   duck: ", d_names)
        else:
            sd, dd = set(s_rows), set(d_rows)
            print("   only spark:", list(sd - dd)[:3])
            print("   only duck: ", list(dd - sd)[:3])
    return all(ok)


def main(argv):
    base = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as entry
    from seclake.session import build_session
    spark = build_session("local[8]", 8, driver_memory="8g")
    if os.environ.get("HARNESS_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["HARNESS_TZ"])
    for kv in filter(None, os.environ.get("HARNESS_CONF", "").split(";")):
        k, v = kv.split("=", 1)
        spark.conf.set(k.strip(), v.strip())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(base)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = []
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            n = fn(spark, base).count()
            print(f"-- {name:28s} rows-only rows={n}", flush=True)
            continue
        try:
            if not compare(spark, con, name, fn, sqls[name], base):
                bad.append(name)
        except Exception as e:  # report and go on
            print(f"ERR {name}: {type(e).__name__}: {str(e)[:400]}", flush=True)
            bad.append(name)
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
