"""Runs catalogue queries in Spark and their SQL in DuckDB and compares them
the way the driver does: same column names, same row count, same
order-insensitive multiset of values (columns sorted by name).

    python tests/oracle_harness.py [sf_dir] [name ...]
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

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SPARK_TO_DUCK = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE",
                 "StringType": "VARCHAR", "BooleanType": "BOOLEAN", "ShortType": "SMALLINT",
                 "FloatType": "FLOAT"}


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    s_cols = sdf.columns
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    d_types = [str(d[1]) for d in res.description]
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} duck={sorted(d_cols)}")
    else:
        s_types = {f.name: type(f.dataType).__name__ for f in sdf.schema.fields}
        for c, t in zip(d_cols, d_types):
            want = SPARK_TO_DUCK.get(s_types[c])
            if want and want != t:
                problems.append(f"type {c}: spark={s_types[c]} duck={t}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    elif not problems:
        a = rows_of(s_cols, s_rows)
        d_idx = [d_cols.index(c) for c in s_cols]
        b = rows_of(s_cols, [tuple(r[i] for i in d_idx) for r in d_rows])
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows), t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from pulse.session import build_session
    import __spark_entry__ as E
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            t0 = time.time()
            n = qs[name](spark, sf_dir).count()
            print(f"{name:28s} rows-only  rows={n} {time.time() - t0:.1f}s", flush=True)
            continue
        try:
            problems, n, secs = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            problems, n, secs = [f"error {type(e).__name__}: {str(e)[:400]}"], -1, 0
        bad += bool(problems)
        status = "OK " if not problems else "BAD"
        print(f"{name:28s} {status} rows={n} {secs:.1f}s {'; '.join(problems)}", flush=True)
    print(f"mismatches: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
