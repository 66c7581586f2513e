"""Run registered queries in Spark and their DuckDB oracle side by side.

python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)          # exact bits, and -0.0 differs from 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, int) and not isinstance(v, bool):
        return v
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(rec[i]) for i in order) for rec in records]
    return cols, sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_records = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    d_columns = [d[0] for d in cur.description]
    d_records = cur.fetchall()
    t2 = time.time()
    s_cols, s_rows = rows_of(sdf.columns, s_records)
    d_cols, d_rows = rows_of(d_columns, d_records)
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns {s_cols} vs {d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows {len(s_rows)} vs {len(d_rows)}")
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    types = [(f.name, f.dataType.simpleString()) for f in sdf.schema.fields]
    return problems, len(s_rows), t1 - t0, t2 - t1, types, [(d[0], str(d[1])) for d in cur.description]


def main(argv):
    from phenoscope.session import get_session
    import __spark_entry__ as E
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_session(os.environ.get("ORACLE_MASTER", "local[8]"), 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            n = df.count()
            print(f"{name:28s} rows-only  rows={n}")
            continue
        try:
            problems, n, ts, td, st, dt = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as exc:  # report and go on
            problems, n, ts, td, st, dt = [f"error {type(exc).__name__}: {str(exc)[:400]}"], -1, 0, 0, [], []
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        print(f"{name:28s} {status} rows={n} spark={ts:.1f}s duck={td:.2f}s {'; '.join(problems)}")
        if problems and st:
            print("    spark types:", st)
            print("    duck  types:", dt)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
