"""Run a registered Spark query and its DuckDB oracle side by side and compare.

Comparison: same column names, same row count, and the same multiset of rows
after normalising types (timestamps to epoch microseconds, dates to ISO text,
NaN/None to one marker). Usable from pytest and as a script:

    python tests/oracle_check.py /root/testdata/sf0.01 [ID ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm_value(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(round(v, 4))
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, dt.date):
        return v.strftime("%Y-%m-%d 00:00:00.000000")
    if hasattr(v, "item"):
        return _norm_value(v.item())
    if isinstance(v, bool):
        return str(v)
    return str(v)


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm_value(x) for x in rec))
    out.sort()
    return out


def compare(spark, con, name: str, sf_dir: str, q=None, sql=None) -> tuple[bool, str]:
    import __spark_entry__ as E
    q = q or E.queries()[name]
    sql = sql or E.oracle_sql().get(name)
    t0 = time.time()
    sdf = q(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    if sql is None:
        return True, f"{name}: rows-only {len(spdf)} ({t1 - t0:.1f}s)"
    opdf = con.execute(sql).df()
    if sorted(spdf.columns) != sorted(opdf.columns):
        return False, f"{name}: columns differ {sorted(spdf.columns)} vs {sorted(opdf.columns)}"
    if len(spdf) != len(opdf):
        return False, f"{name}: rows {len(spdf)} vs oracle {len(opdf)}"
    a, b = _rows(spdf), _rows(opdf)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"{name}: values differ, e.g. {diff}"
    return True, f"{name}: ok {len(spdf)} rows ({t1 - t0:.1f}s)"


def main(argv):
    sys.path.insert(0, ".")
    from tallyspark.session import get_session
    import __spark_entry__ as E
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
