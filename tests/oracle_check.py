"""Run every registered query on Spark and its oracle on DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
Mirrors the driver's check: row count, column names, order-insensitive values
(floats rounded to 9 significant digits).
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from starloom.plans.standin import TABLES  # noqa: E402
from starloom.session import build_session  # noqa: E402


def _norm(v):
    if isinstance(v, (datetime.date, datetime.datetime)) or hasattr(v, "to_pydatetime"):
        ts = v.to_pydatetime() if hasattr(v, "to_pydatetime") else v
        if isinstance(ts, datetime.datetime):
            return ts.isoformat(sep=" ").removesuffix(" 00:00:00") if ts.time() == datetime.time(0) else ts.isoformat(sep=" ")
        return ts.isoformat()
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(sdf, ddf):
    scols, dcols = sorted(sdf.columns), sorted(ddf.columns)
    if scols != dcols:
        return f"columns differ: spark={sorted(sdf.columns)} duck={sorted(ddf.columns)}"
    if len(sdf) != len(ddf):
        return f"row count spark={len(sdf)} duck={len(ddf)}"
    srows = sorted((tuple(_norm(None if (isinstance(x, float) and False) else x) for x in r)
                    for r in sdf[scols].astype(object).where(sdf[scols].notna(), None).itertuples(index=False)), key=_key)
    drows = sorted((tuple(_norm(x) for x in r)
                    for r in ddf[dcols].astype(object).where(ddf[dcols].notna(), None).itertuples(index=False)), key=_key)
    for a, b in zip(srows, drows):
        if a != b:
            return f"first differing row:\n  spark={a}\n  duck ={b}"
    return None


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, oracles = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and not any(o in name for o in only):
            continue
        t = time.time()
        try:
            sdf = fn(spark, sf).toPandas()
        except Exception as e:  # report and continue
            print(f"FAIL {name}: spark error {str(e)[:400]}")
            bad += 1
            continue
        st = time.time() - t
        if name not in oracles:
            print(f"ROWS {name}: {len(sdf)} rows (no oracle) {st:.1f}s")
            continue
        try:
            ddf = con.execute(oracles[name]).df()
        except Exception as e:
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        msg = compare(sdf, ddf)
        if msg:
            bad += 1
            print(f"FAIL {name}: {msg}")
        else:
            print(f"OK   {name}: {len(sdf)} rows {st:.1f}s")
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
