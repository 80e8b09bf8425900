"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

    python tools/oracle_check.py [--sf /root/testdata/sf0.01] [name ...]

Comparison: same column names, same row count, and equal multisets of rows
after sorting columns by name (floats rounded to 6 significant places).
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quarry.plans import ORACLE, QUERIES, load_all  # noqa: E402
from quarry.session import get_spark  # noqa: E402
from quarry.sources.tables import TABLES  # noqa: E402


STRICT = os.environ.get("ORACLE_STRICT") == "1"   # exact float equality, no rounding


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if STRICT:
            return v
        return float(f"{v:.6g}") if v != 0 else 0.0
    if isinstance(v, decimal.Decimal):
        return norm(float(v))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE",
}


def type_diffs(df, con, sql):
    """Columns whose Spark type does not map to the DuckDB type of the oracle."""
    rel = con.sql(sql)
    duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for name, t in df.dtypes:
        want = SPARK_TO_DUCK.get(t, t.upper())
        if name in duck and duck[name] != want and not (t.startswith("decimal") and duck[name].startswith("DECIMAL")):
            out.append((name, t, duck[name]))
    return out


def spark_rows(df):
    cols = df.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(norm(r[i]) for i in order) for r in df.collect()]
    return sorted(cols), rows


def duck_rows(con, sql):
    rel = con.sql(sql)
    cols = rel.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(norm(r[i]) for i in order) for r in rel.fetchall()]
    return sorted(cols), rows


def key(r):
    return tuple((x is None, str(type(x)), str(x)) for x in r)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    load_all()
    spark = get_spark(shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    names = args.names or sorted(QUERIES)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, args.sf)
            scols, srows = spark_rows(df)
        except Exception as exc:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: spark error {type(exc).__name__}: {str(exc)[:400]}")
            traceback.print_exc(limit=3)
            continue
        ts = time.time() - t0
        if name not in ORACLE:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            dcols, drows = duck_rows(con, ORACLE[name])
        except Exception as exc:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: duckdb error {str(exc)[:400]}")
            continue
        if scols != dcols:
            bad += 1
            print(f"FAIL {name}: columns spark={scols} duck={dcols}")
            continue
        srows.sort(key=key)
        drows.sort(key=key)
        if srows != drows:
            bad += 1
            diff = [(a, b) for a, b in zip(srows, drows) if a != b][:3]
            print(f"FAIL {name}: rows spark={len(srows)} duck={len(drows)} first diffs={diff}")
            continue
        td = type_diffs(df, con, ORACLE[name])
        print(f"OK   {name}: {len(srows)} rows {ts:.1f}s" + (f"  TYPES {td}" if td else ""))
    print(f"{len(names) - bad}/{len(names)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
