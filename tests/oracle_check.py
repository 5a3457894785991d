"""Run registered Spark queries next to their DuckDB oracle and compare.

    python -m tests.oracle_check [--sf DIR] [name ...]

Comparison: same column names (sorted), same row count, and the same multiset
of rows after rounding floats to 6 places.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import numpy as np
import pandas as pd

from kestrel.sources.tables import TABLES


def duck(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.sql(sql).df()


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, (np.floating,)):
        return _norm(float(v))
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.bool_,)):
        return bool(v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if v is pd.NaT:
        return None
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    return v


def rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return cols, sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df: pd.DataFrame, duck_df: pd.DataFrame):
    sc, sr = rows(spark_df)
    dc, dr = rows(duck_df)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} duck={len(dr)}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ, first: spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{len(sr)} rows match"


def main(argv=None):
    import argparse
    from kestrel.session import get_spark
    from kestrel.catalog import QUERIES
    from kestrel.oracle_sql import ORACLE
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    spark = get_spark("local[8]", 8)
    names = a.names or sorted(QUERIES)
    failed = 0
    for n in names:
        t0 = time.time()
        try:
            s = QUERIES[n](spark, a.sf).toPandas()
        except Exception as e:  # report and go on
            print(f"FAIL  {n}: spark error {type(e).__name__}: {str(e)[:400]}", flush=True)
            failed += 1
            continue
        t1 = time.time()
        if n not in ORACLE:
            print(f"ROWS  {n}: {len(s)} rows (no oracle) spark {t1 - t0:.1f}s", flush=True)
            continue
        try:
            d = duck(ORACLE[n], a.sf)
        except Exception as e:
            print(f"FAIL  {n}: duck error {str(e)[:400]}", flush=True)
            failed += 1
            continue
        ok, msg = compare(s, d)
        failed += 0 if ok else 1
        print(f"{'OK   ' if ok else 'FAIL '} {n}: {msg} (spark {t1 - t0:.1f}s)", flush=True)
    print(f"{len(names) - failed}/{len(names)} passed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
