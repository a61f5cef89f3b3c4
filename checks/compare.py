"""Compare every query with its SQL on one scale: ``python -m checks.compare /path/to/tables [key ..]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            db.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return db


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows in order; numbers as they are."""
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype == object:
            if any(isinstance(v, (int, float)) for v in df[c].dropna().head(5)):
                df[c] = df[c].astype(float)
        elif str(df[c].dtype).startswith("Int") or df[c].dtype.kind in "iu":
            df[c] = df[c].astype(float)
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}"
    a, b = canonical(got), canonical(want)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = same.idxmin()
            return f"column {c}: {int((~same).sum())} differ, first {a[c][i]!r} != {b[c][i]!r}"
    return None


def check(spark, db, key: str, sf_dir: str) -> str | None:
    return differences(QUERIES[key](spark, sf_dir).toPandas(), db.execute(ORACLE[key]).df())


def main() -> int:
    from checks.session import local_session

    sf_dir, keys = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, db, bad = local_session(), connect(sf_dir), 0
    for key in keys:
        t0 = time.time()
        got = QUERIES[key](spark, sf_dir).toPandas()
        t1 = time.time()
        if key not in ORACLE:
            print(f"{key:24s} no SQL, {len(got)} rows {t1 - t0:6.2f}s", flush=True)
            continue
        try:
            diff = differences(got, db.execute(ORACLE[key]).df())
        except duckdb.Error as e:
            diff = f"SQL error {str(e)[:400]}"
        bad += diff is not None
        print(f"{key:24s} {'ok' if diff is None else diff} [{len(got)}] {t1 - t0:.2f}s / {time.time() - t1:.2f}s", flush=True)
    print(f"{bad} of {len(keys)} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
