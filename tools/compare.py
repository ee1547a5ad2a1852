"""Local stand-in for the driver's correctness gate: run each registered
query on Spark and its SQL on DuckDB over the same parquet tables, compare
row count, column names and an order-insensitive hash of the values."""

from __future__ import annotations

import argparse
import hashlib
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from tickwise.catalog import QUERIES, SQL  # noqa: E402
from tickwise.session import build_session  # noqa: E402
from tickwise.sources.fixtures import TABLES  # noqa: E402


def norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith(("datetime", "date")) or df[c].map(type).astype(str).str.contains("date").any():
            df[c] = pd.to_datetime(df[c]).astype("datetime64[us]").astype(str)
    return df


def digest(df: pd.DataFrame) -> str:
    rows = sorted("|".join("None" if pd.isna(v) else repr(float(v)) if isinstance(v, float) else str(v)
                           for v in r) for r in df.itertuples(index=False))
    return hashlib.sha1("\n".join(rows).encode()).hexdigest()


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{a.sf}/{t}.parquet'")
    names = a.names or list(QUERIES)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            s = QUERIES[n](spark, a.sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: spark error {str(e)[:300]}")
            bad += 1
            continue
        t1 = time.time()
        if n not in SQL:
            print(f"rows-only {n}: {len(s)} rows  spark {t1 - t0:.1f}s")
            continue
        try:
            o = con.sql(SQL[n]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: sql error {str(e)[:300]}")
            bad += 1
            continue
        t2 = time.time()
        ok_cols = sorted(s.columns) == sorted(o.columns)
        ok_rows = len(s) == len(o)
        ok_hash = ok_cols and digest(norm(s)) == digest(norm(o))
        tag = "ok  " if ok_cols and ok_rows and ok_hash else "FAIL"
        bad += tag == "FAIL"
        print(f"{tag} {n}: rows {len(s)}/{len(o)} cols {ok_cols} hash {ok_hash}  spark {t1 - t0:.1f}s sql {t2 - t1:.1f}s")
        if tag == "FAIL" and ok_cols and ok_rows:
            a_, b_ = norm(s), norm(o)
            keys = [c for c in a_.columns if a_[c].dtype == object][:3]
            m = a_.merge(b_, on=keys, suffixes=("_s", "_o")) if keys else None
            if m is not None:
                for c in a_.columns:
                    if c in keys:
                        continue
                    x, y = m[c + "_s"], m[c + "_o"]
                    diff = ~((x == y) | (x.isna() & y.isna()))
                    if diff.any():
                        print("   col", c, int(diff.sum()), "diffs, e.g.", m.loc[diff, keys + [c + "_s", c + "_o"]].head(3).to_dict("records"))
    print("failures:", bad)


if __name__ == "__main__":
    main()
