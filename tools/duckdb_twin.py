"""Times the headline queries and their SQL in one session on one machine.

Spark runs as ``bench.py`` runs it; DuckDB runs each query's own SQL from
``oracle_sql()`` on the same files, with as many threads.  Both: one warm-up,
then the median of three runs.  Prints one JSON line.

    python tools/duckdb_twin.py [--sf DIR] [--cpus N]
"""

from __future__ import annotations

import argparse
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE, timed  # noqa: E402


def main() -> None:
    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="/root/testdata/sf0.1")
    p.add_argument("--cpus", type=int, default=8)
    args = p.parse_args()

    import duckdb

    from tickwise.catalog import QUERIES, SQL
    from tickwise.session import build_session
    from tickwise.sources.fixtures import TABLES

    con = duckdb.connect(config={"threads": args.cpus})
    for t in TABLES:
        path = f"{args.sf}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    spark = build_session(master=f"local[{args.cpus}]", shuffle_partitions=args.cpus)
    out = {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):
            t0 = time.perf_counter()
            con.execute(f"CREATE OR REPLACE TEMP TABLE _out AS {SQL[name]}")
            runs.append(time.perf_counter() - t0)
        out[name] = {"spark": timed(spark, QUERIES[name], args.sf), "duckdb": round(statistics.median(runs[1:]), 3)}
    print(json.dumps({"sf": args.sf, "cpus": args.cpus, "queries": out,
                      "sum": {k: round(sum(v[k] for v in out.values()), 3) for k in ("spark", "duckdb")}}))


if __name__ == "__main__":
    main()
