"""Benchmark the headline queries.

Runs each query of HEADLINE on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]``: one warm-up run, then the
median of ``$BENCH_REPEATS`` (default 3) timed runs.  A run builds the
DataFrame from the parquet tables and executes it fully into Spark's
``noop`` sink (no driver collect).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "ohlcv_daily",
    "technical_panel",
    "chart_indicators",
    "leaderboard",
    "backtest_curves",
    "corr_matrix",
    "rolling_corr_30",
    "silver_rows",
    "silver_windows",
    "gold",
]


def timed(spark, fn, sf_dir: str, repeats: int = 3) -> float:
    """Median seconds of ``repeats`` runs after one warm-up; the tables that a
    run writes for itself are deleted after it."""
    from tickwise.plans.materialize import release

    def run():
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - t0
        release(spark)
        return took

    run()  # warm-up: JIT, codegen caches, file listing
    return round(statistics.median(run() for _ in range(repeats)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    os.environ.setdefault("TICKWISE_MASTER", f"local[{cpus}]")
    from tickwise.catalog import QUERIES
    from tickwise.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    times: dict[str, float] = {}
    for name in HEADLINE:
        if name not in QUERIES:
            continue
        times[name] = timed(spark, QUERIES[name], sf_dir, repeats)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "sum of median query wall time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "repeats": repeats,
    }))


if __name__ == "__main__":
    main()
