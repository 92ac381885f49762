"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_RUNS the timed
runs per query after one warm-up; the median counts. Results go to the no-op
sink, so all columns of all rows are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from dataclasses import replace
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from ledgerline.params import month_last_day  # noqa: E402
from ledgerline.plans.snapshot import customer_snapshot  # noqa: E402
from ledgerline.registry import ENTRIES  # noqa: E402
from ledgerline.session import local_session  # noqa: E402
from ledgerline.sources import star  # noqa: E402

REGISTERED = (
    "monthly_report",
    "customer_list",
    "client_stats",
    "transition_matrix",
    "monthly_series",
    "location_stats",
    "recent_orders",
    "new_client_cohort",
    "home_location",
    "tier_change",
)
# Timed only when named on the command line.
ON_REQUEST = ("snapshot_12_single_jobs",)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def snapshot(spark: SparkSession, directory: str, months: int, back: int = 0) -> None:
    t = star.load(spark, directory)
    params = star.snapshot_params(months)
    params = replace(params, latest=month_last_day(params.last_month - back))
    run(customer_snapshot(t.sales, t.products, t.customers, params))


def jobs(spark: SparkSession, directory: str) -> dict:
    def month_by_month() -> None:
        for back in range(12):
            snapshot(spark, directory, 1, back)

    named = {
        f"snapshot_{n}m": (lambda n=n: snapshot(spark, directory, n)) for n in (1, 12, 36)
    }
    named["snapshot_12_single_jobs"] = month_by_month
    for name in REGISTERED:
        named[name] = lambda name=name: run(ENTRIES[name].run(spark, directory))
    return named


def seconds(job, runs: int) -> float:
    job()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        job()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:]
    spark = local_session(cores, partitions=cores)
    named = jobs(spark, directory)
    names = chosen or [name for name in named if name not in ON_REQUEST]
    times = {name: seconds(named[name], runs) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": directory.rstrip("/").rsplit("sf", 1)[-1],
                "cores": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
