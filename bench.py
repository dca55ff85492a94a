"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of the tables and BENCH_CPUS the number of local cores.
Each query is run once to warm up, then BENCH_RUNS times (default 3); the median counts.
Seconds include planning and collecting the (small) result of a report.
"""

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmart.checks import joined
from tripmart.checks.fixtures import land
from tripmart.checks.queries import QUERIES, stored_warehouse

REPORTS = [
    "agg_total",
    "agg_per_year",
    "payment_per_year",
    "agg_per_payment",
    "trips_per_pu_location",
    "trips_per_do_location",
    "trips_per_day",
    "trips_per_hour",
]
LOADS = ["warehouse_init", "warehouse_backfill", "surrogate_key"]
SCANS = ["filter_valid_trips", "normalize_write", "ingest_landing"]
MODELS = ["feature_correlation", "correlation_matrix", "model_linear", "model_forest"]


def _consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _seconds(run: Callable[[], None]) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def _median(run: Callable[[], None], runs: int) -> float:
    run()
    return round(statistics.median(_seconds(run) for _ in range(runs)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    land_seconds = round(_seconds(lambda: land(spark, sf_dir)), 3)
    warehouse = stored_warehouse(spark, sf_dir)

    for _ in range(2):  # both kinds of report start with the same warm engine
        for name, report in joined.REPORTS.items():
            _consume(report(warehouse))
            _consume(QUERIES[name](spark, sf_dir))
    times = {}
    for name in REPORTS + LOADS + SCANS + MODELS:
        times[name] = _median(
            lambda name=name: _consume(QUERIES[name](spark, sf_dir)), 1 if name in LOADS else runs
        )
        print(name, times[name], file=sys.stderr)
    star = {
        name: _median(lambda report=report: _consume(report(warehouse)), runs)
        for name, report in joined.REPORTS.items()
    }
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, median after one warm-up",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": cpus,
                "spark": spark.version,
                "land_input_once": land_seconds,
                "reports_total": round(sum(times[name] for name in REPORTS), 3),
                "reports_with_all_joins": star,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
