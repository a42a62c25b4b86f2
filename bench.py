"""Time the reports on the driver tables and print one JSON line.

    BENCH_SF_DIR  data directory (default /root/testdata/sf0.1)
    BENCH_CPUS    cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rosterlens.operators import counts, indicators  # noqa: E402
from rosterlens.plans.driver_queries import QUERIES  # noqa: E402
from rosterlens.session import prepare  # noqa: E402
from rosterlens.sources import driver_tables as tables  # noqa: E402
from rosterlens.sources.requests import Requests  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINES = [
    "provider_counts",
    "specialty_counts",
    "performance_indicators",
    "organization_export",
    "individual_export",
    "membership_individual",
    "score_join_individual",
    "market_benchmark",
    "request_parse",
]
PAIRINGS = [1, 10, 50]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("rosterlens-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return prepare(spark)


first_runs: dict[str, float] = {}


def seconds(name: str, build, repeats: int = 3) -> float:
    """Median time to build, plan and run the query to its last row; the first run is kept too."""
    taken = []
    for _ in range(repeats):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - start)
    first_runs[name] = round(taken[0], 3)
    return round(sorted(taken)[len(taken) // 2], 3)


def paired_requests(spark: SparkSession, pairings: int) -> Requests:
    """One request that compares network 1 with the given number of networks."""
    places = tables.table(spark, SF_DIR, "nation").agg(F.collect_list("n_nationkey").alias("fips"))
    compares = [(str(i), f"Org {i}", str(i % 4 + 2)) for i in range(2, pairings + 2)]
    fips = F.array_join(F.transform("fips", lambda f: f.cast("string")), ",")
    row = tables.request_row("R", 8, ("1", "Org A", "1"), compares, fips)
    return Requests(places.select(*row))


def main() -> None:
    spark = session()
    times = {}
    for name in HEADLINES:
        times[name] = seconds(name, lambda: QUERIES[name](spark, SF_DIR))
    total = round(sum(times.values()), 3)
    rows = tables.table(spark, SF_DIR, "orders").count()
    rows += tables.table(spark, SF_DIR, "lineitem").count()
    for pairings in PAIRINGS:
        requests = paired_requests(spark, pairings)
        name = f"provider_counts_{pairings}_pairings"
        times[name] = seconds(
            name,
            lambda: counts.provider_counts(
                tables.individuals(spark, SF_DIR), tables.organizations(spark, SF_DIR), requests
            )
        )
        name = f"individual_bands_{pairings}_pairings"
        times[name] = seconds(
            name,
            lambda: indicators.individual_bands(
                tables.individuals(spark, SF_DIR),
                tables.individual_scores(spark, SF_DIR),
                requests,
            )
        )
    print(
        json.dumps(
            {
                "metric": "seconds for the headline queries",
                "value": total,
                "unit": "sec",
                "queries": times,
                "first_runs": first_runs,
                "provider_rows": rows,
                "provider_rows_per_sec": round(rows / times["provider_counts"]),
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
