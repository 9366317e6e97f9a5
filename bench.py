"""Time the registered queries: one JSON line on stdout.

BENCH_SF_DIR  data folder, default /root/testdata/sf0.1
BENCH_CPUS    local cores, default 8
BENCH_RUNS    runs per query, the fastest counts, default 2
Query names as arguments restrict the run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from growthkit.plans import catalog
from growthkit.session import get_session


def scale(sf_dir: str) -> float | str:
    """The scale factor in the folder name, or the name itself."""
    name = os.path.basename(sf_dir.rstrip("/"))
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or list(catalog.QUERIES)
    catalog.QUERIES["pm_mau"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in chosen:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale(sf_dir),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
