"""Time the registered queries of the metering jobs; prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables and ``BENCH_CPUS`` the number of cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from wattfold.plans.catalog import QUERIES
from wattfold.settings import build_session

def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
    }
    spark = build_session("wattfold-bench", f"local[{cpus}]", settings)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(QUERIES)
    # One untimed query loads classes and compiles common code.
    QUERIES["fact_power_consumption"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_wall_time", "value": total, "unit": "sec", "queries": seconds, "sf": folder}))


if __name__ == "__main__":
    main()
