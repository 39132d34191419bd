"""Time every registered query: one JSON line, seconds per query.

Each query is planned and run in full, its rows dropped by Spark's ``noop`` sink.
"""

import json
import os
import time

from idwarden.plans.catalog import QUERIES
from idwarden.plans.session import local_session


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = local_session("bench")

    def once(query):
        began = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    once(QUERIES["d01_shadow_access"])  # warm up the JVM
    seconds = {}
    for name, query in QUERIES.items():
        runs = sorted(once(query) for _ in range(repeats))
        seconds[name] = round(runs[len(runs) // 2], 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
