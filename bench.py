"""Time the registered queries over whole tables and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names; default: all).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from obslake.plans import all_queries  # noqa: E402
from obslake.session import build_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="spark-", dir="/tmp"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(queries)

    # warm the JVM up on the flagship, untimed
    queries["panel_tie"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds, all registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
