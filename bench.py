"""Benchmark: seconds per registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed fully with the ``noop`` sink (nothing is collected to
the driver). Two queries run once untimed to warm up the JVM; each query is then timed
$BENCH_REPEAT times (default 2) and the best time is kept. Prints one JSON line.

With BENCH_STREAM=1 the streaming forms (``*_stream`` keys: topic written to
the checkpoint folder, job run once with availableNow) are timed as well,
reported under ``stream_queries`` and not added to ``value``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shoplake.plans.queries import QUERIES  # noqa: E402
from shoplake.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(
        f"local[{cpus}]",
        app_name="shoplake-bench",
        shuffle_partitions=cpus * 2,
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    spark.sparkContext.setLogLevel("ERROR")

    for warm in ("new_visitor_repair", "order_interval_join"):  # JIT warm-up, untimed
        QUERIES[warm](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        best = None
        for _ in range(max(1, repeat)):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)

    stream_times: dict[str, float] = {}
    if os.environ.get("BENCH_STREAM", "0") == "1":
        from shoplake.plans.stream_queries import STREAM_QUERIES

        for name, (fn, _) in STREAM_QUERIES.items():
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            stream_times[name] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {
        "metric": "total_seconds_all_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    if stream_times:
        out["stream_queries"] = stream_times
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
