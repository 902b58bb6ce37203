"""Time every registered query; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default all), BENCH_SHUFFLE_PARTITIONS (default 2 x cpus),
BENCH_WARMUP (1: one untimed pass over BENCH_WARMUP_DIR, default sf0.001).
Each query is built (sink queries write and read back here) and then fully executed through
the ``noop`` sink, so no result is collected to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from songpulse.plans.queries import REGISTRY  # noqa: E402
from songpulse.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * cpus)))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or sorted(REGISTRY)
    spark = build_session(f"local[{cpus}]", parts, app_name="songpulse-bench")
    # Warm the JVM (class loading, JIT, codegen caches) with one untimed pass over the
    # smallest scale, so the timings below are steady-state query times.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.environ.get("BENCH_WARMUP", "1") == "1" and os.path.isdir(warm_dir):
        for name in names:
            REGISTRY[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        df = REGISTRY[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf[2:] if sf.startswith("sf") else sf,
                "cpus": cpus,
                "shuffle_partitions": parts,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
