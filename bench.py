"""Benchmark: run every registered job at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query wall-clock seconds.

Each query is timed from building its DataFrame (some jobs materialise
intermediate results, e.g. dense ids) to the end of a full execution into
Spark's ``noop`` sink, which computes every row and column without
collecting anything to the driver.  All queries first run once, untimed, on
the smallest tables (steady-state timings).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from terracat.queries import QUERIES  # noqa: E402
from terracat.session import get_session  # noqa: E402


def run(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = fn(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session(f"local[{cpus}]", app="terracat-bench", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # warm-up, not timed: every query once on the smallest tables, so JIT and
    # Spark's generated-code cache are warm and the timings are steady-state
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    for name, (fn, _) in QUERIES.items():
        if (not only or name in only) and os.path.isdir(warm_dir):
            try:
                run(spark, fn, warm_dir)
            except Exception as exc:  # reported in the timed pass
                print(f"warm-up {name} failed: {exc!r}"[:300], file=sys.stderr)
    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name, (fn, _) in QUERIES.items():
        if only and name not in only:
            continue
        try:
            best = min(run(spark, fn, sf_dir) for _ in range(repeat))
        except Exception as exc:  # one failing query must not hide the others' timings
            errors[name] = repr(exc)[:300]
            print(f"{name} failed: {errors[name]}", file=sys.stderr, flush=True)
            continue
        timings[name] = round(best, 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds_all_queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "spark": spark.version,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
