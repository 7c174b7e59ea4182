"""Benchmark the headline products on the driver tables.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion with the ``noop`` sink (full execution,
nothing collected to the driver).  The first pass starts from nothing
(no table or input memoised, code not compiled) and is reported as ``cold``;
then come ``BENCH_REPEATS`` (default 5) timed passes, whose median per query
is the value reported.
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from usagelens.operators.counting import KEYS, RECORDS, SUBSCRIBERS  # noqa: E402
from usagelens.plans import activity_snapshot, network_activity, rate_plan_trends  # noqa: E402
from usagelens.session import build_session  # noqa: E402
from usagelens.sources import testdata  # noqa: E402

HEADLINE = {
    "activity_snapshot": lambda i: activity_snapshot(i),
    "rate_plan_trends": lambda i: rate_plan_trends(i, KEYS),
    "rate_plan_trends_records": lambda i: rate_plan_trends(i, RECORDS),
    "network_activity": lambda i: network_activity(i, KEYS),
    "network_activity_records": lambda i: network_activity(i, RECORDS),
}
# timed too, but not part of the value, which stays comparable over rounds
MORE = {
    "rate_plan_trends_subscribers": lambda i: rate_plan_trends(i, SUBSCRIBERS),
    "network_activity_subscribers": lambda i: network_activity(i, SUBSCRIBERS),
}


def _run(spark, sf_dir: str, build) -> tuple[float, float]:
    """(plan build seconds, execution seconds)."""
    t0 = time.perf_counter()
    df = build(testdata.load_inputs(spark, sf_dir))
    t1 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return t1 - t0, time.perf_counter() - t1


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "5"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="usagelens-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    cold = {}
    timed = HEADLINE | MORE
    for name, build in timed.items():
        testdata.forget()
        cold[name] = round(sum(_run(spark, sf_dir, build)), 3)
    times = {name: [] for name in timed}
    phases = {name: [] for name in timed}
    for _ in range(repeats):
        for name, build in timed.items():
            plan_s, run_s = _run(spark, sf_dir, build)
            times[name].append(plan_s + run_s)
            phases[name].append((plan_s, run_s))
    print(json.dumps(times), file=sys.stderr)
    medians = {name: round(statistics.median(ts), 3) for name, ts in times.items()}
    split = {name: {"plan": round(statistics.median(p for p, _ in ps), 3),
                    "execute": round(statistics.median(r for _, r in ps), 3)}
             for name, ps in phases.items()}
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum of median wall time of the five headline products",
        "value": round(sum(medians[name] for name in HEADLINE), 3),
        "unit": "sec",
        "queries": medians,
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
        "phases": split,
        "cold": cold,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
