"""Write the executed (AQE-final) physical plans of the products to
docs/plans/<name>.txt, and those with broadcast joins off to
docs/plans/no_broadcast/<name>.txt.

    python scripts/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from usagelens.operators.counting import KEYS, RECORDS, SUBSCRIBERS  # noqa: E402
from usagelens.plans import activity_snapshot, network_activity, rate_plan_trends  # noqa: E402
from usagelens.session import build_session  # noqa: E402
from usagelens.sources.testdata import load_inputs  # noqa: E402

PRODUCTS = {
    "activity_snapshot": lambda i: activity_snapshot(i),
    "rate_plan_trends": lambda i: rate_plan_trends(i, KEYS),
    "rate_plan_trends_records": lambda i: rate_plan_trends(i, RECORDS),
    "rate_plan_trends_subscribers": lambda i: rate_plan_trends(i, SUBSCRIBERS),
    "network_activity": lambda i: network_activity(i, KEYS),
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    write_plans(spark, sf_dir, os.path.join(ROOT, "docs", "plans"))
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    write_plans(spark, sf_dir, os.path.join(ROOT, "docs", "plans", "no_broadcast"))
    spark.stop()


def write_plans(spark, sf_dir: str, out_dir: str) -> None:
    os.makedirs(out_dir, exist_ok=True)
    inputs = load_inputs(spark, sf_dir)
    for name, build in PRODUCTS.items():
        df = build(inputs)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        # drop machine-specific file locations
        text = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: ...", buf.getvalue())
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as fh:
            fh.write(f"# {name} at {os.path.basename(sf_dir.rstrip('/'))}, executed plan\n{text}")


if __name__ == "__main__":
    main()
