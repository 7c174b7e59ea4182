"""P4 — the combined job: build the three products and write them.

Outputs (all optional keys of ``outputs``):

* ``activity``       — warehouse folder/table for P1 (overwrite)
* ``trends``         — warehouse folder/table for P2 (overwrite)
* ``network``        — warehouse folder/table for P3 (overwrite)
* ``network_docs``   — document collection for P3 (append, as the original)
* ``rejects``        — what lenient mode left out (overwrite); lenient mode
  needs it, so no record goes unseen

A value is a path, or ``{"table": name, "path": optional location}``.
When both P3 outputs are requested, the documents are made from the
written P3 table: the product is computed once and the document write
starts from stored data, not from the whole lineage.

Command line (the original job took its options the same way):

    python -m usagelens.plans.run_all --voice P --sms P --volume P \\
        --subscriber P --rate-plans P --locations P --out DIR [--lenient] [--count-mode M]
        [--truncate-ids] [--quoted-subscribers] [--run-id R]
"""

from __future__ import annotations

import argparse
import os
import uuid

from pyspark.sql import SparkSession

from usagelens.functions.cleaning import LENIENT, STRICT
from usagelens.operators.counting import COUNT_MODES, KEYS
from usagelens.plans.activity import activity_snapshot
from usagelens.plans.network import network_activity
from usagelens.plans.rejects import rejects
from usagelens.plans.trends import rate_plan_trends
from usagelens.schemas import ACTIVITY_SNAPSHOT, NETWORK_ACTIVITY, RATE_PLAN_TRENDS, REJECTS
from usagelens.sinks.documents import append_run, to_documents, write_documents
from usagelens.sinks.warehouse import read_table, write_table
from usagelens.session import checkpoint_dir
from usagelens.sources.files import load_inputs_from_paths, write_inputs
from usagelens.sources.inputs import UsageInputs


def _target(spec) -> dict:
    return {"path": spec} if isinstance(spec, str) else dict(spec)


def run_all(inputs: UsageInputs, outputs: dict, mode: str = STRICT, count_mode: str = KEYS,
            truncate_ids: bool = False, docs_mode: str = "append",
            materialize_inputs: bool = False, run_id: str | None = None) -> None:
    """Write the requested products.  ``run_id`` goes into the document ids
    (a fresh one by default); a run that is named appends its documents once,
    however often the job is repeated.  ``materialize_inputs`` first writes
    derived inputs (e.g. the test-data adapter's joins) once under the
    shared checkpoint folder and reads them back, so the three products do
    not each recompute them and their lineage starts at stored files."""
    if mode == LENIENT and "rejects" not in outputs:
        raise ValueError("lenient mode leaves records out: give it a 'rejects' output")
    if materialize_inputs:
        spark = inputs.voice_call_record.sparkSession
        root = f"{checkpoint_dir(spark).rstrip('/')}/inputs-{uuid.uuid4().hex}"
        inputs = load_inputs_from_paths(spark, write_inputs(inputs, root), quoted_subscribers=inputs.quoted_subscribers)
    if "activity" in outputs:
        write_table(activity_snapshot(inputs, mode), ACTIVITY_SNAPSHOT, **_target(outputs["activity"]))
    if "trends" in outputs:
        trends = rate_plan_trends(inputs, count_mode, mode, truncate_ids)
        write_table(trends, RATE_PLAN_TRENDS, num_files=1, **_target(outputs["trends"]))
    if "network" in outputs or "network_docs" in outputs:
        network = network_activity(inputs, count_mode, mode, truncate_ids)
        if "network" in outputs:
            target = _target(outputs["network"])
            write_table(network, NETWORK_ACTIVITY, num_files=1, **target)
            network = read_table(network.sparkSession, NETWORK_ACTIVITY, **target)
        if "network_docs" in outputs:
            documents = to_documents(network, run_id or uuid.uuid4().hex)
            if run_id and docs_mode == "append":
                append_run(documents, outputs["network_docs"], run_id, num_files=1)
            else:
                write_documents(documents, outputs["network_docs"], mode=docs_mode, num_files=1)
    if mode == LENIENT:
        write_table(rejects(inputs), REJECTS, **_target(outputs["rejects"]))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build and write the three usage products.")
    for flag in ("voice", "sms", "volume", "subscriber", "rate-plans", "locations", "out"):
        parser.add_argument(f"--{flag}", required=True)
    parser.add_argument("--fact-format", default="parquet")
    parser.add_argument("--lenient", action="store_true")
    parser.add_argument("--count-mode", default=KEYS, choices=COUNT_MODES)
    parser.add_argument("--docs-mode", default="append", choices=("append", "overwrite"))
    parser.add_argument("--truncate-ids", action="store_true",
                        help="cut ids to 15 characters in P2 and P3, as the original's scans did")
    parser.add_argument("--quoted-subscribers", action="store_true",
                        help="fields of the subscriber file may be in double quotes and hold commas")
    parser.add_argument("--run-id", default=None, help="prefix of the document ids (default: a fresh one)")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("usagelens-run-all").getOrCreate()
    inputs = load_inputs_from_paths(spark, {
        "voice_call_record": args.voice, "sms_record": args.sms,
        "mobile_data_activity": args.volume, "subscriber": args.subscriber,
        "rate_plan_product": args.rate_plans, "location": args.locations,
    }, fact_format=args.fact_format, quoted_subscribers=args.quoted_subscribers)
    out = args.out.rstrip("/")
    names = ["activity", "trends", "network", "network_docs", *["rejects"] * args.lenient]
    run_all(inputs, {name: os.path.join(out, name) for name in names},
            mode=LENIENT if args.lenient else STRICT, count_mode=args.count_mode,
            truncate_ids=args.truncate_ids, docs_mode=args.docs_mode, run_id=args.run_id)


if __name__ == "__main__":
    main()
