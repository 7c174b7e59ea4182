"""Document sink for the network activity snapshot.

Each output row becomes one JSON document with an ``_id``, a ``Rank`` field
and four human-readable field names.  ``_id`` is ``<run>-<rank>``: the caller
names the run, so documents of two appended runs can be told apart and a
repeated run writes the same ids.  The original appends one document per row
on every run; ``write_documents`` appends by default too
(``mode="overwrite"`` gives an idempotent collection).  Documents are
written by Spark's file sink, so retried tasks never publish twice.

``append_run`` also makes a repeated *job* publish once: the documents go to a
folder of this attempt, and a manifest file named after the run, created only
if there is none, says which attempt counts.  A run that was committed
before adds nothing; one that died before its manifest is as if it had never
been; of two attempts at once the first to create the manifest wins.
``read_documents`` reads what the manifests name, beside plain appends.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.schemas import NETWORK_COLUMNS, NETWORK_DOCUMENT, NETWORK_DOCUMENT_FIELDS
from usagelens.sinks.folders import create, exists

#: Folders that readers of the collection's plain files pass over.
MANIFESTS, ATTEMPTS = "_runs", "_attempts"
_RUN = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def to_documents(network: DataFrame, run: str = "run") -> DataFrame:
    """rank -> Rank, table column names -> document field names, and the
    document id."""
    return network.select(
        F.concat(F.lit(run + "-"), F.col("rank").cast("string")).alias("_id"),
        F.col("rank").cast("long").alias("Rank"),
        *[F.col(c).alias(f) for c, f in zip(NETWORK_COLUMNS, NETWORK_DOCUMENT_FIELDS)]
    ).to(NETWORK_DOCUMENT)


def write_documents(documents: DataFrame, path: str, mode: str = "append",
                    num_files: int | None = None) -> None:
    """``num_files`` coalesces; the ranked product has at most k rows, so
    its callers ask for one file."""
    if num_files is not None:
        documents = documents.coalesce(num_files)
    documents.write.mode(mode).json(path)


def append_run(documents: DataFrame, path: str, run_id: str, num_files: int | None = None) -> bool:
    """Appends the documents of run ``run_id`` exactly once; False if the run
    had been committed before."""
    if not _RUN.fullmatch(run_id):
        raise ValueError("a run id has letters, digits, '.', '_' and '-' only, and begins with a letter or digit")
    spark, path = documents.sparkSession, path.rstrip("/")
    manifest = f"{path}/{MANIFESTS}/{run_id}"
    if exists(spark, manifest):
        return False
    attempt = f"{ATTEMPTS}/{run_id}/{uuid.uuid4().hex}"
    write_documents(documents, f"{path}/{attempt}", num_files=num_files)
    return create(spark, manifest, attempt)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """All documents appended to the collection: plain appends, and those of
    the committed runs (the driver lists one line a run)."""
    path = path.rstrip("/")
    plain = spark.read.schema(NETWORK_DOCUMENT).json(path)
    if not exists(spark, f"{path}/{MANIFESTS}"):
        return plain
    attempts = [r.value for r in spark.read.text(f"{path}/{MANIFESTS}").collect()]
    return plain.unionByName(spark.read.schema(NETWORK_DOCUMENT).json([f"{path}/{a}" for a in attempts]))
