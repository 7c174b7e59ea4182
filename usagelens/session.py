"""Session construction and shared-storage locations.

On a cluster the deployment owns the session; ``build_session`` is for
tests, the bench and local runs.  ``output_root`` and ``checkpoint_dir``
never invent a folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Config applied by ``build_session``.  AQE re-plans joins from measured
# shuffle sizes, coalesces small partitions and splits skewed join
# partitions; the UI stays off (no server in batch runs).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "usagelens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, read from the
    session (else the checkpoint folder its context was given).  Without
    either there is none: folders of one machine do not survive the loss of
    an executor."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return configured


def scratch_checkpoint_dir(spark: SparkSession) -> None:
    """Gives a local session (tests, a notebook) that names no checkpoint
    folder a scratch one; leaves any other session as it is."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return
    context = spark.sparkContext
    if re.fullmatch(r"local(\[.*\])?", context.master) and not context.getCheckpointDir():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="usagelens-ckpt-"))


def output_root(spark: SparkSession) -> str:
    """Root folder for sink round trips: ``usagelens.output.dir`` if set,
    else a sub-folder of the shared checkpoint folder."""
    configured = spark.conf.get("usagelens.output.dir", None)
    if configured:
        return configured
    return os.path.join(checkpoint_dir(spark), "outputs")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and
    read back: computed once, and its lineage starts at stored files."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cluster_conf(executors: int, cores_per_executor: int, split_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Starting settings for a large cluster (pass to ``--conf`` / the builder).

    * scans: ``split_bytes`` a task; 512 MB makes 100 TB ~205k map tasks
      rather than ~820k (fewer shuffle blocks and map statuses on the driver);
    * shuffles: every product shuffles per-task partial aggregates, far
      smaller than the input, so start from 4 partitions per core and let
      AQE coalesce to ~128 MB (the initial number only caps parallelism);
    * skew: AQE splits a join partition 5x the median and over 256 MB;
    * broadcasts: the planner's estimate stays at Spark's 10 MB default;
      adaptive execution, which knows exact sizes, goes up to 64 MB.
    """
    cores = executors * cores_per_executor
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(max(200, 4 * cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
