"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import usagelens
from usagelens.session import checkpoint_dir, scratch_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrow(df: DataFrame, rows: Callable, schema) -> DataFrame:
    """``mapInArrow`` by Python workers that look for this package where the
    driver found it, too.  A cluster's workers get it with the job
    (``--py-files``) or have it installed."""
    environment = df.sparkSession.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.abspath(usagelens.__file__)))
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in [root, *paths] if p)
    return df.mapInArrow(rows, schema)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` on a value that is worked out once a row (a column that a
    later step names several times may be worked out as often)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder named by ``spark.checkpoint.dir``."""
    scratch_checkpoint_dir(spark)  # only where a local session has none
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


#: Rows that fill a task and a file of a table of narrow rows.
TASK_ROWS = 20_000


def files_for(spark: SparkSession, rows: int) -> int:
    """Tasks for so many narrow rows: enough for all cores, more only as the
    rows ask for them.  (``coalesce`` never makes more than there are.)"""
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS))


def stored(df: DataFrame, name: str, files: int | None = None, codec: str = "snappy") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: it
    is computed once, its lineage ends there, and the loss of an executor
    cannot undo it.  ``files`` is the most tasks and files the last step
    takes, whatever the number of shuffle partitions; ``codec`` is for tables
    that hold whole texts."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    (df if files is None else df.coalesce(files)).write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _is_star(links: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, which has none."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("top")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("low"), F.lit(1).alias("top")))
    odd = ends.groupBy("node").agg(F.sum("low").alias("low"), F.max("top").alias("top"))
    return odd.where((F.col("low") > 1) | ((F.col("low") == 1) & (F.col("top") == 1))).isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of the links ``(a, b)`` (two longs).

    Returns (node, component) for every node of a link, ``component`` being
    the smallest node reachable.  Large-star and small-star rounds on
    written link tables until the links are stars: each round is a
    map-side combined minimum per node joined back to the links, so a node
    with very many links is reduced before the shuffle, and the join that
    follows reads two plain exchanges, which AQE can split.
    """
    a, b = F.col("a"), F.col("b")
    links = stored(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                   .distinct(), name)
    files = files_for(edges.sparkSession, links.count())  # a round never has more links than this
    while not _is_star(links):
        # large star: every larger neighbour of a node gets the smallest node around it
        both = links.unionByName(links.select(b.alias("a"), a.alias("b")))
        low = stored(both.groupBy("a").agg(F.least(a, F.min("b")).alias("low")), name, files)
        large = (both.join(low, "a").where(b > a)
                 .select(b.alias("a"), F.col("low").alias("b")).distinct())
        links = stored(large, name, files)
        # small star: every smaller neighbour of a node and the node itself get their minimum
        low = stored(links.groupBy("a").agg(F.min("b").alias("low")), name, files)
        small = (links.join(low, "a").where(b != F.col("low"))
                 .select(b.alias("a"), F.col("low").alias("b"))
                 .unionByName(low.select("a", F.col("low").alias("b"))).distinct())
        links = stored(small, name, files)
    return (links.select(a.alias("node"), b.alias("component"))
            .unionByName(links.select(b.alias("node"), b.alias("component")).distinct()))
