"""Catalogue lookups: dedupe, then a left join from the fact.

The original co-group of a fact with a catalogue keeps only keys present
in the fact and takes the *first* catalogue value of a key.  Here:

* ``dedupe_catalogue`` keeps one value per key (the smallest, so the
  choice is deterministic) and drops null keys, which can match nothing;
  it is a partial + final aggregate.
* ``lookup`` joins fact -> catalogue as a left outer join, so every fact
  key survives and unknown keys get a fallback label downstream.  Nothing is
  forced: adaptive execution knows the exact size of the deduplicated side
  once its aggregate has run, and broadcasts it if it is below
  ``spark.sql.adaptive.autoBroadcastJoinThreshold``; beyond that the join
  stays a shuffle join whose skewed partitions are split.
* ``salted_lookup`` does the same for rows that could not be counted per
  key first (one row per key and subscriber).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tasks a hot key is dealt out to by ``salted_lookup``.
SALTS = 16


def dedupe_catalogue(catalogue: DataFrame, key: str, value: str) -> DataFrame:
    return (catalogue.where(F.col(key).isNotNull())
            .groupBy(key).agg(F.min(value).alias(value)))


def lookup(fact: DataFrame, catalogue: DataFrame, key: str, value: str) -> DataFrame:
    """``fact`` left-joined with ``dedupe(catalogue)`` on ``key``; adds column
    ``value`` (null where the catalogue has no entry)."""
    return fact.join(dedupe_catalogue(catalogue.select(key, value), key, value), key, "left")


def salted_lookup(fact: DataFrame, catalogue: DataFrame, key: str, value: str, salt_by: str,
                  salts: int = SALTS) -> DataFrame:
    """``lookup`` for facts with very many rows a key: the key is dealt out by
    a hash of ``salt_by`` as well, against as many copies of the deduplicated
    catalogue, so that no task gets all rows of a hot key."""
    # copied by a join with the salts, which the planner takes for larger than its sides (an explode for as large as
    # its input), so copies are broadcast only where they are few; dealt out before they are deduplicated, as the
    # smallest text is found by sorting, and the task that copies would sort all its copies
    slots = fact.sparkSession.range(0, salts, 1, 1).select(F.col("id").cast("int").alias("lookup_salt"))
    pairs = catalogue.where(F.col(key).isNotNull()).select(key, value).distinct()
    names = (pairs.crossJoin(slots).repartition(key, "lookup_salt")
             .groupBy(key, "lookup_salt").agg(F.min(value).alias(value)))
    dealt = fact.withColumn("lookup_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    return dealt.join(names, [key, "lookup_salt"], "left").drop("lookup_salt")
