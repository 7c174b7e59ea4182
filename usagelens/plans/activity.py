"""P1 — subscriber activity snapshot.

One row per subscriber seen in any of the three facts: shortest and
longest call, SMS count, total uplink and downlink volume; a fact the
subscriber has no record in contributes 0.

Plan: the three projections are unioned and aggregated by ONE
``groupBy(subscription_id)``, the id being a number by then (so ``7`` and
``07`` are one subscriber and the shuffle key is narrow) — partial aggregation in every scan task,
one shuffle of per-task partials, one final aggregation.  A hot
subscriber therefore costs one partial row per task, not a skewed
partition, and the five-way merge needs no join at all (null
subscribers merge into one row, as in the original co-group).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions.cleaning import (
    LENIENT, STRICT, check_mode, clean_volume, id_is_bad, integer_id, volume_is_bad,
)
from usagelens.schemas import ACTIVITY_SNAPSHOT
from usagelens.sources import UsageInputs, scan

BAD_ID = "subscription_id is not an integer"
BAD_VOLUME = "volume is not an integer"


def _null_long():
    return F.lit(None).cast("long")


def clean_volumes(inputs: UsageInputs, mode: str = STRICT) -> DataFrame:
    """(subscription_id, uplink_volume, downlink_volume) as longs."""
    vol = scan(inputs, "data_volume")
    if mode == LENIENT:
        vol = vol.where(~(volume_is_bad("uplink_volume") | volume_is_bad("downlink_volume")))
    return vol.select("subscription_id",
                      clean_volume("uplink_volume", mode).alias("uplink_volume"),
                      clean_volume("downlink_volume", mode).alias("downlink_volume"))


def sms_count(inputs: UsageInputs) -> DataFrame:
    """SMS records per subscriber (null network ids included)."""
    return (scan(inputs, "sms_rec").groupBy("subscription_id")
            .agg(F.count(F.lit(1)).alias("total_sms_sent")))


def call_extremes(inputs: UsageInputs) -> DataFrame:
    """Shortest and longest call per subscriber (null durations ignored)."""
    return (scan(inputs, "voice_call").groupBy("subscription_id")
            .agg(F.min(F.col("actual_duration").cast("long")).alias("shortest_call"),
                 F.max(F.col("actual_duration").cast("long")).alias("longest_call")))


def volume_totals(inputs: UsageInputs, mode: str = STRICT) -> DataFrame:
    return (clean_volumes(inputs, mode).groupBy("subscription_id")
            .agg(F.sum("uplink_volume").alias("total_uplink_vol"),
                 F.sum("downlink_volume").alias("total_downlink_vol")))


def _with_id(df: DataFrame, mode: str) -> DataFrame:
    """Subscriber ids as numbers; lenient mode leaves out records whose id is none."""
    if mode == LENIENT:
        df = df.where(~id_is_bad("subscription_id", "long"))
    return df.withColumn("subscription_id", integer_id("subscription_id", mode, "long"))


def activity_snapshot(inputs: UsageInputs, mode: str = STRICT) -> DataFrame:
    check_mode(mode)
    calls = _with_id(scan(inputs, "voice_call"), mode).select(
        "subscription_id", F.col("actual_duration").cast("long").alias("duration"),
        F.lit(0).alias("sms"), _null_long().alias("uplink"), _null_long().alias("downlink"))
    sms = _with_id(scan(inputs, "sms_rec"), mode).select(
        "subscription_id", _null_long().alias("duration"),
        F.lit(1).alias("sms"), _null_long().alias("uplink"), _null_long().alias("downlink"))
    volumes = _with_id(clean_volumes(inputs, mode), mode).select(
        "subscription_id", _null_long().alias("duration"), F.lit(0).alias("sms"),
        F.col("uplink_volume").alias("uplink"), F.col("downlink_volume").alias("downlink"))

    per_subscriber = calls.unionByName(sms).unionByName(volumes).groupBy("subscription_id").agg(
        F.min("duration").alias("shortest_call"),
        F.max("duration").alias("longest_call"),
        F.sum("sms").alias("total_sms_sent"),
        F.sum("uplink").alias("total_uplink_vol"),
        F.sum("downlink").alias("total_downlink_vol"))

    zero = F.lit(0).cast("long")
    out = per_subscriber.select(
        "subscription_id",
        *[F.coalesce(F.col(c).cast("long"), zero).alias(c)
          for c in ("shortest_call", "longest_call", "total_sms_sent",
                    "total_uplink_vol", "total_downlink_vol")])
    return out.to(ACTIVITY_SNAPSHOT)


#: source -> scan of its records
SOURCES = {"voice_call_record": "voice_call", "sms_record": "sms_rec", "mobile_data_activity": "data_volume"}


def reject(source: str) -> Column:
    """(source, subscription_id, value, reason) of a record that lenient mode
    keeps out of the snapshot; null for the others."""
    own = F.col("subscription_id")
    reason, value = F.when(id_is_bad("subscription_id", "long"), BAD_ID), own
    if SOURCES[source] == "data_volume":
        value = F.when(reason.isNotNull(), own).otherwise(F.concat_ws(
            "|", F.coalesce("uplink_volume", F.lit("NULL")), F.coalesce("downlink_volume", F.lit("NULL"))))
        reason = F.coalesce(reason, F.when(volume_is_bad("uplink_volume") | volume_is_bad("downlink_volume"), BAD_VOLUME))
    return F.when(reason.isNotNull(), F.struct(
        F.lit(source).alias("source"), own.alias("subscription_id"), value.alias("value"), reason.alias("reason")))


def activity_rejects(inputs: UsageInputs, sources: Iterable[str] = tuple(SOURCES)) -> DataFrame:
    """(source, subscription_id, value, reason): a row for every record that
    lenient mode keeps out of the snapshot.  Each source is read once."""
    out = None
    for source in sources:
        bad = (scan(inputs, SOURCES[source]).select(reject(source).alias("reject"))
               .where("reject is not null").select("reject.*"))
        out = bad if out is None else out.unionByName(bad)
    return out
