"""P2 — rate-plan trends: top-5 and least-5 plan names by usage, overall
and per age band (10 ranked lists merged on rank).

Plan (usage is read twice, no per-band branches):

1. usage ``sub_rec`` -> per plan id record counts (partial aggregate).
2. subscriber CSV -> (subscriber, mask of age bands), deduplicated.
3. usage -> first plan per subscriber by arrival (an aggregate, so a
   subscriber with a third of all rows is reduced map-side).
4. (2) join (3) on subscriber -> per (band, plan id) subscriber counts.
5. (1) union (4) tagged by series -> ONE lookup join with the deduplicated
   catalogue (rows = distinct plan ids, not usage rows).
6. per (series, name) counts in the chosen counting mode, top/least 5
   per series via ``WindowGroupLimit``, one pivot on rank.

In ``subscribers`` mode both series come from one aggregate of usage by
(plan, subscriber), so usage is read once there.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions.cleaning import (
    LENIENT, STRICT, age_band, age_is_bad, check_mode, id_is_bad, subscriber_fields,
    subscriber_line_is_bad, truncate_id,
)
from usagelens.functions.labels import plan_label
from usagelens.operators.counting import (
    KEYS, SUBSCRIBER_COL, SUBSCRIBERS, first_by, key_columns, per_key_counts, per_name_counts,
)
from usagelens.operators.lists import LIST_SIZE, chunked_lists
from usagelens.operators.lookups import lookup, salted_lookup
from usagelens.operators.ranking import merge_ranks, top_and_least, top_k
from usagelens.schemas import AGE_BANDS, GENERAL_PLAN, RATE_PLAN_TRENDS, TREND_COLUMNS
from usagelens.sources import UsageInputs, plan_catalogue, scan

PLAN_ID = "rate_plan_product_id"
PLAN_NAME = "plan_name"
OVERALL = "all"

# series value (direction_series) -> output column, in output order
SERIES_COLUMNS = dict(zip(
    ["top_" + OVERALL, "least_" + OVERALL] +
    [f"{d}_{b}" for b in AGE_BANDS for d in ("top", "least")],
    TREND_COLUMNS))


# ---------------------------------------------------------------- inputs
def plan_usage(inputs: UsageInputs, truncate_ids: bool = False, mode: str = STRICT) -> DataFrame:
    """(rate_plan_product_id, subscription_id, activity_seq); lenient mode
    leaves out records whose plan id is no integer."""
    if mode == LENIENT:
        usage = inputs.mobile_data_activity
        inputs = dataclasses.replace(inputs, mobile_data_activity=usage.where(~id_is_bad(PLAN_ID)))
    return scan(inputs, "sub_rec", truncate_ids=truncate_ids, mode=mode)


#: source of plan ids -> what tells its rows apart
PLAN_SOURCES = {"mobile_data_activity": "subscription_id", "rate_plan_product": "rate_plan_name"}


def plan_reject(source: str) -> Column:
    """(source, key, value, reason) of a row whose plan id is no integer; null for the others."""
    return F.when(id_is_bad(PLAN_ID), F.struct(
        F.lit(source).alias("source"), F.col(PLAN_SOURCES[source]).cast("string").alias("key"),
        F.col(PLAN_ID).cast("string").alias("value"), F.lit("rate_plan_product_id is not an integer").alias("reason")))


def plan_rejects(inputs: UsageInputs, sources: Iterable[str] = tuple(PLAN_SOURCES)) -> DataFrame:
    """(source, key, value, reason): plan ids lenient mode leaves out, of
    usage records and of catalogue documents."""
    out = None
    for source in sources:
        bad = (getattr(inputs, source).where(id_is_bad(PLAN_ID)).select(plan_reject(source).alias("reject"))
               .select("reject.*"))
        out = bad if out is None else out.unionByName(bad)
    return out


def parse_subscribers(inputs: UsageInputs, mode: str = STRICT) -> DataFrame:
    """CSV lines -> (subscription_id, age); lenient mode drops bad lines."""
    lines = inputs.subscriber
    if mode == LENIENT:
        lines = lines.where(~subscriber_line_is_bad("value", inputs.quoted_subscribers))
    sub, age = subscriber_fields("value", mode, inputs.quoted_subscribers)
    return lines.select(sub.alias("subscription_id"), age.alias("age"))


def subscriber_age_bands(inputs: UsageInputs, mode: str = STRICT,
                         truncate_ids: bool = False) -> DataFrame:
    """(subscription_id, age, age_band) for every parsed line."""
    subs = parse_subscribers(inputs, mode)
    if mode == LENIENT:
        subs = subs.where(~age_is_bad("age"))
    sid = truncate_id("subscription_id") if truncate_ids else F.col("subscription_id")
    return subs.select(sid.alias("subscription_id"), "age", age_band("age", mode).alias("age_band"))


def subscriber_rejects(inputs: UsageInputs) -> DataFrame:
    """Lines lenient mode leaves out: unparsable lines and negative ages.
    The file is read once."""
    _, age = subscriber_fields("value", LENIENT, inputs.quoted_subscribers)
    reason = (F.when(subscriber_line_is_bad("value", inputs.quoted_subscribers), "line has no integer age in field 5")
              .when(age_is_bad(age), "negative age"))
    return inputs.subscriber.withColumn("reason", reason).where("reason is not null").select("value", "reason")


# ---------------------------------------------------------------- joins and counts
def first_plan_per_subscriber(inputs: UsageInputs, truncate_ids: bool = False,
                              mode: str = STRICT) -> DataFrame:
    """(subscription_id, rate_plan_product_id): the plan of each
    subscriber's first usage record by arrival order."""
    return first_by(plan_usage(inputs, truncate_ids, mode), "subscription_id", PLAN_ID, "activity_seq")


def _subscriber_bands(inputs: UsageInputs, mode: str, truncate_ids: bool) -> DataFrame:
    """(subscription_id, age_bands): the bands the file gives a subscriber,
    gathered as a bit mask so the aggregate stays a hash aggregate."""
    bit = F.lit(0)
    for i, band in enumerate(AGE_BANDS):
        bit = F.when(F.col("age_band") == band, F.lit(1 << i)).otherwise(bit)
    names = F.array_compact(F.array(*[F.when(F.col("bands").bitwiseAND(F.lit(1 << i)) != 0, F.lit(band))
                                      for i, band in enumerate(AGE_BANDS)]))
    return (subscriber_age_bands(inputs, mode, truncate_ids)
            .groupBy("subscription_id").agg(F.bit_or(bit).alias("bands"))
            .select("subscription_id", names.alias("age_bands")))


def _banded(first: DataFrame, inputs: UsageInputs, mode: str, truncate_ids: bool) -> DataFrame:
    """First plans joined with the subscribers' bands: (age_band, plan id,
    subscription_id), a subscriber once per band even if the file repeats them."""
    # Grouping by subscriber alone leaves both join
    # sides hash-partitioned on subscription_id, so the sort-merge join at
    # scale needs no further shuffle of either side.
    return (_subscriber_bands(inputs, mode, truncate_ids).join(first, "subscription_id", "inner")
            .select(F.explode("age_bands").alias("age_band"), PLAN_ID, "subscription_id"))


def subscriber_plan(inputs: UsageInputs, mode: str = STRICT, truncate_ids: bool = False) -> DataFrame:
    """(age_band, rate_plan_product_id, subscription_id) for subscribers
    that have both an age and a usage record (inner join)."""
    return _banded(first_plan_per_subscriber(inputs, truncate_ids, mode), inputs, mode, truncate_ids)


def subscriber_plan_or_zero(inputs: UsageInputs, mode: str = STRICT,
                            truncate_ids: bool = False) -> DataFrame:
    """(rate_plan_product_id, subscription_id) for every subscriber seen in
    usage or in the subscriber file: the first plan, or 0 without usage.
    A union + groupBy merges the two sides null-safely, like a co-group."""
    first = first_plan_per_subscriber(inputs, truncate_ids, mode).select(
        "subscription_id", PLAN_ID, F.lit(True).alias("has_usage"))
    subs = subscriber_age_bands(inputs, mode, truncate_ids).select(
        "subscription_id", F.lit(None).cast("int").alias(PLAN_ID), F.lit(False).alias("has_usage"))
    merged = first.unionByName(subs).groupBy("subscription_id").agg(
        F.max(PLAN_ID).alias(PLAN_ID), F.max("has_usage").alias("has_usage"))
    return merged.select(
        F.when(F.col("has_usage"), F.col(PLAN_ID)).otherwise(F.lit(0)).alias(PLAN_ID),
        "subscription_id")


def _name_plans(per_key: DataFrame, inputs: UsageInputs, mode: str = STRICT, count_mode: str = KEYS) -> DataFrame:
    """Plan names of one row per plan id, or in ``subscribers`` mode of one per
    plan id and subscriber, which a hot plan has very many of."""
    catalogue = plan_catalogue(inputs, mode)
    named = (salted_lookup(per_key, catalogue, PLAN_ID, "rate_plan_name", SUBSCRIBER_COL)
             if count_mode == SUBSCRIBERS else lookup(per_key, catalogue, PLAN_ID, "rate_plan_name"))
    return named.withColumn(PLAN_NAME, plan_label("rate_plan_name")).drop("rate_plan_name")


def _series_per_key(inputs: UsageInputs, mode: str, truncate_ids: bool, count_mode: str) -> DataFrame:
    """(series, rate_plan_product_id[, subscription_id], n_records) for the
    overall series and the four bands."""
    usage = plan_usage(inputs, truncate_ids, mode)
    if count_mode == SUBSCRIBERS:
        return _series_per_subscriber(usage, inputs, mode, truncate_ids)
    overall = per_key_counts(usage, [PLAN_ID]).select(F.lit(OVERALL).alias("series"), PLAN_ID, "n_records")
    first = first_by(usage, "subscription_id", PLAN_ID, "activity_seq")
    banded = per_key_counts(_banded(first, inputs, mode, truncate_ids), ["age_band", PLAN_ID]) \
        .select(F.col("age_band").alias("series"), PLAN_ID, "n_records")
    return overall.unionByName(banded)


def _series_per_subscriber(usage: DataFrame, inputs: UsageInputs, mode: str, truncate_ids: bool) -> DataFrame:
    """Both kinds of series from one aggregate of usage by (plan, subscriber):
    every such row counts overall, and the one of the subscriber's first plan
    in the subscriber's bands.  The window holds a subscriber's plans, at most
    as many as there are plan ids."""
    per_plan = usage.groupBy(PLAN_ID, "subscription_id").agg(
        F.min("activity_seq").alias("activity_seq"), F.count(F.lit(1)).alias("n_records"))
    arrival = Window.partitionBy("subscription_id").orderBy(
        F.col("activity_seq").asc_nulls_last(), F.col(PLAN_ID).asc_nulls_last())
    rows = per_plan.withColumn("place", F.row_number().over(arrival)).join(
        _subscriber_bands(inputs, mode, truncate_ids), "subscription_id", "left")
    none = F.array().cast("array<string>")
    bands = F.when(F.col("place") == 1, F.coalesce("age_bands", none)).otherwise(none)
    return rows.select(F.explode(F.concat(F.array(F.lit(OVERALL)), bands)).alias("series"),
                       PLAN_ID, "subscription_id", "n_records")


def plan_usage_counts(inputs: UsageInputs, count_mode: str = KEYS, mode: str = STRICT,
                      truncate_ids: bool = False) -> DataFrame:
    """(plan_name, n) over all usage."""
    per_key = per_key_counts(plan_usage(inputs, truncate_ids, mode), key_columns([PLAN_ID], count_mode))
    return per_name_counts(_name_plans(per_key, inputs, mode, count_mode), [], PLAN_NAME, count_mode)


def plan_by_age_counts(inputs: UsageInputs, count_mode: str = KEYS, mode: str = STRICT,
                       truncate_ids: bool = False) -> DataFrame:
    """(age_band, plan_name, n) from each subscriber's first plan."""
    per_key = per_key_counts(subscriber_plan(inputs, mode, truncate_ids),
                             key_columns(["age_band", PLAN_ID], count_mode))
    return per_name_counts(_name_plans(per_key, inputs, mode, count_mode), ["age_band"], PLAN_NAME, count_mode)


def top_plans(inputs: UsageInputs, k: int = 5, descending: bool = True,
              count_mode: str = KEYS) -> DataFrame:
    """(rank, plan_name) — top (or least) k plans over all usage."""
    return top_k(plan_usage_counts(inputs, count_mode), k, descending, [], "n", PLAN_NAME)


def top_plans_by_age(inputs: UsageInputs, k: int = 5, descending: bool = True,
                     count_mode: str = KEYS, mode: str = STRICT) -> DataFrame:
    """(age_band, rank, plan_name) — top (or least) k plans per band."""
    return top_k(plan_by_age_counts(inputs, count_mode, mode), k, descending,
                 ["age_band"], "n", PLAN_NAME)


def plan_subscriber_lists(inputs: UsageInputs, size: int = LIST_SIZE, mode: str = STRICT,
                          truncate_ids: bool = False) -> DataFrame:
    """(rate_plan_product_id, chunk, subscribers): the subscriber of every
    usage record of a plan, in lists of at most ``size``."""
    usage = plan_usage(inputs, truncate_ids, mode)
    return chunked_lists(usage, PLAN_ID, SUBSCRIBER_COL, size).withColumnRenamed("values", "subscribers")


# ---------------------------------------------------------------- product
def rate_plan_trends(inputs: UsageInputs, count_mode: str = KEYS, mode: str = STRICT,
                     truncate_ids: bool = False, k: int = 5,
                     fill: str | None = GENERAL_PLAN) -> DataFrame:
    """One row per rank 1..k; a missing rank in a list reads
    ``General Plan`` (as in the original), or stays null with ``fill=None``."""
    ranked = ranked_plan_lists(inputs, count_mode, mode, truncate_ids, k)
    return merge_ranks(ranked, "series", PLAN_NAME, SERIES_COLUMNS, fill).to(RATE_PLAN_TRENDS)


def ranked_plan_lists(inputs: UsageInputs, count_mode: str = KEYS, mode: str = STRICT,
                      truncate_ids: bool = False, k: int = 5) -> DataFrame:
    """The 10 ranked lists in long form, before the rank merge:
    (series, rank, plan_name) with series ``top_all`` ... ``least_18_less``."""
    check_mode(mode)
    named = _name_plans(_series_per_key(inputs, mode, truncate_ids, count_mode), inputs, mode, count_mode)
    counts = per_name_counts(named, ["series"], PLAN_NAME, count_mode)
    return top_and_least(counts, k, "series", PLAN_NAME)


def plan_name_lookup(inputs: UsageInputs, truncate_ids: bool = False, mode: str = STRICT) -> DataFrame:
    """(rate_plan_product_id, plan_name, n_records): every plan id seen in
    usage, once, with its catalogue name or the fallback label."""
    per_key = per_key_counts(plan_usage(inputs, truncate_ids, mode), [PLAN_ID])
    return _name_plans(per_key, inputs, mode).select(PLAN_ID, PLAN_NAME, "n_records")
