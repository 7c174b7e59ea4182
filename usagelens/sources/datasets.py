"""Named scans over the telecom inputs (the original jobs' fixed queries).

``scan(inputs, name)`` projects only the columns a product needs, so
column pruning reaches the Parquet/JDBC source.  The original P2/P3
scans read only "the first 100 rows" without an order; here a row limit
is optional, off by default, and always taken in a stated total order
(``operators.selection``: range counts find the n-th row, then a filter).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions.cleaning import STRICT, integer_id, truncate_id
from usagelens.operators.selection import first_rows
from usagelens.sources.inputs import UsageInputs


def _id(c: str, truncate: bool, alias: str | None = None) -> Column:
    col = truncate_id(c) if truncate else F.col(c).cast("string")
    return col.alias(alias or c)


def _voice_call(i: UsageInputs, truncate: bool, mode: str) -> DataFrame:
    return i.voice_call_record.select("subscription_id", "actual_duration")


def _sms_rec(i: UsageInputs, truncate: bool, mode: str) -> DataFrame:
    return i.sms_record.select("subscription_id", "network_id")


def _data_volume(i: UsageInputs, truncate: bool, mode: str) -> DataFrame:
    return i.mobile_data_activity.select("subscription_id", "uplink_volume", "downlink_volume")


def _sub_rec(i: UsageInputs, truncate: bool, mode: str) -> DataFrame:
    return i.mobile_data_activity.select(
        integer_id("rate_plan_product_id", mode).alias("rate_plan_product_id"),
        _id("subscription_id", truncate), F.col("activity_seq"))


def _sms_location(i: UsageInputs, truncate: bool, mode: str) -> DataFrame:
    return i.sms_record.select(_id("subscription_id", truncate),
                               _id("called_location_cd", truncate, "location_cd"))


def _mobile_location(i: UsageInputs, truncate: bool, mode: str) -> DataFrame:
    return i.voice_call_record.select(_id("subscription_id", truncate),
                                      _id("called_location_cd", truncate, "location_cd"))


# name -> (projection, order used when a row limit is requested)
DATASETS: dict[str, tuple[Callable[[UsageInputs, bool, str], DataFrame], list[str]]] = {
    "voice_call": (_voice_call, ["subscription_id", "actual_duration"]),
    "sms_rec": (_sms_rec, ["subscription_id", "network_id"]),
    "data_volume": (_data_volume, ["subscription_id", "uplink_volume", "downlink_volume"]),
    "sub_rec": (_sub_rec, ["activity_seq", "rate_plan_product_id", "subscription_id"]),
    "sms_location": (_sms_location, ["subscription_id", "location_cd"]),
    "mobile_location": (_mobile_location, ["subscription_id", "location_cd"]),
}


def scan(inputs: UsageInputs, name: str, limit: int | None = None,
         truncate_ids: bool = False, mode: str = STRICT) -> DataFrame:
    """Named dataset; ``limit`` keeps the first n rows in the dataset's
    stated order (nulls first), never an arbitrary subset.  ``truncate_ids``
    cuts ids to 15 characters as the original's relational scans did; it
    merges ids that agree so far, so it is off unless asked for."""
    if name not in DATASETS:
        raise KeyError(f"unknown dataset {name!r}; known: {sorted(DATASETS)}")
    project, order = DATASETS[name]
    df = project(inputs, truncate_ids, mode)
    if limit is not None:
        df = first_rows(df, limit, order)
    return df


def plan_catalogue(inputs: UsageInputs, mode: str = STRICT) -> DataFrame:
    """(rate_plan_product_id, rate_plan_name) with the id as a number, from
    documents whose fields may all be text."""
    return inputs.rate_plan_product.select(
        integer_id("rate_plan_product_id", mode).alias("rate_plan_product_id"),
        F.col("rate_plan_name").cast("string").alias("rate_plan_name"))


def location_catalogue(inputs: UsageInputs, truncate_ids: bool = False) -> DataFrame:
    """(location_cd, country); codes are cut when the facts' are."""
    return inputs.location.select(_id("location_cd", truncate_ids), F.col("country").cast("string").alias("country"))
