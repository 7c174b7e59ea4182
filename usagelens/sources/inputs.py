"""The bundle of six input DataFrames every product reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class UsageInputs:
    voice_call_record: DataFrame      # subscription_id, actual_duration, called_location_cd
    sms_record: DataFrame             # subscription_id, network_id, called_location_cd
    mobile_data_activity: DataFrame   # subscription_id, uplink/downlink text, plan id, arrival seq
    subscriber: DataFrame             # raw CSV lines, one column ``value``
    rate_plan_product: DataFrame      # catalogue: rate_plan_product_id, rate_plan_name
    location: DataFrame               # catalogue: location_cd, country
    quoted_subscribers: bool = False  # whether fields of subscriber lines may be quoted
