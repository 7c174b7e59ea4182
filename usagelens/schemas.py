"""Explicit schemas for every source and sink.

Sink column names and label texts are fixed values: they must equal the
names the original jobs publish so downstream readers keep working.
"""

from __future__ import annotations

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype(), True) for name, dtype in fields])


# ---------------------------------------------------------------- inputs
VOICE_CALL_RECORD = _struct(
    ("subscription_id", StringType),
    ("actual_duration", LongType),
    ("called_location_cd", StringType),
)

SMS_RECORD = _struct(
    ("subscription_id", StringType),
    ("network_id", StringType),
    ("called_location_cd", StringType),
)

# ``activity_seq`` is the arrival order of a record; it makes "the first
# plan of a subscriber" deterministic.
MOBILE_DATA_ACTIVITY = _struct(
    ("subscription_id", StringType),
    ("uplink_volume", StringType),
    ("downlink_volume", StringType),
    ("rate_plan_product_id", IntegerType),
    ("activity_seq", LongType),
)

SUBSCRIBER_LINES = _struct(("value", StringType))

RATE_PLAN_PRODUCT = _struct(
    ("rate_plan_product_id", IntegerType),
    ("rate_plan_name", StringType),
)

LOCATION = _struct(
    ("location_cd", StringType),
    ("country", StringType),
)

# ---------------------------------------------------------------- fixed values
# Output column names, band names and fallback labels (fixed values).
ACTIVITY_COLUMNS = [
    "subscription_id", "shortest_call", "longest_call",
    "total_sms_sent", "total_uplink_vol", "total_downlink_vol",
]

TREND_COLUMNS = [
    "top_five_plans_name_per_usage", "least_five_plans_name_per_usage",
    "top5_plan_grouped50_plus", "least5_plan_grouped50_plus",
    "top5_plan_grouped30_50", "least5_plan_grouped30_50",
    "top5_plan_grouped18_30", "least5_plan_grouped18_30",
    "top5_plan_grouped18_less", "least5_plan_grouped18_less",
]

AGE_BANDS = ["50_plus", "30_50", "18_30", "18_less"]

NETWORK_COLUMNS = [
    "Top5_busiest_locations_with_highest_SMS",
    "Top5_locations_with_lowest_SMS",
    "Top5_busiest_locations_with_highest_mobile_data_activity",
    "Top5_locations_with_least_mobile_data_activity",
]

NETWORK_DOCUMENT_FIELDS = [
    "Top 5 busiest locations with the highest SMS",
    "Top 5 locations with the lowest SMS",
    "Top 5 busiest locations with the highest mobile_data_activity",
    "Top 5 locations with the lowest mobile_data_activity",
]

GENERAL_PLAN = "General Plan"
NOT_KNOWN = "Not known"
COUNTRY_SUFFIX = " country"
ID_WIDTH = 15  # VARCHAR(15) of the relational scans

# ---------------------------------------------------------------- outputs
ACTIVITY_SNAPSHOT = _struct(*[(c, LongType) for c in ACTIVITY_COLUMNS])

RATE_PLAN_TRENDS = _struct(("rank", LongType), *[(c, StringType) for c in TREND_COLUMNS])

NETWORK_ACTIVITY = _struct(("rank", LongType), *[(c, StringType) for c in NETWORK_COLUMNS])

NETWORK_DOCUMENT = _struct(("_id", StringType), ("Rank", LongType),
                           *[(c, StringType) for c in NETWORK_DOCUMENT_FIELDS])

REJECTS = _struct(("product", StringType), ("source", StringType), ("key", StringType),
                  ("value", StringType), ("reason", StringType))

INPUTS = {
    "voice_call_record": VOICE_CALL_RECORD,
    "sms_record": SMS_RECORD,
    "mobile_data_activity": MOBILE_DATA_ACTIVITY,
    "subscriber": SUBSCRIBER_LINES,
    "rate_plan_product": RATE_PLAN_PRODUCT,
    "location": LOCATION,
}
