"""Column-level functions (all built-in Spark expressions, no Python UDFs)."""

from usagelens.functions.cleaning import (
    STRICT, LENIENT, check_mode, truncate_id, integer_id, id_is_bad, clean_volume, volume_is_bad,
    subscriber_fields, subscriber_line_is_bad, age_band, age_is_bad,
)
from usagelens.functions.labels import plan_label, country_label

__all__ = [
    "STRICT", "LENIENT", "check_mode", "truncate_id", "integer_id", "id_is_bad", "clean_volume", "volume_is_bad",
    "subscriber_fields", "subscriber_line_is_bad", "age_band", "age_is_bad",
    "plan_label", "country_label",
]
