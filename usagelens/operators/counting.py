"""Keyed counting with the two counting modes, and first-value choice.

The original jobs emit exactly one (name, subscriber) pair per catalogue
key after the lookup co-group, so their "count per name" is the number
of *distinct keys* carrying that name.  Both readings are offered:

* ``keys``        — distinct keys per name (the original's literal result)
* ``records``     — records (usage rows, or subscribers in an age band) per name
* ``subscribers`` — distinct subscribers per name (what the original's
  comments describe); null subscriber ids are not counted

Both come from one pre-aggregation per key (``per_key_counts``), so the
large fact table is shuffled once, as partial aggregates, whatever the
mode; the lookup join and the per-name count then run on one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DateType, IntegerType, LongType, ShortType, StringType, TimestampNTZType, TimestampType,
)

KEYS = "keys"
RECORDS = "records"
SUBSCRIBERS = "subscribers"
COUNT_MODES = (KEYS, RECORDS, SUBSCRIBERS)
SUBSCRIBER_COL = "subscription_id"


def key_columns(group_cols: list[str], count_mode: str) -> list[str]:
    """Pre-aggregation keys: ``subscribers`` mode also keeps the subscriber,
    so distinct subscribers can be counted after the lookup."""
    return list(group_cols) + ([SUBSCRIBER_COL] if count_mode == SUBSCRIBERS else [])


def check_count_mode(mode: str) -> str:
    if mode not in COUNT_MODES:
        raise ValueError(f"count_mode must be one of {COUNT_MODES}, got {mode!r}")
    return mode


def per_key_counts(df: DataFrame, group_cols: list[str]) -> DataFrame:
    """Rows per key (null keys form one group) -> ``n_records``."""
    return df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n_records"))


def per_name_counts(per_key: DataFrame, group_cols: list[str], name_col: str,
                    count_mode: str) -> DataFrame:
    """From one row per (group, key[, subscriber]) with ``n_records`` and a
    resolved ``name_col`` -> one row per (group, name) with column ``n``."""
    check_count_mode(count_mode)
    if count_mode == SUBSCRIBERS:
        # two steps: distinct (name, subscriber) pairs, spread by both, then partial counts per name
        once = per_key.groupBy(*group_cols, name_col, SUBSCRIBER_COL).agg(F.lit(1).alias("once"))
        return once.groupBy(*group_cols, name_col).agg(F.count(SUBSCRIBER_COL).cast("long").alias("n"))
    n = F.count(F.lit(1)) if count_mode == KEYS else F.sum("n_records")
    return per_key.groupBy(*group_cols, name_col).agg(n.cast("long").alias("n"))


# An integral order and a value of at most 32 bits are packed into one
# DECIMAL(38,0) whose minimum is the lexicographic minimum of the pair.  A
# decimal buffer is fixed-width, so Spark keeps a hash aggregate (partial +
# final); ordering by a struct would fall back to a sort-based aggregate.
#   key    = order' * (2^32 + 1) + value'
#   order' = order + 2^63, in [0, 2^64); a null order -> 2^64 (last)
#   value' = value + 2^31, in [0, 2^32); a null value -> 2^32 (last)
# The largest key is below 2^97 < 10^38, so every pair packs exactly.
_ORDER_SHIFT, _NULL_ORDER = 2 ** 63, 2 ** 64
_VALUE_SHIFT, _NULL_VALUE = 2 ** 31, 2 ** 32
_BASE = 2 ** 32 + 1
_NARROW = (IntegerType, ShortType, ByteType)
_INTEGRAL = (LongType, *_NARROW)


def _dec(value: int) -> Column:
    return F.expr(f"CAST({value} AS DECIMAL(38,0))")


def _packed(value: Column, order: Column) -> Column:
    order_ = F.when(order.isNull(), _dec(_NULL_ORDER)).otherwise(order.cast("decimal(38,0)") + _dec(_ORDER_SHIFT))
    value_ = F.when(value.isNull(), _dec(_NULL_VALUE)).otherwise(value.cast("decimal(38,0)") + _dec(_VALUE_SHIFT))
    return (order_ * _dec(_BASE) + value_).cast("decimal(38,0)")


def _unpacked(key: Column, value_type) -> Column:
    rest = (key % _dec(_BASE)).cast("decimal(38,0)")
    return F.when(rest == _dec(_NULL_VALUE), F.lit(None)).otherwise(rest - _dec(_VALUE_SHIFT)).cast(value_type)


# A text arrival is compared by its UTF-8 bytes.  The first TEXT_HEAD bytes
# fit one decimal, the next TEXT_TAIL one together with the value; each part is
# followed by the number of bytes it has, so that "a" comes before "a\\0".
TEXT_HEAD, TEXT_TAIL = 15, 11


def _text_part(order: Column, start: int, size: int) -> Column:
    """``size`` bytes of a text from ``start`` on as a number below 16 * 256 ** size."""
    part = F.substring(order.cast("binary"), start + 1, size)
    digits = F.rpad(F.hex(part), 2 * size, "0")
    number = F.lit(0).cast("decimal(38,0)")
    for at in range(0, 2 * size, 14):  # conv is exact up to 64 bits
        width = min(14, 2 * size - at)
        word = F.conv(F.substring(digits, at + 1, width), 16, 10).cast("decimal(20,0)")
        number = (number * _dec(16 ** width) + word).cast("decimal(38,0)")
    return (number * _dec(16) + F.length(part)).cast("decimal(38,0)")


def _first_by_text(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Two hash aggregates: the smallest head per key, then, among the rows
    that have it, the smallest (tail, value).  The join between them is on key
    and head, so a hot key's rows are spread by when they arrived."""
    text = F.col(order)
    longest = TEXT_HEAD + TEXT_TAIL
    checked = F.when(F.octet_length(text) > longest, F.raise_error(
        F.concat(F.lit(f"arrival text is longer than {longest} bytes: "), text)).cast("string")).otherwise(text)
    head = F.coalesce(_text_part(checked, 0, TEXT_HEAD), _dec(16 * 256 ** TEXT_HEAD))  # null comes last
    tail = F.coalesce(_text_part(text, TEXT_HEAD, TEXT_TAIL), _dec(0))
    own = F.when(F.col(value).isNull(), _dec(_NULL_VALUE)).otherwise(
        F.col(value).cast("decimal(38,0)") + _dec(_VALUE_SHIFT))
    rows = df.select(F.col(key), head.alias("head"), (tail * _dec(_BASE) + own).cast("decimal(38,0)").alias("rest"))
    low = rows.groupBy(F.col(key).alias("low_key")).agg(F.min("head").alias("low_head"))
    first = rows.join(low, F.col(key).eqNullSafe(F.col("low_key")) & (F.col("head") == F.col("low_head")), "left_semi")
    return first.groupBy(key).agg(_unpacked(F.min("rest"), df.schema[value].dataType).alias(value))


def first_by(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per ``key``: the ``value`` of its first record by ``order``
    (ties broken by the smaller value; null orders and values sort last).  An
    aggregate, not a window: a hot key is reduced map-side instead of
    being sorted in one task.

    Orders may be integers, dates, timestamps (with or without a zone; one
    hash aggregate of the packed pair) or text of up to TEXT_HEAD + TEXT_TAIL
    bytes (two, see ``_first_by_text``); values up to 32 bits.  Other types
    fall back to a sort-based aggregate.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    if isinstance(types[value], _NARROW):
        if isinstance(types[order], StringType):
            return _first_by_text(df, key, value, order)
        instant = _instant(F.col(order), types[order])
        if instant is not None:
            return df.groupBy(key).agg(_unpacked(F.min(_packed(F.col(value), instant)), types[value]).alias(value))
    ordering = F.struct(F.col(order).isNull(), F.col(order), F.col(value).isNull(), F.col(value))
    return df.groupBy(key).agg(F.min_by(F.col(value), ordering).alias(value))


def _instant(order: Column, kind) -> Column | None:
    """The order as an integer, if its type has one."""
    if isinstance(kind, _INTEGRAL):
        return order
    if isinstance(kind, DateType):
        return F.unix_date(order)
    if isinstance(kind, TimestampNTZType):  # its fields, whatever the session's zone
        minutes = (F.unix_date(order.cast("date")).cast("long") * 24 + F.hour(order)) * 60 + F.minute(order)
        return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), order) * 1_000_000).cast("long")
    if isinstance(kind, TimestampType):
        return F.unix_micros(order)
    return None
