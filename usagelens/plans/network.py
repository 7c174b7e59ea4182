"""P3 — network activity snapshot: top-5 and least-5 countries by SMS and
by voice-call records (4 ranked lists merged on rank).

Plan: both location scans are pre-aggregated per location code (partial
aggregates, one shuffle each), tagged and unioned, resolved to countries
by ONE lookup join on a deduplicated location catalogue,
counted per (series, country), ranked with ``WindowGroupLimit`` and
pivoted once.  A code without a country reads ``<code> country``; a
null code cannot be labelled (strict: the job fails; lenient: rejected).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.cleaning import LENIENT, STRICT, check_mode
from usagelens.functions.labels import country_label
from usagelens.operators.counting import KEYS, SUBSCRIBER_COL, SUBSCRIBERS, key_columns, per_key_counts, per_name_counts
from usagelens.operators.lookups import lookup, salted_lookup
from usagelens.operators.ranking import merge_ranks, top_and_least, top_k
from usagelens.schemas import NETWORK_ACTIVITY, NETWORK_COLUMNS, NOT_KNOWN
from usagelens.sources import UsageInputs, location_catalogue, scan

SMS = "sms"
VOICE = "voice"
# series -> dataset it counts ("mobile data activity" reads voice calls)
SERIES_DATASETS = {SMS: "sms_location", VOICE: "mobile_location"}

SERIES_COLUMNS = dict(zip(["top_sms", "least_sms", "top_voice", "least_voice"], NETWORK_COLUMNS))


def location_records(inputs: UsageInputs, series: str, mode: str = STRICT,
                     truncate_ids: bool = False) -> DataFrame:
    """(subscription_id, location_cd) of one series."""
    df = scan(inputs, SERIES_DATASETS[series], truncate_ids=truncate_ids)
    if mode == LENIENT:
        df = df.where(F.col("location_cd").isNotNull())
    return df


def location_rejects(inputs: UsageInputs, truncate_ids: bool = False) -> DataFrame:
    """Records lenient mode leaves out: null location codes."""
    out = None
    for series, dataset in SERIES_DATASETS.items():
        bad = (scan(inputs, dataset, truncate_ids=truncate_ids)
               .where(F.col("location_cd").isNull())
               .select(F.lit(series).alias("series"), "subscription_id",
                       F.lit("null location code").alias("reason")))
        out = bad if out is None else out.unionByName(bad)
    return out


def _name_locations(per_key: DataFrame, inputs: UsageInputs, mode: str, truncate_ids: bool,
                    count_mode: str = KEYS) -> DataFrame:
    catalogue = location_catalogue(inputs, truncate_ids)
    named = (salted_lookup(per_key, catalogue, "location_cd", "country", SUBSCRIBER_COL)
             if count_mode == SUBSCRIBERS else lookup(per_key, catalogue, "location_cd", "country"))
    label = country_label("country", "location_cd")
    if mode == STRICT:
        label = F.coalesce(label, F.raise_error(F.lit("null location code cannot be labelled")))
    return named.withColumn("country", label)


def country_counts(inputs: UsageInputs, series: str, count_mode: str = KEYS,
                   mode: str = STRICT, truncate_ids: bool = False) -> DataFrame:
    """(country, n) for one series."""
    per_key = per_key_counts(location_records(inputs, series, mode, truncate_ids),
                             key_columns(["location_cd"], count_mode))
    return per_name_counts(_name_locations(per_key, inputs, mode, truncate_ids, count_mode), [], "country", count_mode)


def country_lookup(inputs: UsageInputs, series: str, mode: str = STRICT,
                   truncate_ids: bool = False) -> DataFrame:
    """(location_cd, country, n_records): every code seen in one series with
    its resolved country label."""
    per_key = per_key_counts(location_records(inputs, series, mode, truncate_ids), ["location_cd"])
    return _name_locations(per_key, inputs, mode, truncate_ids).select("location_cd", "country", "n_records")


def top_countries(inputs: UsageInputs, series: str, k: int = 5, descending: bool = True,
                  count_mode: str = KEYS, mode: str = STRICT) -> DataFrame:
    """(rank, country) — top (or least) k countries of one series."""
    return top_k(country_counts(inputs, series, count_mode, mode), k, descending, [], "n", "country")


def network_activity(inputs: UsageInputs, count_mode: str = KEYS, mode: str = STRICT,
                     truncate_ids: bool = False, k: int = 5,
                     fill: str | None = NOT_KNOWN) -> DataFrame:
    check_mode(mode)
    per_key = None
    for series in SERIES_DATASETS:
        keys = key_columns(["location_cd"], count_mode)
        part = per_key_counts(location_records(inputs, series, mode, truncate_ids),
                              keys).select(F.lit(series).alias("series"), *keys, "n_records")
        per_key = part if per_key is None else per_key.unionByName(part)
    named = _name_locations(per_key, inputs, mode, truncate_ids, count_mode)
    counts = per_name_counts(named, ["series"], "country", count_mode)
    ranked = top_and_least(counts, k, "series", "country")
    return merge_ranks(ranked, "series", "country", SERIES_COLUMNS, fill).to(NETWORK_ACTIVITY)
