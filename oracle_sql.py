"""DuckDB oracle queries for every registered Spark query.

Written independently of the Spark code, in the plainest SQL form:
the telecom inputs are CTEs over the driver tables, the products are
joins of per-fact aggregates and ``row_number`` windows.  Every count,
sum and rank is cast to BIGINT; ties are broken by name; every column is
aliased to the Spark column name.
"""

from __future__ import annotations

SOURCES = """
voice_call_record AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS subscription_id,
         CAST(floor(o.o_totalprice / 1000) AS BIGINT) AS actual_duration,
         'L' || CAST(c.c_nationkey AS VARCHAR) AS called_location_cd
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
sms_record AS (
  SELECT CAST(e.user_id AS VARCHAR) AS subscription_id,
         e.event_type AS network_id,
         'L' || CAST(c.c_nationkey AS VARCHAR) AS called_location_cd
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey),
mobile_data_activity AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS subscription_id,
         CASE WHEN l.l_linenumber = 1 THEN ' '
              ELSE CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR) END AS uplink_volume,
         CAST(CAST(floor(l.l_extendedprice) AS BIGINT) AS VARCHAR) AS downlink_volume,
         CAST(l.l_partkey AS INTEGER) AS rate_plan_product_id,
         CAST(l.l_orderkey * 10 + l.l_linenumber AS BIGINT) AS activity_seq
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey),
subscriber AS (
  SELECT concat_ws(',', CAST(c_custkey AS VARCHAR), c_name, c_mktsegment,
                   CAST(c_nationkey AS VARCHAR), 'L' || CAST(c_nationkey AS VARCHAR),
                   CAST(c_custkey % 90 AS VARCHAR)) AS value
  FROM customer),
rate_plan_product AS (
  SELECT CAST(p_partkey AS INTEGER) AS rate_plan_product_id, p_name AS rate_plan_name FROM part),
location AS (
  SELECT 'L' || CAST(n.n_nationkey AS VARCHAR) AS location_cd, r.r_name AS country
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
volumes AS (
  SELECT subscription_id,
         CASE WHEN uplink_volume = ' ' THEN 0 ELSE CAST(uplink_volume AS BIGINT) END AS uplink_volume,
         CASE WHEN downlink_volume = ' ' THEN 0 ELSE CAST(downlink_volume AS BIGINT) END AS downlink_volume
  FROM mobile_data_activity),
plan_usage AS (
  SELECT CAST(rate_plan_product_id AS INTEGER) AS rate_plan_product_id, subscription_id, activity_seq
  FROM mobile_data_activity),
sms_location AS (
  SELECT subscription_id, called_location_cd AS location_cd FROM sms_record),
voice_location AS (
  SELECT subscription_id, called_location_cd AS location_cd FROM voice_call_record),
parsed AS (
  SELECT split_part(value, ',', 1) AS subscription_id,
         CAST(split_part(value, ',', 6) AS INTEGER) AS age
  FROM subscriber),
banded AS (
  SELECT subscription_id, age,
         CASE WHEN age >= 50 THEN '50_plus' WHEN age >= 30 THEN '30_50'
              WHEN age >= 18 THEN '18_30' ELSE '18_less' END AS age_band
  FROM parsed),
"""

# The dirty inputs, cleaned leniently.
DIRTY = """
voice_call_record AS (
  SELECT CASE WHEN o.o_custkey % 97 = 0 THEN 'C-' || o.o_custkey ELSE CAST(o.o_custkey AS VARCHAR) END AS subscription_id,
         CAST(floor(o.o_totalprice / 1000) AS BIGINT) AS actual_duration,
         CASE WHEN o.o_custkey % 11 = 0 THEN NULL WHEN o.o_custkey % 13 = 0 THEN 'X' || c.c_nationkey
              ELSE 'L' || c.c_nationkey || '-' || (o.o_custkey % (c.c_nationkey + 1)) END AS called_location_cd
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
sms_record AS (
  SELECT CAST(e.user_id AS VARCHAR) AS subscription_id, e.event_type AS network_id,
         CASE WHEN e.user_id % 11 = 0 THEN NULL WHEN e.user_id % 13 = 0 THEN 'X' || c.c_nationkey
              ELSE 'L' || c.c_nationkey || '-' || (e.user_id % (c.c_nationkey + 1)) END AS called_location_cd
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey),
mobile_data_activity AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS subscription_id,
         CASE WHEN l.l_linenumber = 1 THEN ''
              WHEN l.l_linenumber = 2 AND o.o_orderpriority = '1-URGENT' THEN o.o_orderpriority
              ELSE CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR) END AS uplink_volume,
         CAST(CAST(floor(l.l_extendedprice) AS BIGINT) AS VARCHAR) AS downlink_volume,
         CASE WHEN l.l_partkey % 50 = 0 THEN 'P-' || l.l_partkey
              WHEN l.l_partkey % 17 = 0 THEN CAST(l.l_partkey + 1000000 AS VARCHAR)
              ELSE CAST(l.l_partkey AS VARCHAR) END AS rate_plan_product_id,
         CAST(l.l_orderkey * 10 + l.l_linenumber AS BIGINT) AS activity_seq
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey),
subscriber AS (
  SELECT concat_ws(',', CAST(c_custkey AS VARCHAR), c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR), 'x',
                   CASE WHEN c_custkey % 19 <> 0 THEN CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR) END) AS value
  FROM customer),
rate_plan_product AS (
  SELECT CAST(p_partkey AS INTEGER) AS rate_plan_product_id, p_name AS rate_plan_name FROM part),
location AS (
  SELECT 'L' || p.n || '-' || p.j AS location_cd, r.r_name AS country
  FROM (SELECT n_nationkey AS n, n_regionkey AS k, unnest(range(n_nationkey + 1)) AS j FROM nation) p
  LEFT JOIN region r ON p.k = r.r_regionkey),
volumes AS (
  SELECT subscription_id, coalesce(TRY_CAST(uplink_volume AS BIGINT), 0) AS uplink_volume,
         coalesce(TRY_CAST(downlink_volume AS BIGINT), 0) AS downlink_volume
  FROM mobile_data_activity
  WHERE (trim(uplink_volume) = '' OR TRY_CAST(uplink_volume AS BIGINT) IS NOT NULL)
    AND (trim(downlink_volume) = '' OR TRY_CAST(downlink_volume AS BIGINT) IS NOT NULL)),
plan_usage AS (
  SELECT TRY_CAST(rate_plan_product_id AS INTEGER) AS rate_plan_product_id, subscription_id, activity_seq
  FROM mobile_data_activity WHERE TRY_CAST(rate_plan_product_id AS INTEGER) IS NOT NULL),
sms_location AS (
  SELECT subscription_id, called_location_cd AS location_cd FROM sms_record WHERE called_location_cd IS NOT NULL),
voice_location AS (
  SELECT subscription_id, called_location_cd AS location_cd FROM voice_call_record WHERE called_location_cd IS NOT NULL),
parsed AS (
  SELECT split_part(value, ',', 1) AS subscription_id, TRY_CAST(split_part(value, ',', 6) AS INTEGER) AS age
  FROM subscriber WHERE TRY_CAST(split_part(value, ',', 6) AS INTEGER) IS NOT NULL),
banded AS (
  SELECT subscription_id, age,
         CASE WHEN age >= 50 THEN '50_plus' WHEN age >= 30 THEN '30_50'
              WHEN age >= 18 THEN '18_30' ELSE '18_less' END AS age_band
  FROM parsed WHERE age >= 0),
"""

PRODUCTS = """
first_plan AS (
  SELECT subscription_id, rate_plan_product_id FROM (
    SELECT subscription_id, rate_plan_product_id,
           row_number() OVER (PARTITION BY subscription_id
                              ORDER BY activity_seq, rate_plan_product_id) AS rn
    FROM plan_usage) WHERE rn = 1),
sub_plan AS (
  SELECT b.age_band, f.rate_plan_product_id, b.subscription_id
  FROM (SELECT DISTINCT subscription_id, age_band FROM banded) b
  JOIN first_plan f ON b.subscription_id = f.subscription_id),
plan_catalogue AS (
  SELECT rate_plan_product_id, min(rate_plan_name) AS rate_plan_name
  FROM rate_plan_product WHERE rate_plan_product_id IS NOT NULL GROUP BY 1),
location_catalogue AS (
  SELECT location_cd, min(country) AS country
  FROM location WHERE location_cd IS NOT NULL GROUP BY 1),
plan_keys AS (
  SELECT 'all' AS series, rate_plan_product_id, count(*) AS n_records
  FROM plan_usage GROUP BY rate_plan_product_id
  UNION ALL
  SELECT age_band, rate_plan_product_id, count(*) FROM sub_plan GROUP BY 1, 2),
plan_named AS (
  SELECT k.series, k.rate_plan_product_id, k.n_records,
         coalesce(c.rate_plan_name, 'General Plan') AS plan_name
  FROM plan_keys k LEFT JOIN plan_catalogue c ON k.rate_plan_product_id = c.rate_plan_product_id),
location_keys AS (
  SELECT 'sms' AS series, location_cd, count(*) AS n_records FROM sms_location GROUP BY location_cd
  UNION ALL
  SELECT 'voice', location_cd, count(*) FROM voice_location GROUP BY location_cd),
location_named AS (
  SELECT k.series, k.location_cd, k.n_records,
         coalesce(c.country, k.location_cd || ' country') AS country
  FROM location_keys k LEFT JOIN location_catalogue c ON k.location_cd = c.location_cd),
plan_sub_named AS (
  SELECT k.series, k.subscription_id, coalesce(c.rate_plan_name, 'General Plan') AS plan_name
  FROM (SELECT 'all' AS series, rate_plan_product_id, subscription_id FROM plan_usage
        UNION ALL
        SELECT age_band, rate_plan_product_id, subscription_id FROM sub_plan) k
  LEFT JOIN plan_catalogue c ON k.rate_plan_product_id = c.rate_plan_product_id),
location_sub_named AS (
  SELECT k.series, k.subscription_id, coalesce(c.country, k.location_cd || ' country') AS country
  FROM (SELECT 'sms' AS series, location_cd, subscription_id FROM sms_location
        UNION ALL
        SELECT 'voice', location_cd, subscription_id FROM voice_location) k
  LEFT JOIN location_catalogue c ON k.location_cd = c.location_cd)
"""


def _with(body: str, sources: str = SOURCES) -> str:
    return "WITH " + sources.strip() + "\n" + PRODUCTS.strip() + "\n" + body


def _dirty(sql: str) -> str:
    """The same query over the dirty inputs."""
    return sql.replace(SOURCES.strip(), DIRTY.strip())


_N = {"keys": "count(*)", "records": "sum(n_records)",
      "subscribers": "count(DISTINCT subscription_id)"}
_SUB_NAMED = {"plan_named": "plan_sub_named", "location_named": "location_sub_named"}


def _source(named: str, mode: str) -> str:
    return _SUB_NAMED[named] if mode == "subscribers" else named


def _counts(named: str, name: str, mode: str, extra_where: str = "") -> str:
    n = _N[mode]
    named = _source(named, mode)
    return (f"SELECT series, {name}, CAST({n} AS BIGINT) AS n FROM {named} "
            f"{extra_where} GROUP BY series, {name}")


def _ranked(counts_sql: str, name: str, k: int = 5) -> str:
    return f"""
, counts AS ({counts_sql})
, ranked AS (
  SELECT 'top_' || series AS s, name_col, rank FROM (
    SELECT series, {name} AS name_col,
           row_number() OVER (PARTITION BY series ORDER BY n DESC, {name}) AS rank FROM counts)
  WHERE rank <= {k}
  UNION ALL
  SELECT 'least_' || series, name_col, rank FROM (
    SELECT series, {name} AS name_col,
           row_number() OVER (PARTITION BY series ORDER BY n ASC, {name}) AS rank FROM counts)
  WHERE rank <= {k})
"""


def _pivot(columns: dict[str, str], fill: str | None) -> str:
    fill = "NULL" if fill is None else f"'{fill}'"
    cols = ",\n  ".join(
        f"coalesce(max(CASE WHEN s = '{s}' THEN name_col END), {fill}) AS {c}"
        for s, c in columns.items())
    return f"SELECT CAST(rank AS BIGINT) AS rank,\n  {cols}\nFROM ranked GROUP BY rank"


_FIRST_BY = """
SELECT subscription_id, rate_plan_product_id FROM (
  SELECT subscription_id, rate_plan_product_id,
         row_number() OVER (PARTITION BY subscription_id ORDER BY {}, rate_plan_product_id) AS rn FROM plan_usage)
WHERE rn = 1"""

TREND_SERIES = {
    "top_all": "top_five_plans_name_per_usage", "least_all": "least_five_plans_name_per_usage",
    "top_50_plus": "top5_plan_grouped50_plus", "least_50_plus": "least5_plan_grouped50_plus",
    "top_30_50": "top5_plan_grouped30_50", "least_30_50": "least5_plan_grouped30_50",
    "top_18_30": "top5_plan_grouped18_30", "least_18_30": "least5_plan_grouped18_30",
    "top_18_less": "top5_plan_grouped18_less", "least_18_less": "least5_plan_grouped18_less",
}
NETWORK_SERIES = {
    "top_sms": "Top5_busiest_locations_with_highest_SMS",
    "least_sms": "Top5_locations_with_lowest_SMS",
    "top_voice": "Top5_busiest_locations_with_highest_mobile_data_activity",
    "least_voice": "Top5_locations_with_least_mobile_data_activity",
}
NETWORK_DOCS = {
    "top_sms": '"Top 5 busiest locations with the highest SMS"',
    "least_sms": '"Top 5 locations with the lowest SMS"',
    "top_voice": '"Top 5 busiest locations with the highest mobile_data_activity"',
    "least_voice": '"Top 5 locations with the lowest mobile_data_activity"',
}


def rate_plan_trends(mode: str) -> str:
    return _with(_ranked(_counts("plan_named", "plan_name", mode), "plan_name")
                 + _pivot(TREND_SERIES, "General Plan"))


def network_activity(mode: str, columns: dict[str, str] = NETWORK_SERIES,
                     rank_name: str = "rank") -> str:
    sql = _with(_ranked(_counts("location_named", "country", mode), "country")
                + _pivot(columns, "Not known"))
    return sql.replace("SELECT CAST(rank AS BIGINT) AS rank,", f"SELECT CAST(rank AS BIGINT) AS {rank_name},")


def _single_series(named: str, name: str, series: str, mode: str, descending: bool,
                   k: int = 5, by_band: bool = False) -> str:
    n = _N[mode]
    named = _source(named, mode)
    order = "DESC" if descending else "ASC"
    if by_band:
        return _with(f"""
SELECT age_band, CAST(rank AS BIGINT) AS rank, {name} FROM (
  SELECT series AS age_band, {name},
         row_number() OVER (PARTITION BY series ORDER BY n {order}, {name}) AS rank
  FROM (SELECT series, {name}, {n} AS n FROM {named} WHERE series <> 'all' GROUP BY 1, 2))
WHERE rank <= {k}""")
    return _with(f"""
SELECT CAST(rank AS BIGINT) AS rank, {name} FROM (
  SELECT {name}, row_number() OVER (ORDER BY n {order}, {name}) AS rank
  FROM (SELECT {name}, {n} AS n FROM {named} WHERE series = '{series}' GROUP BY 1))
WHERE rank <= {k}""")


ACTIVITY = _with("""
, ids AS (SELECT subscription_id FROM voice_call_record
          UNION SELECT subscription_id FROM sms_record
          UNION SELECT subscription_id FROM volumes)
, v AS (SELECT subscription_id, min(actual_duration) AS mn, max(actual_duration) AS mx
        FROM voice_call_record GROUP BY 1)
, s AS (SELECT subscription_id, count(*) AS n FROM sms_record GROUP BY 1)
, d AS (SELECT subscription_id, sum(uplink_volume) AS up, sum(downlink_volume) AS down
        FROM volumes GROUP BY 1)
SELECT CAST(ids.subscription_id AS BIGINT) AS subscription_id,
       CAST(coalesce(v.mn, 0) AS BIGINT) AS shortest_call,
       CAST(coalesce(v.mx, 0) AS BIGINT) AS longest_call,
       CAST(coalesce(s.n, 0) AS BIGINT) AS total_sms_sent,
       CAST(coalesce(d.up, 0) AS BIGINT) AS total_uplink_vol,
       CAST(coalesce(d.down, 0) AS BIGINT) AS total_downlink_vol
FROM ids
LEFT JOIN v ON ids.subscription_id IS NOT DISTINCT FROM v.subscription_id
LEFT JOIN s ON ids.subscription_id IS NOT DISTINCT FROM s.subscription_id
LEFT JOIN d ON ids.subscription_id IS NOT DISTINCT FROM d.subscription_id
""")
ACTIVITY_LENIENT = _dirty(ACTIVITY).replace(
    "SELECT CAST(ids.subscription_id AS BIGINT)", "SELECT TRY_CAST(ids.subscription_id AS BIGINT)") + \
    "WHERE ids.subscription_id IS NULL OR TRY_CAST(ids.subscription_id AS BIGINT) IS NOT NULL"

_BAD_PLAN = "rate_plan_product_id IS NOT NULL AND TRY_CAST(rate_plan_product_id AS INTEGER) IS NULL"
ACTIVITY_REJECTS = """
SELECT 'voice_call_record' AS source, subscription_id, subscription_id AS value,
       'subscription_id is not an integer' AS reason
FROM voice_call_record WHERE TRY_CAST(subscription_id AS BIGINT) IS NULL AND subscription_id IS NOT NULL
UNION ALL
SELECT 'sms_record', subscription_id, subscription_id, 'subscription_id is not an integer'
FROM sms_record WHERE TRY_CAST(subscription_id AS BIGINT) IS NULL AND subscription_id IS NOT NULL
UNION ALL
SELECT 'mobile_data_activity', subscription_id, subscription_id, 'subscription_id is not an integer'
FROM mobile_data_activity WHERE TRY_CAST(subscription_id AS BIGINT) IS NULL AND subscription_id IS NOT NULL
UNION ALL
SELECT 'mobile_data_activity', subscription_id,
       coalesce(uplink_volume, 'NULL') || '|' || coalesce(downlink_volume, 'NULL'), 'volume is not an integer'
FROM mobile_data_activity
WHERE (TRY_CAST(subscription_id AS BIGINT) IS NOT NULL OR subscription_id IS NULL)
  AND ((trim(uplink_volume) <> '' AND TRY_CAST(uplink_volume AS BIGINT) IS NULL)
       OR (trim(downlink_volume) <> '' AND TRY_CAST(downlink_volume AS BIGINT) IS NULL))"""
PLAN_REJECTS = f"""
SELECT 'mobile_data_activity' AS source, subscription_id AS key, rate_plan_product_id AS value,
       'rate_plan_product_id is not an integer' AS reason
FROM mobile_data_activity WHERE {_BAD_PLAN}"""
SUBSCRIBER_REJECTS = """
SELECT value, CASE WHEN len(string_split(value, ',')) < 6 OR TRY_CAST(split_part(value, ',', 6) AS INTEGER) IS NULL
                   THEN 'line has no integer age in field 5' ELSE 'negative age' END AS reason
FROM subscriber
WHERE len(string_split(value, ',')) < 6 OR TRY_CAST(split_part(value, ',', 6) AS INTEGER) IS NULL
   OR TRY_CAST(split_part(value, ',', 6) AS INTEGER) < 0"""
LOCATION_REJECTS = """
SELECT 'sms' AS series, subscription_id, 'null location code' AS reason
FROM sms_record WHERE called_location_cd IS NULL
UNION ALL
SELECT 'voice', subscription_id, 'null location code' FROM voice_call_record WHERE called_location_cd IS NULL"""


def oracle_queries() -> dict[str, str]:
    q = {
        # sources / scans
        "scan_voice": _with("SELECT subscription_id, actual_duration FROM voice_call_record"),
        "scan_sms": _with("SELECT subscription_id, network_id FROM sms_record"),
        "scan_volume": _with(
            "SELECT subscription_id, uplink_volume, downlink_volume FROM mobile_data_activity"),
        "scan_plan_usage": _with(
            "SELECT rate_plan_product_id, subscription_id, activity_seq FROM plan_usage"),
        "scan_sms_location": _with("SELECT subscription_id, location_cd FROM sms_location"),
        "scan_voice_location": _with("SELECT subscription_id, location_cd FROM voice_location"),
        "scan_subscriber_csv": _with("SELECT value FROM subscriber"),
        "lookup_rate_plan": _with(
            "SELECT rate_plan_product_id, rate_plan_name FROM rate_plan_product"),
        "lookup_location": _with("SELECT location_cd, country FROM location"),
        "limited_scan": _with("""
SELECT rate_plan_product_id, subscription_id, activity_seq FROM plan_usage
ORDER BY activity_seq NULLS FIRST, rate_plan_product_id NULLS FIRST, subscription_id NULLS FIRST
LIMIT 100"""),
        # cleaning / parsing
        "clean_volume": _with("SELECT subscription_id, uplink_volume, downlink_volume FROM volumes"),
        "parse_subscriber": _with("SELECT subscription_id, age FROM parsed"),
        "parse_subscriber_quoted": _with("SELECT subscription_id, age FROM parsed"),
        "age_band": _with("SELECT subscription_id, age, age_band FROM banded"),
        # joins
        "first_plan_per_subscriber": _with(
            "SELECT subscription_id, rate_plan_product_id FROM first_plan"),
        "subscriber_plan": _with(
            "SELECT age_band, rate_plan_product_id, subscription_id FROM sub_plan"),
        "subscriber_plan_or_zero": _with("""
, ids AS (SELECT subscription_id FROM first_plan UNION SELECT subscription_id FROM banded)
SELECT CASE WHEN f.has_usage THEN f.rate_plan_product_id ELSE 0 END AS rate_plan_product_id,
       ids.subscription_id
FROM ids LEFT JOIN (SELECT subscription_id, rate_plan_product_id, true AS has_usage FROM first_plan) f
  ON ids.subscription_id IS NOT DISTINCT FROM f.subscription_id"""),
        "plan_name_lookup": _with("""
SELECT rate_plan_product_id, plan_name, CAST(n_records AS BIGINT) AS n_records
FROM plan_named WHERE series = 'all'"""),
        "country_lookup": _with("""
SELECT location_cd, country, CAST(n_records AS BIGINT) AS n_records
FROM location_named WHERE series = 'sms'"""),
        "country_lookup_voice": _with("""
SELECT location_cd, country, CAST(n_records AS BIGINT) AS n_records
FROM location_named WHERE series = 'voice'"""),
        # aggregations
        "sms_count": _with(
            "SELECT subscription_id, CAST(count(*) AS BIGINT) AS total_sms_sent FROM sms_record GROUP BY 1"),
        "shortest_call": _with("""
SELECT subscription_id, CAST(min(actual_duration) AS BIGINT) AS shortest_call
FROM voice_call_record GROUP BY 1"""),
        "longest_call": _with("""
SELECT subscription_id, CAST(max(actual_duration) AS BIGINT) AS longest_call
FROM voice_call_record GROUP BY 1"""),
        "uplink_total": _with("""
SELECT subscription_id, CAST(sum(uplink_volume) AS BIGINT) AS total_uplink_vol
FROM volumes GROUP BY 1"""),
        "downlink_total": _with("""
SELECT subscription_id, CAST(sum(downlink_volume) AS BIGINT) AS total_downlink_vol
FROM volumes GROUP BY 1"""),
        # products
        "activity_snapshot": ACTIVITY,
        "rate_plan_trends": rate_plan_trends("keys"),
        "rate_plan_trends_records": rate_plan_trends("records"),
        "network_activity": network_activity("keys"),
        "network_activity_records": network_activity("records"),
        "rate_plan_trends_subscribers": rate_plan_trends("subscribers"),
        "network_activity_subscribers": network_activity("subscribers"),
        "rank_positions": _with(_ranked(_counts("plan_named", "plan_name", "keys"), "plan_name")
                                + "SELECT s AS series, CAST(rank AS BIGINT) AS rank, "
                                  "name_col AS plan_name FROM ranked"),
        "schema_contract": ACTIVITY,
        "varchar_truncate": "SELECT substr(c_name, 1, 15) AS c_name, count(*) AS n FROM customer GROUP BY 1",
        # lenient mode over the dirty inputs
        "activity_snapshot_lenient": ACTIVITY_LENIENT,
        "rate_plan_trends_lenient": _dirty(rate_plan_trends("keys")),
        "network_activity_lenient": _dirty(network_activity("keys")),
        "activity_rejects": _dirty(_with(ACTIVITY_REJECTS)),
        "plan_rejects": _dirty(_with(PLAN_REJECTS)),
        "subscriber_rejects": _dirty(_with(SUBSCRIBER_REJECTS)),
        "location_rejects": _dirty(_with(LOCATION_REJECTS)),
        "plan_name_lookup_fallback": _dirty(_with("""
SELECT rate_plan_product_id, plan_name, CAST(n_records AS BIGINT) AS n_records
FROM plan_named WHERE series = 'all'""")),
        "country_lookup_fallback": _dirty(_with("""
SELECT location_cd, country, CAST(n_records AS BIGINT) AS n_records
FROM location_named WHERE series = 'sms'""")),
        "run_all_rejects": _dirty(_with(f"""
, a AS ({ACTIVITY_REJECTS}), p AS ({PLAN_REJECTS}), s AS ({SUBSCRIBER_REJECTS}), l AS ({LOCATION_REJECTS})
SELECT 'activity' AS product, source, subscription_id AS key, value, reason FROM a
UNION ALL SELECT 'trends', source, key, value, reason FROM p
UNION ALL SELECT 'trends', 'subscriber', NULL, value, reason FROM s
UNION ALL SELECT 'network', CASE series WHEN 'sms' THEN 'sms_record' ELSE 'voice_call_record' END,
                 subscription_id, NULL, reason FROM l""")),
        "plan_subscriber_lists": _with("""
SELECT rate_plan_product_id, chunk, count(*) AS n, string_agg(subscription_id, ',' ORDER BY rn) AS subscribers
FROM (SELECT rate_plan_product_id, subscription_id, rn, (rn - 1) // 16 AS chunk FROM (
  SELECT rate_plan_product_id, subscription_id,
         row_number() OVER (PARTITION BY rate_plan_product_id ORDER BY subscription_id) AS rn FROM plan_usage))
GROUP BY 1, 2"""),
        "first_plan_text_arrival": _with(_FIRST_BY.format("CAST(activity_seq AS VARCHAR)")),
        "first_plan_time_arrival": _with(_FIRST_BY.format("to_timestamp(activity_seq % 1000)")),
        "topk_empty": _with("""
SELECT age_band, CAST(rank AS BIGINT) AS rank, plan_name FROM (
  SELECT age_band, plan_name, row_number() OVER (PARTITION BY age_band ORDER BY n DESC, plan_name) AS rank FROM (
    SELECT series AS age_band, plan_name, count(*) AS n FROM plan_named WHERE series <> 'all' GROUP BY 1, 2
    HAVING count(*) < 0))
WHERE rank <= 5"""),
        "rate_plan_trends_unfilled": _with(_ranked(_counts("plan_named", "plan_name", "keys"), "plan_name", 70)
                                           + _pivot(TREND_SERIES, None)),
        # sinks (round trips return what they wrote)
        "sink_activity_roundtrip": ACTIVITY,
        "sink_trend_roundtrip": rate_plan_trends("keys"),
        "sink_network_roundtrip": network_activity("keys"),
        "sink_network_documents": network_activity("keys", NETWORK_DOCS, "Rank").replace(
            "SELECT CAST(rank AS BIGINT) AS Rank,", "SELECT 'run-' || rank AS _id, CAST(rank AS BIGINT) AS Rank,"),
    }
    one = q["sink_network_documents"]
    both = f"SELECT * FROM ({one}) UNION ALL SELECT * FROM ({one.replace("'run-'", "'next-'")})"
    q["sink_network_documents_once"] = both
    q |= {"read_rate_plan_documents": q["lookup_rate_plan"], "read_location_documents": q["lookup_location"],
          "read_subscriber_lines": q["scan_subscriber_csv"], "read_activity_snapshot": ACTIVITY,
          "run_all_activity": ACTIVITY, "run_all_trends": q["rate_plan_trends"],
          "run_all_network": q["network_activity"]}
    for mode, suffix in (("keys", ""), ("records", "_records"), ("subscribers", "_subscribers")):
        n = _N[mode]
        plans, locations = _source("plan_named", mode), _source("location_named", mode)
        q["plan_usage_counts" + suffix] = _with(
            f"SELECT plan_name, CAST({n} AS BIGINT) AS n FROM {plans} WHERE series = 'all' GROUP BY 1")
        q["plan_by_age_counts" + suffix] = _with(
            f"SELECT series AS age_band, plan_name, CAST({n} AS BIGINT) AS n FROM {plans} "
            f"WHERE series <> 'all' GROUP BY 1, 2")
        for series, key in (("sms", "sms_country_counts"), ("voice", "voice_country_counts")):
            q[key + suffix] = _with(
                f"SELECT country, CAST({n} AS BIGINT) AS n FROM {locations} "
                f"WHERE series = '{series}' GROUP BY 1")
        if mode == "subscribers":
            continue
        for direction, desc in (("top5", True), ("least5", False)):
            q[f"{direction}_plans{suffix}"] = _single_series(
                "plan_named", "plan_name", "all", mode, desc)
            q[f"{direction}_plans_by_age{suffix}"] = _single_series(
                "plan_named", "plan_name", "", mode, desc, by_band=True)
            for series in ("sms", "voice"):
                q[f"{direction}_{series}_countries{suffix}"] = _single_series(
                    "location_named", "country", series, mode, desc)
    return q
