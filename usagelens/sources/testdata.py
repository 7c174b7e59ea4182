"""Adapter: driver test tables (TPC-H-ish Parquet) -> the six telecom inputs.

Every input is a projection of whole tables; joins only attach a
customer's nation or an order's customer.  Nothing is filtered or capped.

| input                  | built from                 |
|------------------------|----------------------------|
| voice_call_record      | orders ⟕ customer          |
| sms_record             | events ⟕ customer          |
| mobile_data_activity   | lineitem ⟕ orders          |
| subscriber (CSV lines) | customer                   |
| rate_plan_product      | part                       |
| location               | nation ⟕ region            |

On a cluster these views would be materialised once (bucketed by
subscriber) instead of being recomputed by every product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.sources.inputs import UsageInputs


# Per-session memo of table and input DataFrames (plans, not data): a
# Parquet read infers its schema from file footers on the driver, which
# costs more than planning a query over these small test tables.
_TABLES: dict[tuple[SparkSession, str], DataFrame] = {}
_INPUTS: dict[tuple[SparkSession, str, bool], UsageInputs] = {}


def forget() -> None:
    """Empties the memos, as a new process would start."""
    _TABLES.clear()
    _INPUTS.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def _location_code(nation_key) -> F.Column:
    return F.concat(F.lit("L"), nation_key.cast("string"))


def _attribute(df: DataFrame, key: str, value: str) -> DataFrame:
    """One ``value`` per ``key``.  Being distinct on the key lets Catalyst
    drop a left join to it when a query never reads ``value`` (P1 never
    reads the location code), and the aggregate's hash partitioning is
    the one a sort-merge join on ``key`` needs, so it adds no shuffle."""
    return df.groupBy(key).agg(F.min(value).alias(value))


def voice_call_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    customer = _attribute(table(spark, sf_dir, "customer"), "c_custkey", "c_nationkey")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
            .select(F.col("o_custkey").cast("string").alias("subscription_id"),
                    F.floor(F.col("o_totalprice") / 1000).cast("long").alias("actual_duration"),
                    _location_code(F.col("c_nationkey")).alias("called_location_cd")))


def sms_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type")
    customer = _attribute(table(spark, sf_dir, "customer"), "c_custkey", "c_nationkey")
    return (events.join(customer, events.user_id == customer.c_custkey, "left")
            .select(F.col("user_id").cast("string").alias("subscription_id"),
                    F.col("event_type").alias("network_id"),
                    _location_code(F.col("c_nationkey")).alias("called_location_cd")))


def mobile_data_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    orders = _attribute(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey")
    # The first line of every order carries the one-space "no volume" text.
    uplink = F.when(F.col("l_linenumber") == 1, F.lit(" ")) \
        .otherwise(F.floor("l_quantity").cast("long").cast("string"))
    return (lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey, "left")
            .select(F.col("o_custkey").cast("string").alias("subscription_id"),
                    uplink.alias("uplink_volume"),
                    F.floor("l_extendedprice").cast("long").cast("string").alias("downlink_volume"),
                    F.col("l_partkey").cast("int").alias("rate_plan_product_id"),
                    (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("activity_seq")))


def subscriber_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six comma-separated fields per customer; field 5 is a synthetic age
    (customer key modulo 90, so 0 and every band occur)."""
    customer = table(spark, sf_dir, "customer")
    fields = [F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment"),
              F.col("c_nationkey").cast("string"), _location_code(F.col("c_nationkey")),
              (F.col("c_custkey") % 90).cast("string")]
    return customer.select(F.concat_ws(",", *fields).alias("value"))


def rate_plan_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("rate_plan_product_id"),
        F.col("p_name").alias("rate_plan_name"))


def location(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            .select(_location_code(F.col("n_nationkey")).alias("location_cd"),
                    F.col("r_name").alias("country")))


def _dirty_code(customer_key, nation_key) -> F.Column:
    """Codes ``L<nation>-<j>`` with more of them in higher nations; some are
    not in the catalogue, some are missing."""
    code = F.concat(F.lit("L"), nation_key.cast("string"), F.lit("-"), (customer_key % (nation_key + 1)).cast("string"))
    return (F.when(customer_key % 11 == 0, F.lit(None))
            .when(customer_key % 13 == 0, F.concat(F.lit("X"), nation_key.cast("string"))).otherwise(code))


def dirty_inputs(spark: SparkSession, sf_dir: str) -> UsageInputs:
    """The same whole tables with the dirt lenient mode is for: subscriber
    ids and plan ids that are no numbers, volumes that are words, lines with
    too few fields, negative ages, missing and unknown location codes, plan
    ids outside the catalogue."""
    customer = table(spark, sf_dir, "customer")
    nation_of = _attribute(customer, "c_custkey", "c_nationkey")
    text = lambda c: F.col(c).cast("string")
    orders = table(spark, sf_dir, "orders")
    voice = (orders.select("o_custkey", "o_totalprice").join(nation_of, F.col("o_custkey") == F.col("c_custkey"), "left")
             .select(F.when(F.col("o_custkey") % 97 == 0, F.concat(F.lit("C-"), text("o_custkey")))
                     .otherwise(text("o_custkey")).alias("subscription_id"),
                     F.floor(F.col("o_totalprice") / 1000).cast("long").alias("actual_duration"),
                     _dirty_code(F.col("o_custkey"), F.col("c_nationkey")).alias("called_location_cd")))
    sms = (table(spark, sf_dir, "events").select("user_id", "event_type")
           .join(nation_of, F.col("user_id") == F.col("c_custkey"), "left")
           .select(text("user_id").alias("subscription_id"), F.col("event_type").alias("network_id"),
                   _dirty_code(F.col("user_id"), F.col("c_nationkey")).alias("called_location_cd")))
    of_order = orders.groupBy("o_orderkey").agg(F.min("o_custkey").alias("o_custkey"),
                                                F.min("o_orderpriority").alias("o_orderpriority"))
    part = F.col("l_partkey")
    volume = (table(spark, sf_dir, "lineitem")
              .select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
              .join(of_order, F.col("l_orderkey") == F.col("o_orderkey"), "left")
              .select(text("o_custkey").alias("subscription_id"),
                      F.when(F.col("l_linenumber") == 1, F.lit(""))
                      .when((F.col("l_linenumber") == 2) & (F.col("o_orderpriority") == "1-URGENT"), F.col("o_orderpriority"))
                      .otherwise(F.floor("l_quantity").cast("long").cast("string")).alias("uplink_volume"),
                      F.floor("l_extendedprice").cast("long").cast("string").alias("downlink_volume"),
                      F.when(part % 50 == 0, F.concat(F.lit("P-"), part.cast("string")))
                      .when(part % 17 == 0, (part + 1_000_000).cast("string"))
                      .otherwise(part.cast("string")).alias("rate_plan_product_id"),
                      (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("activity_seq")))
    fields = [text("c_custkey"), F.col("c_name"), F.col("c_mktsegment"), text("c_nationkey"), F.lit("x"),
              F.when(F.col("c_custkey") % 19 != 0, F.floor(F.col("c_acctbal") / 100).cast("long").cast("string"))]
    places = table(spark, sf_dir, "nation").select(
        "n_regionkey", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n_nationkey").cast("long")),
                                             lambda j: F.concat(F.lit("L"), text("n_nationkey"), F.lit("-"),
                                                                j.cast("string")))).alias("location_cd"))
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return UsageInputs(
        voice_call_record=voice, sms_record=sms, mobile_data_activity=volume,
        subscriber=customer.select(F.concat_ws(",", *fields).alias("value")),
        rate_plan_product=table(spark, sf_dir, "part").select(
            text("p_partkey").alias("rate_plan_product_id"), F.col("p_name").alias("rate_plan_name")),
        location=(places.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
                  .select("location_cd", F.col("r_name").alias("country"))))


def load_inputs(spark: SparkSession, sf_dir: str, dirty: bool = False) -> UsageInputs:
    key = (spark, sf_dir.rstrip("/"), dirty)
    if key not in _INPUTS:
        _INPUTS[key] = (dirty_inputs if dirty else build_inputs)(spark, sf_dir)
    return _INPUTS[key]


def build_inputs(spark: SparkSession, sf_dir: str) -> UsageInputs:
    return UsageInputs(
        voice_call_record=voice_call_record(spark, sf_dir),
        sms_record=sms_record(spark, sf_dir),
        mobile_data_activity=mobile_data_activity(spark, sf_dir),
        subscriber=subscriber_lines(spark, sf_dir),
        rate_plan_product=rate_plan_product(spark, sf_dir),
        location=location(spark, sf_dir),
    )

