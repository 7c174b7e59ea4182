"""What lenient mode leaves out of the products, one row a record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.plans.activity import SOURCES, activity_rejects, reject
from usagelens.plans.network import SERIES_DATASETS, location_rejects
from usagelens.plans.trends import PLAN_SOURCES, plan_reject, plan_rejects, subscriber_rejects
from usagelens.schemas import REJECTS
from usagelens.sources import UsageInputs

SERIES_SOURCES = dict(zip(SERIES_DATASETS, ("sms_record", "voice_call_record")))


#: Read by two products: read once, as what makes it may be a large join.
USAGE = "mobile_data_activity"


def usage_rejects(inputs: UsageInputs) -> DataFrame:
    """(product, source, key, value, reason) of usage records, which the
    products judge in one pass."""
    of = lambda product, row, key: F.when(row.isNotNull(), F.struct(
        F.lit(product).alias("product"), row["source"].alias("source"), row[key].alias("key"),
        row["value"].alias("value"), row["reason"].alias("reason")))
    own, plan = reject(USAGE), plan_reject(USAGE)
    both = F.array(of("activity", own, "subscription_id"), of("trends", plan, "key"))
    return (getattr(inputs, USAGE).where(own.isNotNull() | plan.isNotNull())  # most rows are neither, and get no array
            .select(F.explode(F.array_compact(both)).alias("reject")).select("reject.*"))


def rejects(inputs: UsageInputs) -> DataFrame:
    """(product, source, key, value, reason).  A record that several
    products read is rejected by each on its own grounds."""
    none = F.lit(None).cast("string")
    of = lambda product: F.lit(product).alias("product")
    others = lambda sources: [s for s in sources if s != USAGE]
    series = F.create_map(*[F.lit(x) for pair in SERIES_SOURCES.items() for x in pair])
    parts = [
        usage_rejects(inputs),
        activity_rejects(inputs, others(SOURCES)).select(
            of("activity"), "source", F.col("subscription_id").alias("key"), "value", "reason"),
        plan_rejects(inputs, others(PLAN_SOURCES)).select(of("trends"), "source", "key", "value", "reason"),
        subscriber_rejects(inputs).select(of("trends"), F.lit("subscriber").alias("source"), none.alias("key"),
                                          "value", "reason"),
        location_rejects(inputs).select(of("network"), series[F.col("series")].alias("source"),
                                        F.col("subscription_id").alias("key"), none.alias("value"), "reason"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.to(REJECTS)
