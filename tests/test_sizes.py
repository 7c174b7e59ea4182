"""What a plan holds in memory or moves does not grow with the tables."""

import contextlib
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, make_inputs, rows
from usagelens.operators.counting import SUBSCRIBERS
from usagelens.operators.lookups import lookup, salted_lookup
from usagelens.operators.selection import first_rows
from usagelens.plans import activity, trends
from usagelens.plans.rejects import rejects
from usagelens.sources.testdata import load_inputs


@contextlib.contextmanager
def conf(spark, settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- salted lookups
BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "256k", "spark.sql.adaptive.autoBroadcastJoinThreshold": "256k"}


def test_copies_of_a_catalogue_are_not_broadcast_for_the_size_of_one(spark, scratch_dir):
    path = os.path.join(scratch_dir, "names")
    spark.range(20_000).selectExpr("cast(id as int) as id", "concat('plan ', id % 64) as name").coalesce(1).write.parquet(path)
    names = spark.read.parquet(path)
    fact = spark.range(500).selectExpr("cast(id * 41 as int) as id", "cast(id as string) as sub")
    with conf(spark, BROADCAST):
        dealt = salted_lookup(fact, names, "id", "name", "sub")
        assert "BroadcastHashJoin" in plan_of(lookup(fact, names, "id", "name"))
        assert "BroadcastHashJoin" not in plan_of(dealt)
        assert rows(dealt, "id", "sub", "name") == rows(lookup(fact, names, "id", "name"), "id", "sub", "name")
        assert "BroadcastHashJoin" not in plan_of(dealt)


def test_the_task_that_copies_a_catalogue_sorts_no_copies(spark):
    inputs = make_inputs(spark, plans=[(1, "a")], volume=[("s", "1", "1", 1, 1)])
    with conf(spark, {k: "-1" for k in BROADCAST}):
        plan = plan_of(trends.plan_usage_counts(inputs, SUBSCRIBERS)).splitlines()
    copied = next(i for i, line in enumerate(plan) if "CartesianProduct" in line)
    above = [i for i, line in enumerate(plan[:copied]) if "Exchange" in line][-1]
    assert not any("Sort" in line for line in plan[above:copied])


# ---------------------------------------------------------------- first rows
def test_first_rows_join_only_what_the_first_column_leaves(spark, scratch_dir, monkeypatch):
    """Usage whose subscriber comes from a join: no pass over the first column joins, and the
    joins that are left get only the usage up to the n-th row."""
    path = os.path.join(scratch_dir, "usage")
    spark.range(30_000).selectExpr("id * 7 as seq", "id % 500 as owner").write.parquet(path)
    usage = spark.read.parquet(path)
    owners = spark.range(500).selectExpr("id as o", "concat('s', id) as sub").groupBy("o").agg(F.min("sub").alias("sub"))
    joined = usage.join(owners, usage.owner == owners.o, "left").select("seq", "sub")
    kind, plans = type(joined), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: plans.append(plan_of(df)) or collect(df))
    first = first_rows(joined, 9_000, ["seq"])
    assert any("Sample" in p for p in plans)
    for p in [*plans, plan_of(first)]:
        if "Join" in p:
            scan = next(line for line in p.splitlines() if "FileScan parquet [seq" in line)
            assert re.search(r"DataFilters: \[[^\]]*seq#\d+L? (<=>|<=) \d+", scan), scan
    want = [(i * 7, f"s{i % 500}") for i in range(9_000)]
    assert sorted(map(tuple, collect(first))) == want


# ---------------------------------------------------------------- rejects
def test_rejects_read_usage_once(spark):
    inputs = load_inputs(spark, SF0001, dirty=True)
    found = rejects(inputs)
    assert plan_of(found).count("lineitem.parquet") == 1
    usage = found.where("source = 'mobile_data_activity'")
    of_activity = activity.activity_rejects(inputs).where("source = 'mobile_data_activity'")
    of_trends = trends.plan_rejects(inputs).where("source = 'mobile_data_activity'")
    assert rows(usage.where("product = 'activity'"), "key", "value", "reason") == rows(
        of_activity, "subscription_id", "value", "reason") != []
    assert rows(usage.where("product = 'trends'"), "key", "value", "reason") == rows(of_trends, "key", "value", "reason") != []
