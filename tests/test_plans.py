"""Physical-plan checks: one shuffle for P1, pruned scans, top-k as
WindowGroupLimit, broadcast catalogue lookups, no Python evaluation."""

import contextlib
import io

import pytest

from conftest import SF001
from usagelens.plans import activity_snapshot, network_activity, rate_plan_trends
from usagelens.sources.testdata import load_inputs


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture(scope="module")
def inputs(spark):
    return load_inputs(spark, SF001)


def _no_python(plan):
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_activity_is_one_aggregate_over_pruned_scans(inputs):
    plan = _plan(activity_snapshot(inputs))
    _no_python(plan)
    assert plan.count("Exchange hashpartitioning(subscription_id") == 1
    assert "partial_min(duration" in plan and "partial_sum(uplink" in plan
    # the location join of the adapter is eliminated: P1 never reads customer
    assert "customer.parquet" not in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan


@pytest.mark.parametrize("product", [rate_plan_trends, network_activity])
def test_ranked_products_use_window_group_limit(inputs, product):
    plan = _plan(product(inputs))
    _no_python(plan)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_trend_overall_series_reads_only_plan_ids(inputs):
    plan = _plan(rate_plan_trends(inputs))
    assert "ReadSchema: struct<l_partkey:bigint>" in plan


def _lookup(spark, n):
    from conftest import make_inputs
    from usagelens.operators.lookups import lookup
    inp = make_inputs(spark, sms=[("1", "n", f"L{i}") for i in range(50)], locations=[(f"L{i}", "EU") for i in range(n)])
    fact = inp.sms_record.select(inp.sms_record.called_location_cd.alias("location_cd"))
    return lookup(fact, inp.location, "location_cd", "country")


@pytest.mark.parametrize("threshold,join", [("1m", "BroadcastHashJoin"), ("-1", "SortMergeJoin")])
def test_lookup_join_follows_the_measured_size(spark, threshold, join):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(keys[0], "-1")
    spark.conf.set(keys[1], threshold)
    try:
        df = _lookup(spark, 20)
        assert len(df.collect()) == 50
        assert join in _plan(df).split("== Initial Plan ==")[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_no_job_runs_while_a_plan_is_built(spark, inputs):
    spark.sparkContext.setJobGroup("plan-only", "building plans")
    try:
        for product in (activity_snapshot, rate_plan_trends, network_activity):
            product(inputs)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")) == []
        activity_snapshot(inputs).count()
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_subscribers_mode_reads_usage_once(spark, inputs):
    from usagelens.operators.counting import SUBSCRIBERS
    df = rate_plan_trends(inputs, SUBSCRIBERS)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    assert final.count("lineitem.parquet") == 1 and "ReusedExchange" in final
