"""P1 activity snapshot: defaults, volume cleaning, null and bad ids."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import make_inputs, rows
from usagelens.functions.cleaning import LENIENT, clean_volume, volume_is_bad
from usagelens.plans.activity import activity_rejects, activity_snapshot, sms_count
from usagelens.schemas import ACTIVITY_COLUMNS


def _by_id(df):
    return {r["subscription_id"]: r.asDict() for r in df.collect()}


def test_sms_counted_and_missing_facts_default_to_zero(spark):
    inp = make_inputs(spark,
                      voice=[("1", 30, "L1"), ("1", 5, "L1"), ("2", 7, "L2")],
                      sms=[("1", "n1", "L1"), ("1", None, "L1")],
                      volume=[("3", "4", "6", 1, 1)])
    out = _by_id(activity_snapshot(inp))
    assert out[1] == dict(subscription_id=1, shortest_call=5, longest_call=30, total_sms_sent=2,
                          total_uplink_vol=0, total_downlink_vol=0)
    assert out[2]["total_sms_sent"] == 0 and out[2]["shortest_call"] == 7
    assert out[3] == dict(subscription_id=3, shortest_call=0, longest_call=0, total_sms_sent=0,
                          total_uplink_vol=4, total_downlink_vol=6)
    assert rows(sms_count(inp)) == [("1", 2)]


def test_volume_text_one_space_is_zero_and_spaces_are_trimmed(spark):
    inp = make_inputs(spark, volume=[("1", " ", "12", 1, 1), ("1", "12", " 12 ", 1, 2)])
    out = _by_id(activity_snapshot(inp))
    assert out[1]["total_uplink_vol"] == 12 and out[1]["total_downlink_vol"] == 24


@pytest.mark.parametrize("bad", ["", "  ", None, "1_000", "abc"])
def test_strict_mode_fails_on_bad_volume(spark, bad):
    inp = make_inputs(spark, volume=[("1", bad, "1", 1, 1)])
    with pytest.raises(PySparkException):
        activity_snapshot(inp).collect()


def test_lenient_mode_blank_is_zero_and_unparsable_is_rejected(spark):
    inp = make_inputs(spark, volume=[("1", "", "1", 1, 1), ("1", "  ", "2", 1, 2),
                                     ("1", None, "3", 1, 3), ("2", "1_000", "5", 1, 4)])
    out = _by_id(activity_snapshot(inp, LENIENT))
    assert out[1]["total_uplink_vol"] == 0 and out[1]["total_downlink_vol"] == 6
    assert 2 not in out
    rej = activity_rejects(inp).collect()
    assert [(r.subscription_id, r.value) for r in rej] == [("2", "1_000|5")]


def test_clean_volume_expressions(spark):
    df = spark.createDataFrame([(" ",), ("12",), (" 12 ",), ("",), (None,), ("1_000",)], "v string")
    got = [tuple(r) for r in df.select(clean_volume("v", LENIENT), volume_is_bad("v")).collect()]
    assert got == [(0, False), (12, False), (12, False), (0, False), (0, False), (None, True)]


def test_null_subscriber_in_two_facts_is_one_row(spark):
    inp = make_inputs(spark, voice=[(None, 3, "L1")], sms=[(None, "n", "L1")],
                      volume=[(None, "2", "2", 1, 1)])
    out = activity_snapshot(inp).collect()
    assert len(out) == 1
    assert out[0].asDict() == dict(subscription_id=None, shortest_call=3, longest_call=3,
                                   total_sms_sent=1, total_uplink_vol=2, total_downlink_vol=2)


def test_non_numeric_subscriber(spark):
    inp = make_inputs(spark, voice=[("abc", 3, "L1"), ("7", 1, "L1")])
    with pytest.raises(PySparkException):
        activity_snapshot(inp).collect()
    assert rows(activity_snapshot(inp, LENIENT), "subscription_id") == [(7,)]
    assert [r.value for r in activity_rejects(inp).collect()] == ["abc"]


def test_one_row_per_numeric_id(spark):
    inp = make_inputs(spark, voice=[("7", 3, "L1"), ("07", 9, "L1")], sms=[(" 7", "n", "L1")])
    out = activity_snapshot(inp).collect()
    assert [(r.subscription_id, r.shortest_call, r.longest_call, r.total_sms_sent) for r in out] == [(7, 3, 9, 1)]


def test_rows_in_are_rows_used_and_rejects(spark):
    inp = make_inputs(spark, voice=[("1", 3, "L1"), ("x", 1, "L1"), (None, 2, "L1")], sms=[("y", "n", "L1")],
                      volume=[("1", "2", "3", 1, 1), ("1", "bad", "3", 1, 2), ("z", "1", "1", 1, 3), ("z", "bad", "1", 1, 4)])
    bad = {s: [r for r in activity_rejects(inp).collect() if r.source == s]
           for s in ("voice_call_record", "sms_record", "mobile_data_activity")}
    assert [len(v) for v in bad.values()] == [1, 1, 3]
    from usagelens.plans.activity import _with_id, clean_volumes
    from usagelens.sources import scan
    used = (_with_id(scan(inp, "voice_call"), LENIENT).count(), _with_id(scan(inp, "sms_rec"), LENIENT).count(),
            _with_id(clean_volumes(inp, LENIENT), LENIENT).count())
    assert used == (3 - 1, 1 - 1, 4 - 3)


def test_output_schema_and_row_count_invariant(spark):
    inp = make_inputs(spark, voice=[("1", 1, "L"), ("2", 2, "L")], sms=[("2", "n", "L"), ("4", "n", "L")],
                      volume=[("3", "1", "1", 1, 1), ("1", "1", "1", 1, 2)])
    out = activity_snapshot(inp)
    assert out.columns == ACTIVITY_COLUMNS
    assert all(f.dataType.typeName() == "long" for f in out.schema.fields)
    ids = (inp.voice_call_record.select("subscription_id")
           .union(inp.sms_record.select("subscription_id"))
           .union(inp.mobile_data_activity.select("subscription_id")).distinct().count())
    assert out.count() == ids == 4
    # sums survive the union: total SMS equals the number of SMS records
    assert out.agg(F.sum("total_sms_sent")).first()[0] == inp.sms_record.count()


def test_empty_inputs_give_no_rows(spark):
    assert activity_snapshot(make_inputs(spark)).count() == 0
