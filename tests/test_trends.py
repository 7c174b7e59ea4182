"""P2 rate-plan trends: counting modes, labels, bands, first plan, ranks."""

import dataclasses

import pytest
from pyspark.errors import PySparkException

from conftest import make_inputs, rows
from usagelens.functions.cleaning import LENIENT
from usagelens.operators.counting import KEYS, RECORDS
from usagelens.plans import trends
from usagelens.schemas import TREND_COLUMNS


def _line(sub, age, middle="a,b,c,d"):
    return f"{sub},{middle},{age}"


def test_age_bands_including_zero(spark):
    ages = [0, 17, 18, 29, 30, 49, 50, 90]
    inp = make_inputs(spark, subscriber=[_line(f"s{a}", a) for a in ages])
    got = dict(rows(trends.subscriber_age_bands(inp), "age", "age_band"))
    assert got == {0: "18_less", 17: "18_less", 18: "18_30", 29: "18_30",
                   30: "30_50", 49: "30_50", 50: "50_plus", 90: "50_plus"}


def test_negative_age_strict_fails_lenient_rejects(spark):
    inp = make_inputs(spark, subscriber=[_line("a", -1), _line("b", 20)])
    with pytest.raises(PySparkException):
        trends.subscriber_age_bands(inp).collect()
    assert rows(trends.subscriber_age_bands(inp, LENIENT), "subscription_id") == [("b",)]
    assert [r.reason for r in trends.subscriber_rejects(inp).collect()] == ["negative age"]


def test_bad_csv_lines(spark):
    lines = ["subscription_id,a,b,c,d,age", _line("x", ""), "1,2,3,4", _line("ok", 40)]
    inp = make_inputs(spark, subscriber=lines)
    with pytest.raises(PySparkException):
        trends.parse_subscribers(inp).collect()
    assert rows(trends.parse_subscribers(inp, LENIENT)) == [("ok", 40)]
    assert trends.subscriber_rejects(inp).count() == 3


def test_quoted_comma_is_split_literally(spark):
    inp = make_inputs(spark, subscriber=['1,"x,y",c,d,e,42'])
    assert trends.parse_subscribers(inp, LENIENT).count() == 0
    with pytest.raises(PySparkException):
        trends.parse_subscribers(inp).collect()


def test_extra_fields_are_ignored(spark):
    inp = make_inputs(spark, subscriber=["7,a,b,c,d,33,extra"])
    assert rows(trends.parse_subscribers(inp)) == [("7", 33)]


def test_plan_ids_sharing_a_name_keys_vs_records(spark):
    usage = [("s1", "1", "1", 1, 1), ("s2", "1", "1", 1, 2), ("s3", "1", "1", 1, 3),
             ("s4", "1", "1", 2, 4)]
    inp = make_inputs(spark, volume=usage, plans=[(1, "X"), (2, "X")])
    assert rows(trends.plan_usage_counts(inp, KEYS)) == [("X", 2)]
    assert rows(trends.plan_usage_counts(inp, RECORDS)) == [("X", 4)]


def test_unknown_and_null_plan_ids_are_general_plan(spark):
    usage = [("s1", "1", "1", 8, 1), ("s2", "1", "1", 9, 2), ("s3", "1", "1", None, 3),
             ("s4", "1", "1", None, 4)]
    inp = make_inputs(spark, volume=usage, plans=[(1, "X")])
    assert rows(trends.plan_usage_counts(inp, KEYS)) == [("General Plan", 3)]
    assert rows(trends.plan_usage_counts(inp, RECORDS)) == [("General Plan", 4)]


def test_duplicate_catalogue_id_gives_one_row_and_null_name_falls_back(spark):
    usage = [("s1", "1", "1", 1, 1), ("s2", "1", "1", 4, 2)]
    inp = make_inputs(spark, volume=usage, plans=[(1, "X"), (1, "Y"), (4, None)])
    got = rows(trends.plan_name_lookup(inp))
    assert got == [(1, "X", 1), (4, "General Plan", 1)]


def test_first_plan_is_by_arrival(spark):
    usage = [("A", "1", "1", 3, 20), ("A", "1", "1", 5, 10), ("A", "1", "1", 9, 30),
             ("B", "1", "1", 7, 5), ("B", "1", "1", 2, 5)]
    inp = make_inputs(spark, volume=usage)
    assert rows(trends.first_plan_per_subscriber(inp)) == [("A", 5), ("B", 2)]


def test_subscriber_plan_needs_both_sides_and_dedupes(spark):
    usage = [("A", "1", "1", 5, 1), ("B", "1", "1", 6, 2)]
    subs = [_line("A", 20), _line("A", 21), _line("A", 60), _line("C", 40)]
    inp = make_inputs(spark, volume=usage, subscriber=subs)
    assert rows(trends.subscriber_plan(inp)) == [("18_30", 5, "A"), ("50_plus", 5, "A")]
    # one row per subscriber on either side; no usage -> plan 0
    assert rows(trends.subscriber_plan_or_zero(inp)) == [(0, "C"), (5, "A"), (6, "B")]


def test_long_ids_stay_whole_unless_cut_on_both_sides(spark):
    a, b = "subscriber-000001-a", "subscriber-000001-b"
    inp = make_inputs(spark, volume=[(a, "1", "1", 5, 1), (b, "1", "1", 6, 2)],
                      subscriber=[_line(a, 40), _line(b, 60)])
    assert rows(trends.subscriber_plan(inp)) == [("30_50", 5, a), ("50_plus", 6, b)]
    assert rows(trends.subscriber_plan(inp, truncate_ids=True)) == [("30_50", 5, a[:15]), ("50_plus", 5, a[:15])]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_plan_ids_that_are_no_integers(spark, ansi):
    from usagelens.sources.inputs import UsageInputs
    clean = make_inputs(spark, volume=[("s", "1", "1", 1, 1)])
    usage = clean.mobile_data_activity.selectExpr("subscription_id", "uplink_volume", "downlink_volume",
                                                  "explode(array('7', 'x', null)) AS rate_plan_product_id", "activity_seq")
    plans = spark.createDataFrame([("7", "Gold"), ("y", "Bad"), (None, "None")], "rate_plan_product_id string, rate_plan_name string")
    inp = UsageInputs(clean.voice_call_record, clean.sms_record, usage, clean.subscriber, plans, clean.location)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException):
            trends.plan_usage(inp).collect()
        assert rows(trends.plan_name_lookup(inp, mode=LENIENT)) == [(7, "Gold", 1), (None, "General Plan", 1)]
        assert rows(trends.plan_rejects(inp)) == [
            ("mobile_data_activity", "s", "x", "rate_plan_product_id is not an integer"),
            ("rate_plan_product", "Bad", "y", "rate_plan_product_id is not an integer")]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_ties_break_by_name_in_both_directions(spark):
    usage = [(f"s{i}", "1", "1", pid, i) for i, pid in enumerate([1, 1, 2, 2, 3, 3])]
    inp = make_inputs(spark, volume=usage, plans=[(1, "Z"), (2, "Y"), (3, "X")])
    top = rows(trends.top_plans(inp, 5, True, RECORDS))
    least = rows(trends.top_plans(inp, 5, False, RECORDS))
    assert top == least == [(1, "X"), (2, "Y"), (3, "Z")]


def test_missing_ranks_filled_with_general_plan(spark):
    # overall: 5 names; band 30_50: the only subscriber's first plan -> 1 name
    usage = [(f"s{i}", "1", "1", i, i) for i in range(1, 6)]
    inp = make_inputs(spark, volume=usage, subscriber=[_line("s1", 35)],
                      plans=[(i, f"P{i}") for i in range(1, 6)])
    out = trends.rate_plan_trends(inp, RECORDS).orderBy("rank").collect()
    assert [r["rank"] for r in out] == [1, 2, 3, 4, 5]
    assert [r.top5_plan_grouped30_50 for r in out] == ["P1"] + ["General Plan"] * 4
    assert [r.top5_plan_grouped50_plus for r in out] == ["General Plan"] * 5
    assert [r.top_five_plans_name_per_usage for r in out] == ["P1", "P2", "P3", "P4", "P5"]
    nulls = trends.rate_plan_trends(inp, RECORDS, fill=None).orderBy("rank").collect()
    assert [r.top5_plan_grouped30_50 for r in nulls] == ["P1", None, None, None, None]


def test_rank_count_invariants(spark):
    usage = [(f"s{i}", "1", "1", i % 7, i) for i in range(40)]
    subs = [_line(f"s{i}", (i * 13) % 90) for i in range(40)]
    inp = make_inputs(spark, volume=usage, subscriber=subs,
                      plans=[(i, f"P{i % 6}") for i in range(7)])
    out = trends.rate_plan_trends(inp, RECORDS)
    assert out.columns == ["rank"] + TREND_COLUMNS
    assert [r["rank"] for r in out.orderBy("rank").collect()] == [1, 2, 3, 4, 5]
    # band counts sum to the number of banded subscribers with usage
    by_band = trends.plan_by_age_counts(inp, RECORDS)
    assert by_band.groupBy().sum("n").first()[0] == trends.subscriber_plan(inp).count() == 40


def test_empty_usage_gives_no_rows(spark):
    assert trends.rate_plan_trends(make_inputs(spark)).count() == 0
    assert trends.top_plans(make_inputs(spark)).count() == 0


@pytest.mark.parametrize("kind,big", [("int", 2 ** 31 - 1), ("long", 2 ** 63 - 1)])
def test_first_by_is_exact_at_the_extremes(spark, kind, big):
    from usagelens.operators.counting import first_by
    small, first, last = -big - 1, -(2 ** 63), 2 ** 63 - 1
    data = [("a", small, 5), ("a", big, 5),            # tie on order -> smaller value
            ("b", big, first), ("b", 1, last),          # earliest order wins
            ("c", None, 3), ("c", 7, 3),                # null value sorts after a value
            ("f", None, 3),                             # ... but is still a value
            ("d", 4, None), ("d", 9, None),             # null order sorts last
            ("g", 1, None), ("g", 2, last),
            ("e", 2, None), ("h", 3, -1), ("h", 4, 0)]
    df = spark.createDataFrame(data, f"k string, v {kind}, o long")
    got = dict(rows(first_by(df, "k", "v", "o")))
    assert got == {"a": small, "b": big, "c": 7, "d": 4, "e": 2, "f": None, "g": 2, "h": 3}
    # the generic (struct-ordered) path agrees on a non-integral value
    sdf = df.selectExpr("k", "cast(v as string) AS v", "o")
    assert dict(rows(first_by(sdf, "k", "v", "o"))) == {k: None if v is None else str(v)
                                                          for k, v in got.items()}


def test_subscribers_mode_counts_distinct_subscribers_per_name(spark):
    from usagelens.operators.counting import SUBSCRIBERS
    # s1 uses plans 1 and 2 (both named X) twice each; s2 uses plan 2 once
    usage = [("s1", "1", "1", 1, 1), ("s1", "1", "1", 1, 2), ("s1", "1", "1", 2, 3),
             ("s2", "1", "1", 2, 4), ("s3", "1", "1", 9, 5)]
    inp = make_inputs(spark, volume=usage, plans=[(1, "X"), (2, "X")])
    assert rows(trends.plan_usage_counts(inp, SUBSCRIBERS)) == [("General Plan", 1), ("X", 2)]
    assert rows(trends.plan_usage_counts(inp, KEYS)) == [("General Plan", 1), ("X", 2)]
    assert rows(trends.plan_usage_counts(inp, RECORDS)) == [("General Plan", 1), ("X", 4)]


def test_subscribers_mode_equals_counts_from_records(spark):
    from usagelens.operators.counting import SUBSCRIBERS
    usage = [(f"s{i % 9}", "1", "1", i % 5, 100 - i) for i in range(60)] + [(None, "1", "1", 1, 3)]
    subs = [_line(f"s{i}", 10 * i) for i in range(9)] + [_line("s1", 70)]
    inp = make_inputs(spark, volume=usage, subscriber=subs, plans=[(i, f"P{i % 3}") for i in range(5)])
    counts = {(r.series, r.plan_name): r.n for r in trends.per_name_counts(
        trends._name_plans(trends._series_per_key(inp, "strict", False, SUBSCRIBERS), inp),
        ["series"], "plan_name", SUBSCRIBERS).collect()}
    want = {("all", r.plan_name): r.n for r in trends.plan_usage_counts(inp, SUBSCRIBERS).collect()}
    want |= {(r.age_band, r.plan_name): r.n for r in trends.plan_by_age_counts(inp, SUBSCRIBERS).collect()}
    assert counts == want


def test_quoted_fields_are_an_option(spark):
    lines = ['1,"x,y",c,d,e,42', '"2","say ""hi"", all",c,d,e, 7', '3,"open,c,d,e,5', '4,a,b,c,d," 18 "', '5,"a,b,c,d,e",6', '"6,x",b,c,d,e,9,f,"g,h"']
    inp = dataclasses.replace(make_inputs(spark, subscriber=lines), quoted_subscribers=True)
    assert rows(trends.parse_subscribers(inp, LENIENT)) == [("1", 42), ("2", 7), ("4", 18), ("6,x", 9)]
    assert [r.value for r in trends.subscriber_rejects(inp).orderBy("value").collect()] == [lines[2], lines[4]]
    plain = dataclasses.replace(inp, quoted_subscribers=False)
    assert [r.value for r in trends.subscriber_rejects(plain).orderBy("value").collect()][0] == lines[1]
