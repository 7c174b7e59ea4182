"""Lists of bounded length, first values by arrivals of other types, salted lookups."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, make_inputs, rows
from usagelens.operators.counting import SUBSCRIBERS, TEXT_HEAD, TEXT_TAIL, first_by
from usagelens.operators.lists import chunked_lists
from usagelens.operators.lookups import lookup, salted_lookup
from usagelens.plans import network, trends
from usagelens.sources.testdata import load_inputs


def _lists(pairs, size):
    want = {}
    for key, value in pairs:
        want.setdefault(key, []).append(value)
    return {(k, at // size): sorted(v, key=lambda x: (x is not None, x))[at:at + size]
            for k, v in want.items() for at in range(0, len(v), size)}


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_hot_key_spans_lists(spark, size):
    rng = random.Random(size)
    pairs = [(rng.choice([1, 1, 1, 1, 2, 3, None, rng.randrange(50)]), rng.choice([None, "a", "b", str(rng.random())]))
             for _ in range(4000)]
    df = spark.createDataFrame(pairs, "plan int, sub string").repartition(6)
    got = chunked_lists(df, "plan", "sub", size).collect()
    assert {(r.plan, r.chunk): r["values"] for r in got} == _lists(pairs, size)
    assert max(len(r["values"]) for r in got) <= size and len(got) == len(_lists(pairs, size))


def test_a_hot_key_is_numbered_in_several_tasks(spark):
    from usagelens.operators.selection import numbered
    df = spark.range(20_000).select(F.lit(7).alias("plan"), (F.col("id") % 3).alias("sub"))
    path_counts = []
    import usagelens.operators.selection as selection
    real = selection.stored

    def seen(frame, name):
        out = real(frame, name)
        if name == "numbered":
            path_counts.append(out.withColumn("f", F.input_file_name()).groupBy("f").count().agg(F.max("count")).first()[0])
        return out

    selection.stored = seen
    try:
        with_conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
        for k, v in with_conf.items():
            spark.conf.set(k, v)
        out, total = numbered(df, [F.col("sub").asc()], "n", within=["plan"])
    finally:
        selection.stored = real
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert total == 20_000 and path_counts[0] < 5_000  # of eight ranges
    assert out.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (1, 20_000, 20_000)


def test_lists_of_nothing_and_bad_sizes(spark):
    df = spark.createDataFrame([], "plan int, sub string")
    assert chunked_lists(df, "plan", "sub").collect() == []
    with pytest.raises(ValueError):
        chunked_lists(df, "plan", "sub", 0)


def test_plan_subscriber_lists(spark):
    inp = make_inputs(spark, volume=[(s, "1", "1", p, i) for i, (s, p) in enumerate(
        [("b", 1), ("a", 1), ("a", 1), ("c", 2), ("a", 1), (None, 1)])])
    got = trends.plan_subscriber_lists(inp, 2).collect()
    assert sorted((r.rate_plan_product_id, r.chunk, r.subscribers) for r in got) == [
        (1, 0, [None, "a"]), (1, 1, ["a", "a"]), (1, 2, ["b"]), (2, 0, ["c"])]


# ---------------------------------------------------------------- arrivals (A10)
def _first(data):
    out = {}
    for key, order, value in data:
        rank = (order is None, order if order is not None else 0, value is None, value if value is not None else 0)
        out[key] = min(out.get(key, (rank, value)), (rank, value), key=lambda x: x[0])
    return sorted(((k, v[1]) for k, v in out.items()), key=str)


def _text(rng):
    stem = rng.choice(["", "a", "a\0", "ab", "é", "2024-01-01 00:00:00", "2024-01-01 00:00:00.123456", "\U0001F600" * 3, "z" * 15])
    return rng.choice([None, stem, stem + rng.choice("0\x00aé"), stem[:rng.randrange(len(stem) + 1)]])


def test_text_arrivals(spark):
    rng = random.Random(2)
    data = [(rng.choice(["s1", "s1", "s2", None, f"s{rng.randrange(60)}"]), _text(rng),
             rng.choice([None, rng.randrange(-5, 5), 2 ** 31 - 1, -2 ** 31])) for _ in range(3000)]
    data = [(k, t if t is None or len(t.encode()) <= TEXT_HEAD + TEXT_TAIL else t[:6], v) for k, t, v in data]
    got = first_by(spark.createDataFrame(data, "k string, t string, v int"), "k", "v", "t")
    assert sorted(map(tuple, got.collect()), key=str) == _first(
        [(k, None if t is None else t.encode(), v) for k, t, v in data])


def test_long_text_arrivals_fail_loudly(spark):
    df = spark.createDataFrame([("a", "x" * 27, 1)], "k string, t string, v int")
    with pytest.raises(Exception, match="longer than 26 bytes"):
        first_by(df, "k", "v", "t").collect()


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_time_arrivals(spark, kind):
    rng = random.Random(3)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        data = []
        for _ in range(800):
            t = datetime.datetime(rng.choice([1583, 1969, 2024]), rng.choice([3, 10]), rng.randrange(25, 32), rng.randrange(24),
                                  rng.randrange(60), rng.randrange(60), rng.randrange(3))
            data.append((rng.randrange(40), rng.choice([None, t.date() if kind == "date" else t]), rng.choice([None, 1, 2])))
        text = [(k, None if t is None else str(t), v) for k, t, v in data]
        df = spark.createDataFrame(text, "k int, t string, v int").withColumn("t", F.col("t").cast(kind))
        got = first_by(df, "k", "v", "t")
        # by the type's own order, which the general form follows
        ordering = F.struct(F.col("t").isNull(), F.col("t"), F.col("v").isNull(), F.col("v"))
        want = df.groupBy("k").agg(F.min_by("v", ordering).alias("v"))
        assert rows(got) == rows(want)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("kind", ["string", "timestamp", "timestamp_ntz", "date", "bigint"])
def test_no_sort_aggregate(spark, kind):
    df = spark.range(10).select(F.col("id").alias("k"), F.lit(None).cast(kind).alias("t"), F.lit(1).alias("v"))
    plan = first_by(df, "k", "v", "t")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


# ---------------------------------------------------------------- hot plans in subscribers mode (N2, N5)
def test_salted_lookup_is_a_lookup(spark):
    fact = spark.createDataFrame([(i % 7 if i % 5 else None, f"s{i}") for i in range(200)], "id int, sub string")
    names = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (3, "c"), (None, "x"), (99, "y")], "id int, name string")
    want = lookup(fact, names, "id", "name").select("id", "sub", "name")
    for salts in (1, 3):
        assert rows(salted_lookup(fact, names, "id", "name", "sub", salts).select("id", "sub", "name")) == rows(want)


@pytest.mark.parametrize("build,key", [(lambda i: trends.plan_usage_counts(i, SUBSCRIBERS), "rate_plan_product_id"),
                                       (lambda i: trends.rate_plan_trends(i, SUBSCRIBERS), "rate_plan_product_id"),
                                       (lambda i: network.country_counts(i, network.SMS, SUBSCRIBERS), "location_cd")])
def test_no_row_per_subscriber_is_dealt_by_the_plan_alone(spark, build, key):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = build(load_inputs(spark, SF0001))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    lines = plan.splitlines()
    dealt = [i for i, line in enumerate(lines) if re.search(rf"hashpartitioning\({key}#\d+, \d+\)", line)]
    # alone, the key deals out nothing; facts and catalogue go by key and salt, facts before that by key and subscriber
    assert not dealt
    assert re.search(rf"hashpartitioning\({key}#\d+, lookup_salt#\d+", plan)
