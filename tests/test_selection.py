"""First-n rows and row numbers against a sort."""

import numpy as np
import pytest

from tests.conftest import SF0001
from usagelens.operators import selection
from usagelens.operators.selection import first_rows, nth_row, numbered
from usagelens.sources import scan
from usagelens.sources.testdata import load_inputs

SCHEMA = "a long, b string, c double"


def frame(spark, kind, rows=3000):
    rng = np.random.default_rng(len(kind))
    a = {"spread": rng.integers(-10 ** 12, 10 ** 12, rows), "ties": rng.integers(0, 3, rows),
         "one value": np.zeros(rows, np.int64), "a third": np.where(rng.random(rows) < 0.34, 7, rng.integers(0, 99, rows))}[kind]
    b = rng.integers(0, 4 if kind != "one value" else 1, rows)
    data = [(None if x % 13 == 5 else int(x), None if y == 3 else f"s{y}", None if kind == "ties" and x == 1 else 0.5)
            for x, y in zip(a.tolist(), b.tolist())]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def sort_key(row):
    return [(v is not None, v) for v in row]


@pytest.mark.parametrize("kind", ["spread", "ties", "one value", "a third"])
def test_first_rows_are_those_of_a_sort(spark, kind, monkeypatch):
    df = frame(spark, kind).cache()
    want = sorted((tuple(r) for r in df.collect()), key=sort_key)
    for n in (1, 2, 700, 2999, 3000):
        row, before = nth_row(df, n, ranges=4, sample=40, few=20)
        assert row == want[n - 1] and before == want.index(row)
    monkeypatch.setattr(nth_row, "__defaults__", (4, 40, 20))
    got = sorted((tuple(r) for r in first_rows(df, 700, ["a"]).collect()), key=sort_key)
    assert got == want[:700]
    df.unpersist()


def test_ties_go_by_the_other_columns(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (0, "z"), (None, "y")], "b long, a string")
    assert sorted(map(tuple, first_rows(df, 3, ["b"]).collect()), key=str) == [(0, "z"), (1, "a"), (None, "y")]


@pytest.mark.parametrize("n,left", [(0, 0), (4, 4), (9, 4)])
def test_more_than_there_are(spark, n, left):
    df = spark.createDataFrame([(i, "x", None) for i in range(4)], SCHEMA)
    assert first_rows(df, n, ["a"]).count() == left
    assert first_rows(df.where("false"), n, ["a"]).count() == 0
    assert first_rows(df, n, ["a"]).dtypes == df.dtypes


def test_limited_scan_has_no_merge_in_one_task(spark):
    plan = scan(load_inputs(spark, SF0001), "sub_rec", limit=100)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Limit" not in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("kind", ["spread", "one value", "a third"])
def test_numbered(spark, kind):
    df = frame(spark, kind).select("a", "b").cache()
    from pyspark.sql import functions as F
    out, total = numbered(df, [F.col("a").desc_nulls_last(), F.col("b").asc_nulls_first()], "rank")
    rows = sorted(out.collect(), key=lambda r: r["rank"])
    assert total == 3000 and [r["rank"] for r in rows] == list(range(1, 3001))
    keys = [(r.a is None, -(r.a or 0), r.b is not None, r.b) for r in rows]
    assert keys == sorted(keys)
    assert sorted((tuple(r)[:2] for r in rows), key=str) == sorted(map(tuple, df.collect()), key=str)
    df.unpersist()


def test_numbered_of_nothing(spark):
    from pyspark.sql import functions as F
    out, total = numbered(spark.createDataFrame([], SCHEMA), [F.col("a")])
    assert total == 0 and out.count() == 0 and out.columns == ["a", "b", "c", "n"]
    assert selection.RANGES > 1
