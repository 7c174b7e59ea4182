import random
from fractions import Fraction

import pytest

from tests.llm import brute
from tests.conftest import SF0001
from usagelens.llm.minhash_dedup import halves_for, near_duplicates


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def edits(text, n, rng, most):
    """Copies of a text with up to ``most`` words changed, put in or left out."""
    for _ in range(n):
        w = text.split(" ")
        for _ in range(rng.randrange(most)):
            p = rng.randrange(len(w))
            kind = rng.random()
            w[p:p + 1] = [f"w{rng.randrange(10 ** 6)}"] if kind < .5 else [] if kind < .7 else [w[p], "more"]
        yield " ".join(w)


@pytest.mark.parametrize("k,threshold", [(3, Fraction(85, 100)), (5, Fraction(8, 10))])
def test_against_brute_force(spark, k, threshold):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rng = random.Random(3)
    base = " ".join(f"v{i}" for i in range(150))
    # one large group of edits, some of them near each other only through others
    rows += [(10_000 + i, t) for i, t in enumerate(edits(base, 250, rng, 9))]
    rows += [(20_000, base), (20_001, base.upper()), (20_002, " ".join(base.split()[40:])), (20_003, base + " x y z")]
    rows += [(30_000, None), (30_001, ""), (30_002, " \n\t"), (30_003, "one two"), (30_004, "ONE  two"),
             (30_005, "two one"), (30_006, "word")]
    got = result(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), k, threshold))
    assert got == brute.near_duplicates(rows, k, threshold.numerator, threshold.denominator)
    assert got[30_000] == (0, 30_000) and got[30_004] == (1, 30_003)


def test_large_group_of_edits(spark):
    rng = random.Random(11)
    base = " ".join(f"u{i}" for i in range(60))
    rows = list(enumerate(edits(base, 700, rng, 7)))
    got = result(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute.near_duplicates(rows, 3, 85, 100)


def test_long_text_and_extra_columns(spark):
    long = " ".join(f"w{i % 70_000}" for i in range(300_000))
    rows = [(1, long, True, 5), (2, long + " end", False, 6), (3, "x" * 3_000_000, True, 7), (4, "short one here", True, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept boolean, component_id int")
    assert {d: c for d, (_, c) in result(near_duplicates(df)).items()} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_repeated_and_unnamed_rows(spark):
    same, other = " ".join("abcdefghij"), " ".join("qrstuvwxyz")
    rows = [(5, same), (5, same), (None, same), (7, same), (7, other), (9, other), (None, None)]
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    assert {r.component_id for r in out if r.doc_id is not None} == {5}  # 7 has both texts
    assert all(r.component_id is None and r.kept for r in out if r.doc_id is None)
    assert sorted(r.kept for r in out if r.doc_id is not None) == [False, False, False, True, True]


def test_pivot_that_met_nobody(spark):
    """9 and 12 meet 7 in the only table and are linked with each other alone; 7 is one document with 3, which meets nobody."""
    rows = []
    for n in range(0, 200, 20):
        w = [f"g{n}w{i}" for i in range(400)]
        near = [f"g{n}x{i}" for i in range(40)] + w[40:]
        alone = " ".join(f"g{n}y{i}" for i in range(60))
        rows += [(n + 3, alone), (n + 7, alone), (n + 7, " ".join(w)), (n + 9, " ".join(near)),
                 (n + 12, " ".join([*near[:-1], "last"]))]
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), rows=1, halves=1).collect()
    assert {r.doc_id: r.component_id for r in out} == {
        n + d: n + c for n in range(0, 200, 20) for d, c in ((3, 3), (7, 3), (9, 9), (12, 9))}


def test_no_rows(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_miss_bound():
    for t in (0.8, 0.85):
        assert 2 * (1 - t ** 3) ** halves_for(t) <= 1e-4
