import random

import numpy as np

from tests.conftest import SF0001
from tests.llm import brute
from usagelens.llm import decontaminate


def run(spark, docs, items):
    out = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                                     spark.createDataFrame(items, "item_id long, text string"))
    return {(r.doc_id, r.item_id): (r.at, round(r.similarity, 9)) for r in out.collect()}


def expected(docs, items):
    return {k: (at, round(s, 9)) for k, (at, s) in brute.contaminated(docs, items).items()}


def test_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    items += [(900, None), (901, ""), (902, "three short words"), (903, items[0][1]), (904, "a a a a a a a a b")]
    rng = random.Random(1)
    for n in range(80):  # passages with words changed or put in
        w = rng.choice(items[:40])[1].split()
        for _ in range(rng.randrange(4)):
            w.insert(rng.randrange(len(w)), "put") if rng.random() < .5 else w.__setitem__(rng.randrange(len(w)), "new")
        docs.append((5000 + n, " ".join([f"b{i}" for i in range(rng.randrange(40))] + w + ["end"] * rng.randrange(9))))
    docs += [(6000, None), (6001, ""), (6002, "three short words"), (6003, "a " * 30 + "b"),
             (6004, " ".join(items[1][1].upper().split()) + "\n\n" + items[2][1])]
    got = run(spark, docs, items)
    assert got == expected(docs, items)
    assert len(got) > 30 and min(s for _, s in got.values()) < 0.95


def test_hot_passage_and_long_text(spark):
    item = " ".join(f"q{i}" for i in range(30))
    docs = [(i, f"doc {i} {item} tail") for i in range(400)] + [(None, item)]
    items = [(1, item), (2, item + " and more")]
    long = (9000, "w " * 200_000 + item + " z" * 100_000)
    got = run(spark, docs + [long], items)
    assert {k: v for k, v in got.items() if k[0] != 9000} == expected(docs, items)
    assert got[9000, 1] == (200_000, 1.0) and len({d for d, _ in got}) == 402


def test_documents_shorter_than_the_item(spark):
    w = [f"q{i}" for i in range(59)]
    docs = [(1, w[:56]), (2, w[3:]), (3, w[:20] + w[22:]), (4, w[:30] + ["new"] + w[33:]), (5, w[:48]), (6, w[:47]),
            (7, w[:4]), (8, w[:56] + ["and", "more", "of", "it"])]
    items = [(1, w), (2, w[:6]), (3, [])]
    got = run(spark, [(d, " ".join(x)) for d, x in docs], [(i, " ".join(x)) for i, x in items])

    def shingles(x):
        return {tuple(x[i:i + 5]) for i in range(len(x) - 4)}  # no word repeats

    want = {}
    for d, x in docs[:7]:
        a, b = shingles(x), shingles(w)
        if len(a & b) / len(a | b) >= 0.8:
            want[d] = (0, round(len(a & b) / len(a | b), 9))
    assert set(want) == {1, 2, 3, 4, 5} and want[1][1] == round(52 / 55, 9)
    assert {d: v for (d, i), v in got.items() if i == 1 and d != 8} == want and (8, 1) in got
    assert {d for d, i in got if i == 2} == {1, 3, 4, 5, 6, 8}


def test_repeated_rows(spark):
    item = " ".join(f"q{i}" for i in range(30))
    assert run(spark, [(7, "x " + item), (7, item), (7, item), (8, "no")], [(1, item)]) == {(7, 1): (0, 1.0)}


def test_no_items_and_no_documents(spark):
    assert run(spark, [(1, "some words here and there")], []) == {}
    assert run(spark, [], [(1, "some words here and there")]) == {}


def test_index_prunes_and_recall(spark):
    """Of unrelated fingerprints the index meets under 5 %; what it misses of
    similar windows the prefix finds (the other tests are exact)."""
    rng = np.random.default_rng(3)
    own, other = rng.integers(0, 2 ** 64, (2, 400), dtype=np.uint64).view(np.int64)
    items = spark.createDataFrame([(i, 20, int(x)) for i, x in enumerate(own)], "item_id long, size int, print long")
    prints = spark.createDataFrame([(20, int(x)) for x in other], "size int, print long")
    near = decontaminate.F.explode(decontaminate.F.array(*[decontaminate.F.lit(x) for x in decontaminate._NEAR]))
    index = items.select("size", decontaminate._blocks("print")).withColumn("flip", near).selectExpr(
        "size", "block", "value ^ flip AS value")
    met = prints.select("size", decontaminate._blocks("print")).join(index, ["size", "block", "value"]).count()
    assert met < 0.05 * 400 * 400
    flips = [sum(1 << int(b) for b in rng.choice(64, i % 16, replace=False)) for i in range(400)]
    close = spark.createDataFrame([(20, int(np.uint64(int(x) & (2 ** 64 - 1) ^ f).view(np.int64)))
                                   for x, f in zip(own.tolist(), flips)], "size int, print long")
    found = {r.item_id for r in decontaminate.near_prints(close, items).collect()}
    assert found == set(range(400))


def test_prefix_has_what_a_window_must_share():
    rng = np.random.default_rng(1)
    for n in (1, 2, 4, 5, 6, 9, 30, 61):
        own = rng.integers(0, 2 ** 63, n).astype(np.uint64)
        own[rng.random(n) < 0.3] = own[0]
        prefix = decontaminate._prefix(own, 0.8)
        mixed = decontaminate.wordhash.mix(own)
        assert np.isin(mixed, prefix).sum() > n - int(np.ceil(0.8 * n - 1e-9))


def test_near_blocks_cover_the_radius():
    """Fingerprints within the radius agree within REACH bits in a block."""
    rng = np.random.default_rng(0)
    near = set(decontaminate._NEAR)
    for _ in range(2000):
        bits = rng.choice(64, rng.integers(0, decontaminate.RADIUS + 1), replace=False)
        x = sum(1 << int(b) for b in bits)
        assert any((x >> 16 * b) & 65535 in near for b in range(4))
