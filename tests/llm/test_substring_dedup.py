"""Repeated passages against a dictionary of every window."""

import hashlib

import numpy as np
import pytest

from tests.llm.brute import WORD
from usagelens.llm import queries, substring_dedup
from usagelens.llm.substring_dedup import remove_repeats

SCHEMA = "doc_id long, text string"


def brute(docs, size):
    """Rows (doc_id, n_words, n_removed, kept words)."""
    own = [(d, WORD.findall(t or "")) for d, t in docs]
    first = {}
    for d, w in own:
        if d is not None:
            for i in range(len(w) - size + 1):
                key = tuple(w[i:i + size])
                first[key] = min(d, first.get(key, d))
    out = []
    for d, w in own:
        gone = set()
        for i in range(len(w) - size + 1):
            if d is not None and first[tuple(w[i:i + size])] < d:
                gone.update(range(i, i + size))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def run(spark, docs, size, schema=SCHEMA):
    rows = remove_repeats(spark.createDataFrame(docs, schema), size).collect()
    texts = {}
    out = []
    for d, t, *_ in docs:
        texts.setdefault(d, []).append(" ".join(WORD.findall(t or "")))
    for r in rows:
        kept = r.kept
        if kept is None:
            assert r.n_removed == 0 and r.removed == []
            kept = next(t for t in texts[r.doc_id] if hashlib.sha256(t.encode()).hexdigest() == r.words_sha256)
        assert sum(s["words"] for s in r.removed) == r.n_removed
        out.append((r.doc_id, r.n_words, r.n_removed, kept))
    return sorted(out, key=str)


def corpus(size):
    rng = np.random.default_rng(size)
    new = lambda n: ["v%d" % x for x in rng.integers(0, 10 ** 9, n)]
    join = lambda *parts: rng.choice([" ", "\n", "\t "]).join(w for p in parts for w in p)
    passages = [new(n) for n in (size - 1, size, size + 1, 2 * size - 1, 2 * size, 2 * size + 3, 5 * size, 9 * size)]
    docs = []
    for i in range(150):
        parts = []
        for _ in range(int(rng.integers(0, 4))):
            p = passages[int(rng.integers(0, len(passages)))]
            a, b = sorted(rng.integers(0, len(p) + 1, 2))
            parts += [new(int(rng.integers(0, 8))), p if rng.random() < 0.6 else p[a:b], new(int(rng.integers(0, 3)))]
        docs.append((int(rng.permutation(10_000)[0]) * 200 + i, join(*parts)))
    base = new(6 * size)
    for i in range(40):  # near copies of one text, and exact ones
        own = list(base)
        for _ in range(i % 4):
            own[int(rng.integers(0, len(own)))] = new(1)[0]
        docs.append((5_000_000 - i, join(own)))
    docs += [(6_000_000 + i, docs[0][1]) for i in range(30)]
    docs += [(7, None), (8, ""), (9, " \n"), (None, join(base)), (None, join(base)), (10, "Aa " * (3 * size)),
             (11, "Aa " * (2 * size)), (12, "aa " * (2 * size)), (13, "Aa " * (size - 1)), (14, "x " * (9 * size) + "y"),
             (15, "x " * (4 * size) + "z " + "x " * (size - 1)), (4_999_999, join(passages[6]))]
    docs += [(16, join(base, new(4)))] * 20 + [(16, join(new(3), base))] * 3
    return docs


@pytest.mark.parametrize("size", [4, 7, 50])
def test_against_brute_force(spark, size):
    docs = corpus(size)
    got = run(spark, docs, size)
    assert got == brute(docs, size)
    assert sum(r[2] > 0 for r in got) > 60


def test_long_text_and_hot_passage(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(i, f"a{i} b{i} {passage} c{i}") for i in range(400)]
    docs += [(1000, " ".join(f"n{i}" for i in range(100_000)) + " " + passage), (1001, "w " * 100_000),
             (1002, "u" * 500_000 + " " + passage)]
    assert run(spark, docs, 50) == brute(docs, 50)


@pytest.mark.parametrize("docs", [[], [(1, None)], [(1, "a " * 60)], [(1, "a " * 60), (1, "a " * 60)],
                                  [(None, "a " * 60), (1, "a " * 60), (None, "a " * 60)]])
def test_little(spark, docs):
    assert run(spark, docs, 50) == brute(docs, 50)


def test_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_substring_dedup(spark, sf)
    assert got.dtypes == [("doc_id", "bigint"), ("n_words", "bigint"), ("n_removed", "bigint"), ("kept_sha256", "string")]
    want = [(d, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, n, gone, kept in brute(docs, 50)]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    assert sum(r[2] for r in want) > 0


def test_other_columns_may_clash(spark):
    schema = SCHEMA + ", t1 string, start int, runs string, first_id long"
    docs = [(i, "a b c d e f g h", "x", 1, "y", 3) for i in range(3)]
    assert [r[2] for r in run(spark, docs, 4, schema)] == [0, 8, 8]


def test_levels_go_on_until_none_repeats(spark, monkeypatch):
    lengths = []
    real = substring_dedup._repeated

    def seen(rows, keys, name):
        lengths.append(name)
        return real(rows, keys, name)

    monkeypatch.setattr(substring_dedup, "_repeated", seen)
    text = " ".join(f"w{i}" for i in range(40))
    docs = [(1, text), (2, text + " end")]
    assert run(spark, docs, 4) == brute(docs, 4)
    assert lengths.count("level") >= 4  # 4, 8, 16, 32 words and the level where none is left
