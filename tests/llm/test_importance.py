"""Importance resampling against counting every run of words one by one."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.brute import LOWER
from usagelens.llm import importance, queries

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target):
    """Sorted rows (doc_id, n_features, weight, score, rank)."""
    own = [runs(t) for _, t in docs]
    s, t = Counter(b for _, f in own for b in f), Counter(b for x in target for b in runs(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    out = []
    for (doc, _), (w, f) in zip(docs, own):
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    long = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(long[:5 * len(long) // 100], 1):
        r[4] = i
    return sorted((tuple(r[:5]) for r in out), key=str)


def run(spark, docs, target):
    rows = importance.resample(spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame([(x,) for x in target], "text string"))
    return sorted((tuple(r) for r in rows.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def corpus():
    rng = np.random.default_rng(11)
    vocabulary = ["w%d" % i for i in range(300)] + ["Über", "日本語", "x" * 41, "é" * 60, "q" * 400, "A", "0", "ÀB"]
    gaps = [" ", " ", " ", "\n", "\n\n", "-", "\t", " \n ", "\r\n", "\x7f", "."]
    docs = []
    for i in range(300):
        n = int(rng.choice([0, 1, 2, 3, 5, 19, 20, 21, 80]))
        docs.append((i, "".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(n))))
    line = "the very same line of words that many documents repeat\n"
    docs += [(1000 + i, line * (1 + i % 4) + docs[i][1] + "\n" + line) for i in range(300)]
    docs += [(2000, None), (2001, ""), (2002, "\n\n\n"), (None, line * 3), (2003, "a\nb\nc\nd e\nf"),
             (2004, "\n".join("abcdefghijklmnopqrstuvwxyz")), (2005, line * 20_000), (2006, "z" * 300_000 + " " + line * 3),
             (2007, "one two three four five\nsix seven eight nine ten eleven\n" * 3)]
    return docs, [line, "w1 w2 w3\nw4 w5", None, "", "日本語 Über q"]


def test_against_brute_force(spark):
    docs, target = corpus()
    got = run(spark, docs, target)
    assert got == brute(docs, target)
    assert sum(r[4] is not None for r in got) == 5 * sum(len(runs(t)[0]) >= 20 for _, t in docs) // 100 > 5


def test_repeated_rows_and_ties(spark):
    docs = [(1, "a b " * 20)] * 50 + [(2, "a b " * 20)] * 50 + [(None, "a b " * 20)] * 20
    assert run(spark, docs, ["a"]) == brute(docs, ["a"])


@pytest.mark.parametrize("docs,target", [([], []), ([], ["a"]), ([(1, "a b")], []), ([(1, None)], [None])])
def test_empty_tables(spark, docs, target):
    assert run(spark, docs, target) == brute(docs, target)


def test_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = queries.op11_importance(spark, sf)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, target)


def test_other_columns_may_clash(spark):
    docs = spark.createDataFrame([(1, "a b " * 30, 7, 8, "x")], "doc_id long, text string, rank int, weight int, line string")
    assert importance.resample(docs, docs).count() == 1


def test_lines_are_hashed_once():
    block = importance.Segments(pa.array(["a b\na b\nc", "a b", ""]))
    assert sorted(block.lines.to_pylist()) == ["", "a b", "c"]
    assert len(block.words.crc) == 3
