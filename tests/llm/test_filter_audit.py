"""Filter audit against running every order over the documents."""

from itertools import permutations

import numpy as np
import pytest

from tests.llm.brute import WORD
from usagelens.llm import filter_audit

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    def fails(i):
        doc, text = docs[i][0], docs[i][1] or ""
        w = WORD.findall(text)
        return {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
                "D": any(c in "#$%&*|" for c in text),
                "E": doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _ in docs)}

    own = [fails(i) for i in range(len(docs))]
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    for part in {lang or "" for *_, lang in docs}:
        ids = [i for i, d in enumerate(docs) if (d[2] or "") == part]
        for order in permutations("ABCDE"):
            left = list(ids)
            for step, f in enumerate(order, 1):
                gone = [i for i in left if own[i][f]]
                left = [i for i in left if not own[i][f]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(own[i][f] for i in ids) - len(gone),
                    sum(own[i][f] and sum(own[i].values()) == 1 for i in ids),
                    sum(docs[i][0] in good for i in gone), sum(docs[i][0] in toxic for i in gone)]
    for (part, order, step), row in list(out.items()):
        f = order[step - 1]
        row.append(sum(r[1] for (p, o, s), r in out.items() if p == part and o[s - 1] == f and len(r) >= 6))
    return out


def run(spark, docs, labels):
    rows = filter_audit.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    got = {(r.part, r.filter_order, r.step): list(r[3:]) for r in rows}
    assert len(got) == len(rows)
    return got


def corpus():
    rng = np.random.default_rng(5)
    base = ["w%d " % i for i in range(400)]
    docs = []
    for i in range(120):
        n = int(rng.choice([0, 3, 150, 199, 200, 260]))
        words = rng.choice(base[:int(rng.choice([50, 400]))], n)
        text = "".join(words) + rng.choice(["", "A" * 60, "#", "\t| x", "Ä€"])
        docs.append((int(rng.integers(0, 90)), text, rng.choice(["en", "de", "fr"])))
    docs += [(1000 + i, docs[i % 7][1], "en") for i in range(60)]
    docs += [(None, docs[0][1], "en"), (None, None, None), (None, None, None), (7, None, ""), (8, "", "en"),
             (2000, "same", "en"), (2000, "same", "en"), (2001, "same", None), (3000, "word " * 100_000, "de"),
             (3001, "\x0b \x0c\x85 \xa0", "de")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 90, 2)]
    labels = [(d, q, int(t)) for d, q, t in labels] + [(None, 1, 1), (4, 1, None), (4, None, 1), (2001, 1, 1), (5000, 1, 1)]
    return docs, labels


def test_against_brute_force(spark):
    docs, labels = corpus()
    got = run(spark, docs, labels)
    assert got == brute(docs, labels)
    assert len(got) == 4 * 600


def test_empty_tables_and_no_labels(spark):
    assert run(spark, [], []) == {}
    docs = [(1, "x", "en")]
    assert run(spark, docs, []) == brute(docs, [])


def test_other_columns_may_clash(spark):
    docs = spark.createDataFrame([(1, "x", "en", 1, "a", 5), (2, "x", "en", 1, "b", 6)],
                                 DOCS + ", fails int, part string, good int")
    labels = spark.createDataFrame([(2, 1, 1, "t")], LABELS + ", text string")
    rows = filter_audit.audit(docs, labels).where("filter_order = 'EABCD' and step = 1").collect()
    assert [tuple(r[3:]) for r in rows] == [(1, 1, 0, 0, 1, 1, 60)]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 100, 1000])
def test_positional_popcount(n):
    words = np.random.default_rng(n).integers(0, 2 ** 32, n, dtype=np.uint32)
    want = [int(((words >> np.uint32(b)) & 1).sum()) for b in range(32)]
    assert filter_audit.positional_popcount(words).tolist() == want


def test_survival_words():
    assert filter_audit.survival_word(0, 5) == 2 ** 32 - 1
    assert filter_audit.survival_word(31, 5) == 1
    assert filter_audit.survival_word(1, 1) == 1
    with pytest.raises(ValueError):
        filter_audit.subset_survivors(None, 6)
