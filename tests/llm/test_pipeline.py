import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from tests.conftest import SF0001
from tests.llm import brute
from usagelens.llm import byte_bpe


def brute_run(docs, items, host_kept=lambda source: True):
    left = [d for d in docs if not brute.base_rules(d["text"])[-1] and host_kept(d["source"])]
    near = brute.near_duplicates([(d["doc_id"], d["text"]) for d in left], 5, 8, 10)
    left = [d for d in left if near[d["doc_id"]][1] == d["doc_id"]]
    bad = {d for d, _ in brute.contaminated([(d["doc_id"], d["text"]) for d in left], items)}
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = set()
    for d in left:
        if d["doc_id"] not in bad:
            ids = library.encode_ordinary(d["text"])
            out.add((d["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(d["text"].encode()).hexdigest()))
    return out


def test_against_brute_force(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    got = corpus_pipeline.run(spark, SF0001)
    assert {tuple(r) for r in got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()} == \
        brute_run(docs, items)
    assert 0 < got.count() < len(docs)


def test_stages_keep_the_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, gone int, doc string"
    good = " ".join(f"word{i}" for i in range(80))
    other = " ".join(f"else{i}" for i in range(90))
    rows = [(1, good, "en", "a", 5, "x", 1, "y"), (2, good, "en", "a", 5, None, 2, None), (3, None, None, None, None, "z", 3, None),
            (4, other, "en", None, 1, "x", 4, "y"), (4, other + " more", "en", "b", 1, "x", 5, "y"),
            (None, good, "en", "a", 5, "x", 6, "y"), (5, "", "en", "a", 0, "x", 7, "y")]
    unnamed = " ".join(f"more{i}" for i in range(70))  # copies without an id: one stays
    rows += [(None, unnamed, "en", "a", 1, "x", 8, "y")] * 2 + [(None, unnamed + " end", "en", "a", 1, "x", 8, "y")]
    item = next(r.text for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect() if len(r.text.split()) > 14)
    rows += [(None, " ".join(f"lead{i}" for i in range(60)) + " " + item, "en", "a", 1, "x", 9, "y")]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF0001)
        assert docs.columns == [c.split()[0] for c in schema.split(", ")], name
    left = docs.collect()
    assert sorted(r.doc_id for r in left if r.doc_id is not None) == [1, 4] and len(left) == 3
    assert [r.text.startswith("more0") for r in left if r.doc_id is None] == [True]
    assert len(corpus_pipeline.STAGES) == 4
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF0001)
    assert last.count() == 3


def test_stages_of_no_rows(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF0001)
        assert docs.count() == 0
