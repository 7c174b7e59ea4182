import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from usagelens.llm import byte_bpe, pieces
from usagelens.llm.pieces import PieceEncoder


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return byte_bpe.Vocabulary(ranks)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", " ", "  x  y\n\n z", "a" * 5000, "日本語 text  ''s's 'll x", "\n" * 100, "<|endoftext|>", "🙂🙂  é",
         "Thheouble heenwh on reti ingeser erster that.\nAnd more 12345 $$$ ..."]


def test_perfect_hash_is_minimal(vocabulary):
    assert sorted(vocabulary.perfect.slots(vocabulary.keys).tolist()) == list(range(len(vocabulary.keys)))


def test_against_the_library(vocabulary, reference, monkeypatch):
    monkeypatch.setattr(pieces, "CHUNK", 50)  # a long text goes over several chunks
    texts = TEXTS + ["word " * 400, "x " * 7000]
    got = PieceEncoder(public_tokenizers.PATTERN, vocabulary.resolve).encode(texts)
    assert [x.tolist() for x in got] == [reference.encode_ordinary(t) for t in texts]
    assert [vocabulary.decode(x).tobytes().decode() for x in got] == texts


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=80), max_size=5))
def test_any_text(vocabulary, reference, texts):
    got = PieceEncoder(public_tokenizers.PATTERN, vocabulary.resolve).encode(texts)
    assert [x.tolist() for x in got] == [reference.encode_ordinary(t) for t in texts]
    assert [vocabulary.decode(x).tobytes().decode() for x in got] == texts


def test_columns(spark, ranks, reference):
    rows = [(i, t, "mine") for i, t in enumerate(TEXTS)] + [(None, None, None), (1, " ", "mine")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = byte_bpe.decode(byte_bpe.encode(df, ranks, public_tokenizers.PATTERN), ranks).collect()
    assert len(out) == len(rows)
    for r in out:
        assert np.frombuffer(r.ids, "<u4").tolist() == reference.encode_ordinary(r.text or "")
        assert r.decoded.decode() == (r.text or "")
    both = byte_bpe.round_trip(df, ranks, public_tokenizers.PATTERN)
    assert both.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert sorted(hashlib.sha256(r.ids).hexdigest() for r in both.collect()) == \
        sorted(hashlib.sha256(r.ids).hexdigest() for r in out)
    assert byte_bpe.round_trip(df.limit(0), ranks, public_tokenizers.PATTERN).count() == 0
