import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import SF0001
from usagelens.llm import elias_fano, library_tokens, separator_scan, token_shards, wordhash
from usagelens.llm.library_tokens import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", None, " ", "a" * 4000, "tabs\t\tand  spaces \n\n x's", "日本語 <|endoftext|> 🙂", "same", "same", "# # #"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)  # as it is: strings of special tokens become their ids
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def ordinary():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    rows += [(100_000 + i, t) for i, t in enumerate(TEXTS)] + [(-3, "negative id")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


ODD = ["", " ", "  x  y\n\n z", "a b ", "  x", "x\u00a0y z", " lead", "x \ty", "a b\u2003c d", "a\n b", "it's 's 't x", "x\x1c y",
       "\u3000", "x<|endoftext|>y z", "<|endoftext|>", "<|endoftext|> <|endoftext|><|endoftext|", "a <|endoftext|>\n b", "a " * 3000 + "b", "🙂 🙂  é", "a\n", "word" * 900, None]


def test_units_encode_like_whole_texts(library, monkeypatch):
    given_texts = pq.read_table(f"{SF0001}/documents.parquet")["text"].to_pylist()
    texts = ODD + given_texts + [f"new{i} words{i * 7}, and " for i in range(3000)]
    for segment, remember in ((1 << 20, 10 ** 6), (64, 50)):  # cuts inside texts; a table that starts anew
        monkeypatch.setattr(wordhash, "SEGMENT", segment)
        monkeypatch.setattr(library_tokens, "REMEMBER", remember)
        own = library_tokens.UnitEncoder(library_tokens.Library(PATH))
        some = texts if segment > 64 else ODD + given_texts[:20]
        assert [x.tolist() for x in own.encode(pa.array(some, pa.string()))] == [library(t) for t in some]


def test_clashing_hashes_are_encoded_whole(library, monkeypatch):
    plain = library_tokens._hashes
    monkeypatch.setattr(library_tokens, "_hashes", lambda *a: (plain(*a)[0] % np.uint64(3) * np.uint64(2) + np.uint64(1), plain(*a)[1]))
    own = library_tokens.UnitEncoder(library_tokens.Library(PATH))
    texts = ["one two three four", "five six", "one two"]
    for _ in range(2):
        assert [x.tolist() for x in own.encode(pa.array(texts))] == [library(t) for t in texts]


def test_special_tokens(library, ordinary):
    texts = ["日本語 <|endoftext|> x", "<|endoftext|>", "no<|endoftext|> space "]
    assert [x.tolist() for x in encoder(PATH).encode(pa.array(texts))] == [library(t) for t in texts]
    assert [x.tolist() for x in encoder(PATH, ordinary=True).encode(pa.array(texts))] == [ordinary(t) for t in texts]
    assert len(library(texts[0])) != len(ordinary(texts[0])) and 50256 not in ordinary(texts[0])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t'ab1é\u00a0"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=5))
def test_any_texts(library, texts):
    assert [x.tolist() for x in encoder(PATH).encode(pa.array(texts, pa.string()))] == [library(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=2000), st.integers(0, 10 ** 6))
def test_elias_fano(steps, more):
    values = np.cumsum(steps).astype(np.int64)
    universe = int(values[-1]) + more if len(values) else more
    code = elias_fano.encode(values, universe)
    order = np.random.default_rng(0).permutation(len(values))
    assert elias_fano.select(order, *code).tolist() == values[order].tolist()
    if len(values):
        assert code[0] == 0 or universe >> code[0] < 2 * len(values)


def test_shards(spark, library, scratch_dir):
    rows, df = documents(spark)
    path = scratch_dir + "/shards"
    token_shards.write(df, path, PATH, end_id=2, shard_ids=5000)
    want, at = {}, 0
    for doc, text in sorted(rows):
        ids = [*library(text), 2]
        want[doc] = (at, len(ids), ids)
        at += len(ids)
    read = token_shards.read(spark, path).collect()
    assert {r.doc_id: (r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) for r in read} == want
    digests = token_shards.digests(spark, path).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in digests} == {
        d: (s, n, zlib.crc32(np.array(ids, "<u4").tobytes())) for d, (s, n, ids) in want.items()}
    assert spark.read.parquet(path).count() > 10  # several shards


def test_shards_of_repeated_and_no_rows(spark, scratch_dir):
    df = spark.createDataFrame([(None, "b"), (4, "x"), (4, "x"), (4, "y"), (None, None)], "doc_id long, text string")
    token_shards.write(df, scratch_dir + "/a", PATH, end_id=2)
    read = sorted(token_shards.read(spark, scratch_dir + "/a").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in read] == [None, None, 4, 4, 4]
    assert [r.start for r in read] == list(np.cumsum([0] + [r.n_tokens for r in read])[:-1])
    token_shards.write(df.limit(0), scratch_dir + "/b", PATH, end_id=2)
    assert token_shards.read(spark, scratch_dir + "/b").count() == 0


@pytest.mark.parametrize("block", [7, 1 << 20])
def test_counts_with_headers(spark, ordinary, scratch_dir, block):
    rows, df = documents(spark)
    more = [(None, "nobody's"), (2 ** 63 - 1, "largest"), (-2 ** 63, "smallest"), (2 ** 61, "a"), (-2 ** 62 - 1, "b c")]
    rows += more
    df = df.union(spark.createDataFrame(more, df.schema))
    separator_scan.write_flat(df, scratch_dir + "/f", PATH, 50256, header=True)
    got = separator_scan.count_tokens(spark, scratch_dir + "/f", 50256, header=True, block=block).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {d: len(ordinary(t)) for d, t in rows}
    assert len(got) == len(rows) and all(r.closed for r in got)


@pytest.mark.parametrize("block", [1, 3, 64])
def test_documents_over_blocks_and_files(spark, tmp_path, block):
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 60, 4000).astype("<u4")
    ids[700:1900] = 1  # a document over many blocks and several files
    cuts = [0, 0, 11, 800, 1200, 1201, 3000, 4000]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        (tmp_path / f"tokens-{i:03}").write_bytes(ids[a:b].tobytes())
    ends = np.flatnonzero(ids == 7)
    starts = np.concatenate(([0], ends + 1))
    want = [(i, int(s), int(e - s), True) for i, (s, e) in enumerate(zip(starts, ends))]
    if starts[-1] < len(ids):
        want.append((len(ends), int(starts[-1]), int(len(ids) - starts[-1]), False))
    got = separator_scan.count_tokens(spark, str(tmp_path), 7, "<u4", block=block).collect()
    assert sorted((r.ordinal, r.start, r.n_tokens, r.closed) for r in got) == want


def test_no_documents(spark, scratch_dir):
    df = spark.createDataFrame([], "doc_id long, text string")
    separator_scan.write_flat(df, scratch_dir + "/f", PATH, 50256)
    assert separator_scan.count_tokens(spark, scratch_dir + "/f", 50256).count() == 0
