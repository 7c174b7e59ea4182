"""Importance resampling towards a target collection, by segment deduplication.

Features are the runs of one to three consecutive words of a text, hashed to
buckets.  A bucket's gain says how much more frequent it is in the target
than in the corpus; a document's weight is the sum of its features' gains,
and Gumbel noise from its id turns "highest scores" into a draw without
replacement in proportion to the weights' exponentials.

Separator newlines cut texts into lines, and no word crosses one:

* corpus counts: every distinct line (grouped by Spark, copies combined
  before the shuffle) is split into words and hashed once, and its counts are
  multiplied by its occurrences.  Runs that cross lines depend on the
  neighbours too; they are hashed from the edges of the lines in the same
  pass over the texts and added;
* weights: within a block of texts each distinct line is hashed once, and its
  gain goes to every document that holds it; crossing runs are added.

A run's CRC-32 is put together from its words' (the CRC of a concatenation is
a linear map of the parts'), so every byte is read once, not three times.
Only the ``buckets`` counts leave a task, and only the ``buckets`` gains are
sent to tasks (80 kB for 10,000).  Ranks come from one range shuffle of
(score, doc_id), not from a sort in one task.

Defined cases: null text has no words; documents without words have weight 0;
a null ``doc_id`` is hashed as the text ``42:`` and comes last among equal
scores; rows that repeat a ``doc_id`` are documents of their own (equal keys
are ranked in an arbitrary order among themselves); with an empty corpus or
target its counts are 0; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm import wordhash
from usagelens.llm.shared import arrow, stored
from usagelens.operators.selection import numbered

BUCKETS = 10_000
MIN_WORDS = 20
SHARE = (5, 100)
SEED = 42

_U = np.uint32
#: A-Z to lower case; bytes that belong to words: 0-9, a-z, everything beyond ASCII.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: Words up to this many bytes are hashed side by side, longer ones alone.
_SHORT = 40


def _crc_table() -> np.ndarray:
    """The CRC-32 of zlib, a byte at a time: the reversed polynomial 0xEDB88320."""
    table = np.arange(256, dtype=_U)
    for _ in range(8):
        table = np.where(table & _U(1), (table >> _U(1)) ^ _U(0xEDB88320), table >> _U(1))
    return table


_CRC = _crc_table()


def _shift_tables(most: int) -> np.ndarray:
    """[n, k, b]: what byte k of value b of a CRC becomes after n more bytes
    (linear, so the four bytes' results are combined by XOR)."""
    at = np.array([[_U(b << (8 * k)) for b in range(256)] for k in range(4)], _U)
    tables = [at]
    for _ in range(most):
        at = _CRC[at & _U(255)] ^ (at >> _U(8))
        tables.append(at)
    return np.array(tables)


_SHIFT = _shift_tables(_SHORT + 1).reshape(-1)


def _shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    base = n * 1024
    out = _SHIFT[base + (crc & _U(255))]
    for k in (1, 2, 3):
        out ^= _SHIFT[base + (k * 256) + ((crc >> _U(8 * k)) & _U(255))]
    return out


class Words:
    """The words of some lines: CRC and length of each, and offsets per line.

    ``spaced`` is the CRC of a space and the word; a longer word's bytes are
    kept, since its CRC is continued byte by byte.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = _INSIDE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | cut[1:-1]
        last[:-1] &= ~inside[1:] | cut[1:-1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(start, offsets)
        self.size = end - start
        self.crc = np.zeros(len(start), _U)
        data = _LOWER[data]
        order = np.argsort(-self.size, kind="stable")
        order = order[np.searchsorted(-self.size[order], -_SHORT):]
        place, size, state = start[order], self.size[order], np.full(len(order), 0xFFFFFFFF, _U)
        for j in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -j))  # words of more than j bytes
            state[:n] = _CRC[(state[:n] ^ data[place[:n] + j]) & _U(255)] ^ (state[:n] >> _U(8))
        self.crc[order] = ~state
        self.long = {}
        for i in np.flatnonzero(self.size > _SHORT).tolist():
            self.long[i] = b" " + data[start[i]:end[i]].tobytes()
            self.crc[i] = zlib.crc32(self.long[i][1:])
        self.after = np.minimum(self.size, _SHORT) + 1
        self.spaced = _shifted(np.full(len(start), zlib.crc32(b" "), _U), self.after - 1) ^ self.crc

    def joined(self, crc: np.ndarray, word: np.ndarray) -> np.ndarray:
        """CRCs of the runs of ``crc``, a space and the ``word``-th words."""
        out = _shifted(crc, self.after[word]) ^ self.spaced[word]
        if self.long:
            for i in np.flatnonzero(self.size[word] > _SHORT).tolist():
                out[i] = zlib.crc32(self.long[int(word[i])], int(crc[i]))
        return out


def _line_runs(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(line, CRC) of the runs of one, of two and of three words inside a line."""
    counts = np.diff(words.bounds)
    line = np.repeat(np.arange(len(counts)), counts)
    yield line, words.crc
    pair = np.flatnonzero(line[1:] == line[:-1])
    two = words.joined(words.crc[pair], pair + 1)
    yield line[pair], two
    three = np.flatnonzero(pair[1:] == pair[:-1] + 1)
    yield line[pair[three]], words.joined(two[three], pair[three] + 2)


class Segments:
    """A block of whole texts as distinct lines and their places."""

    def __init__(self, texts: pa.Array):
        lists = pc.split_pattern(texts, "\n")
        coded = lists.flatten().dictionary_encode()
        self.lines = coded.dictionary
        self.line = coded.indices.to_numpy().astype(np.int64)
        self.offsets = lists.offsets.to_numpy().astype(np.int64)
        self.offsets -= self.offsets[0]
        self.words = Words(*wordhash.text_buffers(self.lines))

    def crossing(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text, CRC) of every run of two or three words that spans lines.

        Only the two words at each end of a line can be in one, so the lines
        are laid out as those words, with a gap where words were left out.
        """
        w = self.words
        count = np.diff(w.bounds)[self.line]
        shown = np.minimum(count, 4)
        at = np.concatenate(([0], np.cumsum(shown)))
        place = np.arange(int(at[-1])) - np.repeat(at[:-1], shown)
        place += np.where((np.repeat(count, shown) > 4) & (place >= 2), np.repeat(count - 4, shown), 0)
        word = np.repeat(w.bounds[:-1][self.line], shown) + place
        line = np.repeat(np.arange(len(self.line)), shown)
        text = np.repeat(np.searchsorted(self.offsets, np.arange(len(self.line)), "right") - 1, shown)
        # inside a line the words of a run follow one another; left-out words are never between two lines
        pair = np.flatnonzero((text[1:] == text[:-1]) & (line[1:] != line[:-1]))
        yield text[pair], w.joined(w.crc[word[pair]], word[pair + 1])
        near = (line[1:] != line[:-1]) | (word[1:] == word[:-1] + 1)
        three = np.flatnonzero((text[2:] == text[:-2]) & (line[2:] != line[:-2]) & near[1:] & near[:-1])
        two = w.joined(w.crc[word[three]], word[three + 1])
        yield text[three], w.joined(two, word[three + 2])

    def sums(self, of_line: np.ndarray) -> np.ndarray:
        """Per text, the sum over its lines."""
        total = np.concatenate(([0], np.cumsum(of_line[self.line])))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int, Segments]]:
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    _, offsets = wordhash.text_buffers(texts)
    for at, to in wordhash.slices(offsets):
        yield at, to, Segments(texts.slice(at, to - at))


def _split(buckets: int):
    """Texts -> (line, null, occurrences) and (null, bucket, crossing runs)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crossing = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, block in _blocks(batch.column(0)):
                for _, crc in block.crossing():
                    crossing += np.bincount(crc % _U(buckets), minlength=buckets)
                n = len(block.lines)
                yield pa.RecordBatch.from_arrays(
                    [block.lines, pa.nulls(n, pa.int32()), pa.array(np.bincount(block.line, minlength=n))],
                    names=["line", "bucket", "n"])
        yield _bucket_rows(crossing, True)
    return run


def _bucket_rows(counts: np.ndarray, with_line: bool = False) -> pa.RecordBatch:
    at = np.flatnonzero(counts)
    cells = [pa.array(at.astype(np.int32)), pa.array(counts[at])]
    if with_line:
        return pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.string()), *cells], names=["line", "bucket", "n"])
    return pa.RecordBatch.from_arrays(cells, names=["bucket", "n"])


def _count(buckets: int):
    """Distinct lines and counts of crossing runs -> (bucket, n)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            done = batch.filter(pc.is_valid(batch.column(1)))
            np.add.at(total, done.column(1).to_numpy(), done.column(2).to_numpy())
            lines = batch.filter(pc.is_valid(batch.column(0)))
            texts, times = lines.column(0), lines.column(2).to_numpy()
            data, offsets = wordhash.text_buffers(texts)
            for at, to in wordhash.slices(offsets):
                words = Words(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
                for line, crc in _line_runs(words):
                    # weights are exact in doubles below 2 ** 53 of one bucket and block
                    total += np.bincount(crc % _U(buckets), times[at:to][line], buckets).astype(np.int64)
        yield _bucket_rows(total)
    return run


def feature_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): runs of words of all texts (one column) by bucket."""
    lines = arrow(texts, _split(buckets), "line string, bucket int, n long")
    distinct = lines.groupBy("line", "bucket").agg(F.sum("n").alias("n"))
    return arrow(distinct, _count(buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) per bucket, in doubles."""
    b, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float((t + 1) * (s_all + b)) / float((s + 1) * (t_all + b))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _weigh(gain: np.ndarray):
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, block in _blocks(batch.column(1)):
                n, weight = to - at, np.zeros(len(block.lines), np.int64)
                n_words = np.diff(block.words.bounds)
                for line, crc in _line_runs(block.words):
                    own = gain[crc % _U(buckets)]
                    total = np.concatenate(([0], np.cumsum(own)))
                    bounds = np.searchsorted(line, np.arange(len(weight) + 1))
                    weight += total[bounds[1:]] - total[bounds[:-1]]
                weight, n_words = block.sums(weight), block.sums(n_words)
                for text, crc in block.crossing():
                    np.add.at(weight, text, gain[crc % _U(buckets)])
                features = n_words + np.maximum(n_words - 1, 0) + np.maximum(n_words - 2, 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), pa.array(n_words), pa.array(features), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"])
    return run


def _counts(df: DataFrame, buckets: int) -> np.ndarray:
    """The ``buckets`` numbers of a corpus, at most."""
    out = np.zeros(buckets, np.int64)
    for bucket, n in df.collect():
        out[bucket] = n
    return out


def weights(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of documents (doc_id, text)
    towards the texts of ``target``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gain = gains(_counts(feature_counts(rows.select("text"), buckets), buckets),
                 _counts(feature_counts(target.select(F.col("text").cast("string").alias("text")), buckets), buckets))
    return arrow(rows, _weigh(gain), "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS,
             seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank): ``rank`` numbers
    the drawn documents by falling score, and is null for the others."""
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                                      .cast("binary"), 256), 1, 8), 16, 10).cast("long")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((noise + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = stored(weights(docs, target, buckets).withColumn("score", F.col("weight") + gumbel.cast("long")), "scores")
    long = scored.where(F.col("n_words") >= min_words)
    placed, total = numbered(long, [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "rank")
    drawn = share[0] * total // share[1]
    ranked = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")))
