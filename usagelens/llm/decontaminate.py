"""Benchmark decontamination by SimHash windows and a Hamming index.

For every length L that benchmark items have, windows of L words of a
document are fingerprinted: 64-bit SimHash of their k-word shingles, from
running counts over the document; a document of fewer words is one window,
as long as the similarity can still be reached.  The fingerprints are looked
up among the items of that length by multi-index hashing: cut into four
blocks of 16 bits, two fingerprints at most ``RADIUS`` bits apart agree within
``REACH`` bits in one block at least, so an index of all values within
``REACH`` bits of an item's blocks finds every window within that radius, and
4.3 % of unrelated ones.  Runs of windows found are then confirmed by the exact
similarity: with every shingle weighted by its number of occurrences, sum of
minima over sum of maxima.

A radius that pruned nothing would be needed to hold every window of
similarity 0.8, so there is an exact second way.  A window reaches the
similarity ``t`` to an item of n shingles only if it shares ``t n`` of them,
hence one of any ``n - ceil(t n) + 1``: the item's *prefix*, the first ones
by hash.  Windows are fingerprinted only around prefix shingles, and a run
that shares one with an item is confirmed with it even if the index did not
name the pair.

Which prefix shingles the items of a length have is told to the tasks by two
bitmaps (one for any length and one, with two places each, keyed by length;
false positives cost time only) of 64 bits a prefix shingle, between
``LEAST_BITS`` and ``MOST_BITS`` (32 MB each) whatever the benchmark.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; null
text is empty; a text without words matches nothing; an item or document of
fewer than ``k`` words is one shingle, so it matches what is equal; equal
items are found each; documents of one ``doc_id`` are reported together; a
null ``doc_id`` is reported as null.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm import wordhash
from usagelens.llm.shared import arrow, stored

K = 5
THRESHOLD = 0.8
BLOCKS, REACH = 4, 3
RADIUS = BLOCKS * (REACH + 1) - 1
LEAST_BITS, MOST_BITS = 1 << 23, 1 << 28  # powers of two
_U = np.uint64
Batches = Iterator[pa.RecordBatch]

#: Every 16-bit value within REACH bits of 0.
_NEAR = [sum(1 << b for b in bits) for n in range(REACH + 1) for bits in combinations(range(16), n)]


def _counts(hashes: np.ndarray) -> np.ndarray:
    """Running counts of each of the 64 bits: row i counts the first i hashes."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=out[1:])
    return out


def simhashes(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the ``size`` hashes from each start: the bits that more
    than half of them have."""
    counts = _counts(hashes)
    more = 2 * (counts[starts + size] - counts[starts]) > size
    return np.packbits(more, axis=1, bitorder="little").view("<u8").reshape(-1)


def _prefix(hashes: np.ndarray, threshold: float) -> np.ndarray:
    """The first different shingles by hash that hold more occurrences than a
    window of the similarity can lack."""
    values, times = np.unique(wordhash.mix(hashes), return_counts=True)
    lacking = len(hashes) - math.ceil(threshold * len(hashes) - 1e-9)
    return values[:int(np.searchsorted(np.cumsum(times), lacking, "right")) + 1]


def _item_rows(k: int, threshold: float) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            data, offsets = wordhash.text_buffers(batch.column(1))
            words, bounds = wordhash.word_hashes(data, offsets)
            hashes, at = wordhash.shingle_hashes(words, bounds, k)
            sizes = np.diff(bounds)
            some = np.flatnonzero(sizes)
            own = [hashes[at[i]:at[i + 1]] for i in some]
            prints = np.array([simhashes(h, np.array([0]), len(h))[0] for h in own], np.uint64)
            prefixes = [_prefix(h, threshold) for h in own]
            lists = lambda x: wordhash.long_lists(np.concatenate([hashes[:0], *x]),
                                                  np.concatenate(([0], np.cumsum([len(y) for y in x]))).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(some)), pa.array(sizes[some], pa.int32()), wordhash.long_array(prints),
                 lists(own), lists(prefixes)], names=["item_id", "size", "print", "shingles", "prefix"])
    return run


def _keyed(hashes: np.ndarray, size: int) -> np.ndarray:
    return wordhash.mix(hashes + _U(size))


def _bitmaps(items: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the items' prefix shingles, alone and keyed by length.  What
    comes to the driver is at most MOST_BITS / 64 longs for each, whatever
    the items."""
    n = items.agg(F.sum(F.size("prefix"))).first()[0] or 0
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (64 * n).bit_length()))

    def places(batches: Batches) -> Batches:
        for batch in batches:
            for length, own in zip(batch.column(0).to_pylist(), batch.column(1)):
                h = np.array(own.values).view(np.uint64)
                keyed = _keyed(h, length)
                at = np.concatenate((h % _U(size), keyed % _U(size) + _U(size), (keyed >> _U(32)) % _U(size) + _U(size)))
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64))], names=["at"])
    words = (items.select("size", "prefix").transform(arrow, places, "at long")
             .groupBy(F.floor(F.col("at") / 64).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits")).collect())
    both = np.zeros(2 * size // 64, np.uint64)
    for word, bits in words:
        both[word] = bits & (2 ** 64 - 1)
    flags = both.view(np.uint8)
    return flags[:size // 8], flags[size // 8:]


def _marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes whose bit is set."""
    at = (hashes & _U(8 * len(bitmap) - 1)).view(np.int64)
    byte = bitmap.take(at >> 3)
    some = np.flatnonzero(byte)
    return some[(byte[some] >> (at[some] & 7).astype(np.uint8)) & 1 == 1]


def _window_rows(k: int, sizes: list[int], bitmaps, threshold: float) -> Callable[[Batches], Batches]:
    """A row for every run of windows of one size around prefix shingles of
    the items of that size: its document, the hashes from its first window to
    its last, the fingerprints of the windows, and the prefix shingles met.
    A document with fewer shingles than the window is its one window."""
    most = 1 << 16  # windows a row; a longer run goes over several rows

    every = np.array(sizes, np.uint64)

    def by_length(hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(size, places of the shingles that are in a prefix of that size)."""
        shared, keyed = bitmaps.value
        mixed = wordhash.mix(hashes)
        marked = _marked(shared, mixed)
        step = max(1, (1 << 20) // max(1, len(marked)))
        for at in range(0, len(every) if len(marked) else 0, step):
            some = every[at:at + step]
            keys = wordhash.mix(mixed[marked] + some[:, None]).reshape(-1)
            hits = _marked(keyed, keys)
            row, place = np.divmod(hits[_marked(keyed, keys[hits] >> _U(32))], len(marked))
            for r in np.unique(row).tolist():
                yield int(some[r]), marked[place[row == r]]

    def runs(hashes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        for size, at in by_length(hashes):
            whole = max(size - k + 1, 1)
            m = min(whole, len(hashes))
            if m / whole < threshold:  # all of it in the item is too little
                continue
            last = len(hashes) - m
            first, end = np.maximum(at - m + 1, 0), np.minimum(at, last) + 1  # both ascend
            new = np.flatnonzero(first[1:] > end[:-1]) + 1
            begins, ends = first[np.concatenate(([0], new))], end[np.concatenate((new - 1, [len(end) - 1]))]
            for b, e in zip(begins.tolist(), ends.tolist()):
                for s in range(b, e, most):
                    n = min(most, e - s)
                    span = hashes[s:s + n + m - 1]
                    met = np.unique(wordhash.mix(hashes[at[(at >= s) & (at < s + len(span))]]))
                    yield size, s, span, np.unique(simhashes(span, np.arange(n), m)), met

    def run(batches: Batches) -> Batches:
        count = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, to, hashes, bounds in wordhash.shingled(batch.column(1), k):
                rows = []
                for i in range(to - at):
                    for size, s, *lists in runs(hashes[bounds[i]:bounds[i + 1]]):
                        rows.append((count, ids[at + i], size, s, *(x.view(np.int64) for x in lists)))
                        count += 1
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 3]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                                     names=["run", "doc_id", "size", "at", "span", "prints", "met"])
    return run


def similarities(span: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Sum of minima over sum of maxima of the bag ``own`` and every window of
    as many hashes (or of all of them, if there are fewer) of ``span``."""
    m = min(len(own), len(span))
    values, bag = np.unique(own, return_counts=True)
    which = np.minimum(np.searchsorted(values, span), len(values) - 1)
    hit = values[which] == span
    common = np.zeros(len(span) - m + 1, np.int64)
    for i in np.unique(which[hit]).tolist():  # a running count of one shingle at a time
        seen = np.concatenate(([0], np.cumsum(hit & (which == i))))
        common += np.minimum(seen[m:] - seen[:-m], bag[i])
    return common / (m + len(own) - common)


def _verified(threshold: float) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                doc, item, at, span, own = (batch.column(j)[i] for j in range(5))
                each = similarities(span.values.to_numpy(), own.values.to_numpy())
                best = int(np.argmax(each))
                if each[best] >= threshold:
                    rows.append((doc.as_py(), item.as_py(), at.as_py() + best, float(each[best])))
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                names=["doc_id", "item_id", "at", "similarity"])
    return run


def _blocks(fingerprint: str) -> F.Column:
    """(block, value) of the four blocks of a fingerprint."""
    return F.inline(F.array(*[F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(fingerprint, 16 * b)
                                       .bitwiseAND(F.lit(65535)).cast("int").alias("value")) for b in range(BLOCKS)]))


def near_prints(prints: DataFrame, items: DataFrame) -> DataFrame:
    """(size, print, item_id): fingerprints (size, print) with the items of
    that size whose own is within RADIUS bits."""
    near = F.explode(F.array(*[F.lit(x) for x in _NEAR]))
    index = (items.select("item_id", "size", F.col("print").alias("own")).select("*", _blocks("own"))
             .withColumn("flip", near).withColumn("value", F.col("value").bitwiseXOR(F.col("flip"))).drop("flip"))
    index = stored(index, "index")  # whose size is then known, whatever the items' was
    return (prints.select("*", _blocks("print")).join(index, ["size", "block", "value"])
            .where(F.bit_count(F.col("print").bitwiseXOR(F.col("own"))) <= RADIUS)
            .select("size", "print", "item_id").distinct())


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = K, threshold: float = THRESHOLD) -> DataFrame:
    """Documents (doc_id, text) and items (item_id, text) -> (doc_id,
    item_id, at, similarity) of the items a document contains: the most
    similar window and the word it begins at (the first of equals)."""
    items = stored(benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string"))
                   .transform(arrow, _item_rows(k, threshold),
                              "item_id long, size int, print long, shingles array<long>, prefix array<long>"), "items")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # one row a length
    bitmaps = docs.sparkSession.sparkContext.broadcast(_bitmaps(items))
    runs = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
                  .transform(arrow, _window_rows(k, sizes, bitmaps, threshold), "run long, doc_id long, size int, "
                             "at long, span array<long>, prints array<long>, met array<long>"), "runs")

    # every fingerprint is looked up once, however many copies carry it
    prints = runs.select("size", F.explode("prints").alias("print"))
    near = near_prints(prints.distinct(), items)
    by_print = runs.select("run", "size", F.explode("prints").alias("print")).join(near, ["size", "print"])
    by_prefix = runs.select("run", "size", F.explode("met").alias("shingle")).join(
        items.select("item_id", "size", F.explode("prefix").alias("shingle")), ["size", "shingle"])
    pairs = by_print.select("run", "item_id").unionByName(by_prefix.select("run", "item_id")).distinct()
    rows = (pairs.join(runs.select("run", "doc_id", "at", "span"), "run")
            .join(items.select("item_id", "shingles"), "item_id").select("doc_id", "item_id", "at", "span", "shingles"))
    checked = rows.transform(arrow, _verified(threshold), "doc_id long, item_id long, at long, similarity double")
    return (checked.groupBy("doc_id", "item_id")
            .agg(F.max(F.struct("similarity", (-F.col("at")).alias("back"))).alias("best"))
            .select("doc_id", "item_id", (-F.col("best.back")).alias("at"), F.col("best.similarity")))
