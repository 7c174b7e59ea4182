"""Filter interaction audit by truth-table survival words.

A document that fails a set of filters survives exactly those subsets of the
filters that hold none of them.  With five filters there are 32 subsets, so
a document becomes one 32-bit word whose bit ``s`` says whether it survives
subset ``s``.  Counting each bit over all words of a part (positional
popcount) gives the survivors of every subset, and all orders, steps,
redundancies and Shapley sums are differences of those 32 numbers: no order
is ever run over the documents.

Bits are counted with carry-save adders: three words of a weight become one
of that weight and one of the double, 32 columns at a time.  Each Arrow batch
gives 32 counts a (part, label), which Spark sums with map-side combine, so a
part that holds a third of all rows costs its rows once and then a few
numbers a batch.

Copies: the smallest ``doc_id`` of each text is found by a map-side combined
minimum over 128-bit text digests; a row is then matched on (digest,
``doc_id``), never on the digest alone, so a text that a third of all rows
share is no hot key.

Defined cases: null text is the empty text (and a copy of other empty ones);
null lang is the part ``""``; a null ``doc_id`` is smaller than nothing, so it
is no copy, makes none, and has no label; rows repeating a ``doc_id`` count
each, and are no copies of one another; of several label rows of a document
the larger value counts; empty tables give no rows; other columns of the
tables are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.shared import arrow, stored

LETTERS = "ABCDE"
UPPER = bytes(range(65, 91))
MARKS = re.compile(rb"[#$%&*|]")


# ---------------------------------------------------------------- the filters
def _failures(text: bytes, code_points: int) -> int:
    """Bits 0-3: what the text fails of A (short), B (few different words),
    C (capitals), D (marks)."""
    words = text.split()  # of bytes: at \x20 and \x09-\x0D
    n = len(words)
    return ((n < 200)
            | (100 * len(set(words)) < 50 * n) << 1
            | (100 * (len(text) - len(text.translate(None, UPPER))) > 3 * code_points) << 2
            | bool(MARKS.search(text)) << 3)


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2)
        fails = np.zeros(len(texts), np.int32)
        digests = []
        lengths = pc.utf8_length(texts).to_pylist()
        for i, text in enumerate(texts):  # one text at a time in memory beside the batch
            own = text.as_buffer().to_pybytes()
            fails[i] = _failures(own, lengths[i])
            digests.append(hashlib.blake2b(own, digest_size=16).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(fails), pa.array(digests, pa.binary())],
            names=["doc_id", "part", "fails", "digest"])


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, good, toxic) per document: the bits of the filters
    A-E it fails, and whether its label says quality 1 and toxic 1."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                        F.coalesce("text", F.lit("")).alias("text"))
    facts = stored(arrow(texts, _facts, "doc_id long, part string, fails int, digest binary"), "facts")
    first = facts.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    first = first.withColumnRenamed("digest", "of")
    is_first = F.col("first_id").isNotNull() | F.col("doc_id").isNull()
    rows = (facts.join(first, (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("first_id")), "left")
            .select("doc_id", "part", "digest",
                    F.when(is_first, F.col("fails")).otherwise(F.col("fails").bitwiseOR(F.lit(16))).alias("fails")))
    marks = (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("labelled"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
                  F.lit(True).alias("known")))
    # rows without an id spread over the digests instead of meeting in one task
    key = F.coalesce("doc_id", F.xxhash64("digest"))
    return (rows.join(marks, (key == F.col("labelled")) & (F.col("doc_id").isNotNull() == F.col("known")), "left")
            .select("part", "fails", F.coalesce("good", F.lit(False)).alias("good"),
                    F.coalesce("toxic", F.lit(False)).alias("toxic")))


# ---------------------------------------------------------------- survival words
def survival_word(fails: int, n: int) -> int:
    """Bit ``s`` is set if failing ``fails`` survives the filters of subset ``s``."""
    return sum(1 << s for s in range(1 << n) if not fails & s)


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit, by carry-save adders."""
    counts = np.zeros(32, np.int64)
    level, weight = np.asarray(words, np.uint32), 1
    while len(level):
        carried = []
        while (k := len(level) // 3):
            a, b, c = level[:k], level[k:2 * k], level[2 * k:3 * k]
            odd = a ^ b
            carried.append((a & b) | (odd & c))
            level = np.concatenate([odd ^ c, level[3 * k:]])
        counts += weight * ((level[:, None] >> np.arange(32, dtype=np.uint32)) & 1).sum(0, dtype=np.int64)
        level, weight = np.concatenate(carried) if carried else level[:0], 2 * weight
    return counts


def _survivors(table: np.ndarray):
    """Batches of (part, label, fails) -> (part, subset, n, good, toxic)."""
    subsets = len(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(0).dictionary_encode()
            code = parts.indices.to_numpy().astype(np.int64) * 4 + batch.column(1).to_numpy()
            words = table[batch.column(2).to_numpy()]
            order = np.argsort(code, kind="stable")
            code, words = code[order], words[order]
            starts = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else code
            counts = np.zeros((len(parts.dictionary), 3, subsets), np.int64)
            for at, to in zip(starts, [*starts[1:], len(code)]):
                n, label = positional_popcount(words[at:to])[:subsets], int(code[at]) % 4
                counts[code[at] // 4] += n[None, :] * np.array([1, label & 1, label >> 1])[:, None]
            size = len(parts.dictionary)
            yield pa.RecordBatch.from_arrays(
                [parts.dictionary.take(pa.array(np.repeat(np.arange(size), subsets))),
                 pa.array(np.tile(np.arange(subsets, dtype=np.int32), size)),
                 *[pa.array(counts[:, i].reshape(-1)) for i in range(3)]],
                names=["part", "subset", "n", "good", "toxic"])
    return run


def subset_survivors(rows: DataFrame, n_filters: int) -> DataFrame:
    """(part, fails, good, toxic) -> one row a part with ``survivors``, an
    array of (subset, n, good, toxic) in the order of the subsets."""
    if not 1 <= n_filters <= 5:
        raise ValueError("a 32-bit word holds the subsets of one to five filters")
    table = np.array([survival_word(f, n_filters) for f in range(1 << n_filters)], np.uint32)
    label = (F.col("good").cast("int") + 2 * F.col("toxic").cast("int")).cast("int")
    counted = arrow(rows.select("part", label.alias("label"), F.col("fails").cast("int").alias("fails")),
                    _survivors(table), "part string, subset int, n long, good long, toxic long")
    sums = counted.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    return sums.groupBy("part").agg(
        F.array_sort(F.collect_list(F.struct("subset", "n", "good", "toxic"))).alias("survivors"))


def orders(rows: DataFrame, letters: str = LETTERS) -> DataFrame:
    """The report of ``subset_survivors``: a row per part, order and step."""
    n, every = len(letters), (1 << len(letters)) - 1
    bits = {letter: 1 << i for i, letter in enumerate(letters)}

    def at(subset: Column | int, field: str) -> Column:
        subset = F.lit(subset) if isinstance(subset, int) else subset
        return F.get("survivors", subset).getField(field)

    shapley = F.create_map(*[x for letter, bit in bits.items() for x in (F.lit(letter), sum(
        (F.lit(math.factorial(s.bit_count()) * math.factorial(n - 1 - s.bit_count())) * (at(s, "n") - at(s | bit, "n"))
         for s in range(every + 1) if not s & bit), F.lit(0)))])
    steps = (rows.select("part", "survivors", shapley.alias("shares"), F.explode(F.array(
        *[F.lit("".join(p)) for p in permutations(letters)])).alias("filter_order"))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
        .withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
        .withColumn("bit", F.element_at(
            F.create_map(*[x for letter, b in bits.items() for x in (F.lit(letter), F.lit(b))]), F.col("letter")))
        .withColumn("before", sum((F.when(F.instr("filter_order", letter) < F.col("step"), b).otherwise(0)
                                   for letter, b in bits.items()), F.lit(0)))
        .withColumn("after", F.col("before") + F.col("bit")))
    lost = lambda field: at(F.col("before"), field) - at(F.col("after"), field)
    fails = at(0, "n") - at(F.col("bit"), "n")
    return steps.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), at(F.col("after"), "n").alias("kept"),
        lost("n").alias("removed"), (fails - lost("n")).alias("redundant"),
        (at(F.lit(every) - F.col("bit"), "n") - at(every, "n")).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"),
        F.element_at("shares", F.col("letter")).cast("long").alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The filters A-E over documents, in all 120 orders."""
    return orders(subset_survivors(judged(docs, labels), len(LETTERS)))
