"""Removal of repeated passages by level-wise doubling.

A window is ``words`` consecutive words of a document.  Every word covered by
a window that also starts in a document of a smaller id goes.

1. Rows of one text are a class; the row of the smallest id stands for it, and
   any other has all its windows in that one.
2. Level one, half the length: a window is represented by the smallest hash
   among the half-length windows in it, so neighbouring windows share one and
   equal windows always agree on it, wherever they stand.  Only runs of
   windows whose half-length window occurs in two documents go on (one value
   a run, about a fourteenth of the words for 50).
3. Doubling: the window at the start of a run is looked up at ``words``, and
   those that repeat, and they alone, at twice that length, and so on, until
   none survives.  What repeats in a smaller document at any length is
   covered whole, so a long copied passage costs a few windows a run.
4. The windows that no such passage covers (the ends of passages, and those of
   the first document) are compared one by one.

Each step is a map-side combined minimum and maximum of ``doc_id`` per hash
joined back on the hash; both sides are plain exchanges, whose hot keys Spark
can split.  No step gathers the occurrences of a hash; lists are of one
text's windows.  Windows of the full length and beyond are told apart by 128
bits, half-length ones, which only select, by 64.

Defined cases: null and empty texts have no words; texts shorter than a
window lose nothing; a null ``doc_id`` is neither smaller nor larger than
another, so its row loses nothing and removes nothing; rows that repeat a
``doc_id`` do not remove from one another; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm import wordhash
from usagelens.llm.shared import arrow, stored

WORDS = 50
RUNS = "array<struct<start:int,stop:int>>"
Batches = Iterator[pa.RecordBatch]


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        values, done = np.minimum(values[:-done], values[done:]), 2 * done
    return values if done == width else np.minimum(values[:done - width], values[width - done:])


def _runs(size: int):
    """(doc_id, t1, t2, text) -> the number of words, the digest of the words,
    and runs of windows with the smallest half-length hash in them."""
    half = (size + 1) // 2

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = batch.column(3)
            data, offsets = wordhash.text_buffers(texts)
            for at, to in wordhash.slices(offsets):
                part = data[offsets[at]:offsets[to]]
                words, bounds = wordhash.word_hashes(part, offsets[at:to + 1] - offsets[at], fold=False)
                yield _run_rows(batch.slice(at, to - at), part, offsets[at:to + 1] - offsets[at], words, bounds, size, half)
    return run


def _run_rows(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, words: np.ndarray, bounds: np.ndarray,
              size: int, half: int) -> pa.RecordBatch:
    counts = np.diff(bounds)
    n = np.maximum(counts - size + 1, 0)  # windows of each text
    doc = np.repeat(np.arange(len(n)), n)
    begin = np.cumsum(n) - n
    place = np.arange(len(doc)) - begin[doc]  # of each window in its text
    if len(doc):
        least = _smallest(wordhash.Windows(words).of(np.arange(len(words) - half + 1), half, 0), size - half + 1)
        value = least[bounds[:-1][doc] + place]
        new = np.flatnonzero((place == 0) | np.concatenate(([True], value[1:] != value[:-1])))
    else:
        value = new = np.zeros(0, np.int64)
    ends = np.searchsorted(doc[new], np.arange(len(n) + 1))
    stop = np.append(new[1:], len(doc))
    digests = [hashlib.sha256(b" ".join(data[a:b].tobytes().split())).hexdigest()
               for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    lists = lambda x: pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(x.astype(np.int32)))
    return pa.RecordBatch.from_arrays(
        [*rows.columns[:3], pa.array(counts.astype(np.int64)), pa.array(digests),
         wordhash.long_lists(value[new], ends), lists(place[new]), lists(place[stop - 1] + 1 if len(new) else new)],
        names=["doc_id", "t1", "t2", "n_words", "words_sha256", "least", "start", "stop"])


def _candidate(runs: list[dict], n: int) -> np.ndarray:
    """Which of the ``n`` windows are in one of the runs."""
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, [r["start"] for r in runs], 1)
    np.add.at(mark, [r["stop"] for r in runs], -1)
    return np.cumsum(mark[:-1]) > 0


def _each(batch: pa.RecordBatch, size: int):
    """(row, word hashes' windows, which windows are candidates) per text."""
    for i in range(batch.num_rows):
        row = {c: batch.column(c)[i] for c in batch.schema.names}
        data, offsets = wordhash.text_buffers(batch.column("text").slice(i, 1))
        words, _ = wordhash.word_hashes(data, offsets, fold=False)
        yield row, wordhash.Windows(words), _candidate(row["runs"].as_py(), len(words) - size + 1)


def _levels(size: int):
    """The windows at the starts of candidate runs, at each doubled length
    that stays among candidates: hashes of two longs a level."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row, windows, candidate in _each(batch, size):
                starts = np.unique([r["start"] for r in row["runs"].as_py()])
                breaks = np.append(np.flatnonzero(~candidate), len(candidate))
                room = breaks[np.searchsorted(breaks, starts)] - starts + size - 1  # words from there among candidates
                levels = np.zeros(len(starts), np.int64)
                cells = []
                length = size
                while (fits := room >= length).any():
                    levels += fits
                    at = starts[fits]
                    both = np.zeros((len(starts), 2), np.uint64)
                    both[fits, 0], both[fits, 1] = windows.of(at, length, 0), windows.of(at, length, 1)
                    cells.append(both)
                    length *= 2
                shown = np.arange(len(cells))[None, :] < levels[:, None]
                flat = np.stack(cells, 1)[shown].reshape(-1)
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc_id"].as_py()] * n, pa.int64()), pa.array([row["t1"].as_py()] * n, pa.int64()),
                     pa.array(starts.astype(np.int32)),
                     wordhash.long_lists(flat, np.concatenate(([0], np.cumsum(2 * levels))))],
                    names=["doc_id", "t1", "start", "hashes"])
    return run


def _uncovered(size: int):
    """The candidate windows that no repeated longer window covers."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row, windows, left in _each(batch, size):
                mark = np.zeros(len(left) + 1, np.int64)
                for span in row["covered"].as_py() or ():
                    mark[span["start"]] += 1
                    mark[span["start"] + span["words"] - size + 1] -= 1
                at = np.flatnonzero(left & (np.cumsum(mark[:-1]) == 0))
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc_id"].as_py()] * n, pa.int64()), pa.array([row["t1"].as_py()] * n, pa.int64()),
                     pa.array(at.astype(np.int32)), wordhash.long_array(windows.of(at, size, 0)),
                     wordhash.long_array(windows.of(at, size, 1))], names=["doc_id", "t1", "start", "h1", "h2"])
    return run


def _cut(batches: Batches) -> Batches:
    """Texts and their repeated spans -> what is left, and the merged spans."""
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            words = batch.column("text")[i].as_buffer().to_pybytes().split()
            mark = np.zeros(len(words) + 1, np.int64)
            for span in batch.column("spans")[i].as_py():
                mark[span["start"]] += 1
                mark[span["start"] + span["words"]] -= 1
            gone = np.cumsum(mark[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
            kept = b" ".join([words[j] for j in np.flatnonzero(~gone).tolist()]).decode()
            spans = [{"start": int(a), "words": int(b - a)} for a, b in zip(edges[::2], edges[1::2])]
            out.append((batch.column("doc_id")[i].as_py(), batch.column("t1")[i].as_py(), int(gone.sum()), kept, spans))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(),
                 pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32())]))]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], k) for j, k in enumerate(kinds)],
                                         names=["doc_id", "t1", "n_removed", "kept", "removed"])


def _repeated(rows: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """(k0, ..., first_id): keys that occur in documents of different ids,
    with the smallest id.  Written first, so that a join with it is of two
    plain exchanges."""
    named = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    return stored(rows.groupBy(*named).agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
                  .where("first_id < last_id").drop("last_id"), name)


def _joined(rows: DataFrame, known: DataFrame, keys: list[Column]) -> DataFrame:
    on = keys[0] == known["k0"]
    for i, key in enumerate(keys[1:], 1):
        on = on & (key == known[f"k{i}"])
    return rows.join(known, on).drop(*[f"k{i}" for i in range(len(keys))])


def _spans(rows: DataFrame, name: str) -> DataFrame:
    """(of_doc, of_t1, ``name``): the spans of one text (a set: a list of at
    most its windows, whatever the number of equal rows)."""
    return rows.groupBy(F.col("doc_id").alias("of_doc"), F.col("t1").alias("of_t1")).agg(
        F.collect_set(F.struct("start", "words")).alias(name))


def _of(rows: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    return (rows.join(lists, (rows["doc_id"] == lists["of_doc"]) & (rows["t1"] == lists["of_t1"]), how)
            .drop("of_doc", "of_t1"))


def repeated_spans(texts: DataFrame, size: int = WORDS) -> DataFrame:
    """Spans (doc_id, t1, start, words) that also start in a document of a
    smaller id, of the texts (doc_id, t1, text, runs) with their candidate
    runs: the levels of doubling, then what they leave."""
    rows = stored(arrow(texts.select("doc_id", "t1", "text", "runs"), _levels(size),
                        "doc_id long, t1 long, start int, hashes array<long>"), "level-windows")
    covered, level = [], 0
    while True:
        keys = [F.get("hashes", F.lit(2 * level + i)) for i in (0, 1)]
        rows = rows.where(F.size("hashes") > 2 * level)
        rows = stored(_joined(rows, _repeated(rows, keys, "level"), keys), "survivors")
        if rows.isEmpty():
            break
        covered.append(rows.where("doc_id > first_id").select("doc_id", "t1", "start", F.lit(size << level).alias("words")))
        rows, level = rows.drop("first_id"), level + 1
    none = rows.select("doc_id", "t1", "start", F.lit(size).alias("words"))
    for part in covered:
        none = none.unionByName(part)
    long = stored(none, "covered")
    left = stored(arrow(_of(texts, _spans(long, "covered"), "left").select("doc_id", "t1", "text", "runs", "covered"),
                        _uncovered(size), "doc_id long, t1 long, start int, h1 long, h2 long"), "windows")
    keys = [F.col("h1"), F.col("h2")]
    found = _joined(left, _repeated(left, keys, "repeated"), keys).where("doc_id > first_id")
    return long.unionByName(found.select("doc_id", "t1", "start", F.lit(size).alias("words")))


def remove_repeats(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """Documents (doc_id, text) -> (doc_id, n_words, n_removed, removed,
    kept, words_sha256).

    ``removed`` are the spans (start, words) that go.  ``kept`` are the words
    that stay, joined by one space; it is null where all stay.
    ``words_sha256`` is the digest of all words joined by one space.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t1"),
                        F.xxhash64(F.lit(1), "text").alias("t2"), F.col("text").cast("string").alias("text"))
    signed = stored(arrow(named, _runs(size), "doc_id long, t1 long, t2 long, n_words long, words_sha256 string, "
                          "least array<long>, start array<int>, stop array<int>"), "runs")
    first = (signed.where((F.col("n_words") >= size) & F.col("doc_id").isNotNull())
             .groupBy(F.col("t1").alias("of_t1"), F.col("t2").alias("of_t2")).agg(F.min("doc_id").alias("first_id")))
    own = (signed.join(first, (F.col("t1") == F.col("of_t1")) & (F.col("t2") == F.col("of_t2"))
                       & (F.col("doc_id") == F.col("first_id")), "left"))
    lists = [F.when(F.col("first_id").isNotNull(), F.col(c)).alias(c) for c in ("least", "start", "stop")]
    copy = (F.col("n_words") >= size) & F.col("doc_id").isNotNull() & F.col("first_id").isNull()
    classes = stored(own.select("doc_id", "t1", "n_words", "words_sha256", copy.alias("copy"), *lists), "classes")

    values = classes.where("least is not null").select("doc_id", F.explode(F.array_distinct("least")).alias("least"))
    seeds = _repeated(values, [F.col("least")], "seeds")
    runs = (classes.where("least is not null")
            .select("doc_id", "t1", F.explode(F.arrays_zip("least", "start", "stop")).alias("run"))
            .select("doc_id", "t1", "run.least", F.struct("run.start", "run.stop").alias("run")))
    candidates = (_joined(runs, seeds, [F.col("least")])
                  .groupBy(F.col("doc_id").alias("of_doc"), F.col("t1").alias("of_t1"))
                  .agg(F.collect_set("run").cast(RUNS).alias("runs")))
    texts = stored(_of(named.where("doc_id is not null").select("doc_id", "t1", "text"), stored(candidates, "candidates"),
                       "inner").dropDuplicates(["doc_id", "t1"]), "texts")

    spans = stored(_spans(repeated_spans(texts, size), "spans"), "spans")
    cut = arrow(_of(texts.select("doc_id", "t1", "text"), spans, "inner").select("doc_id", "t1", "text", "spans"), _cut,
                "doc_id long, t1 long, n_removed long, kept string, removed array<struct<start:int,words:int>>")
    cut = stored(cut, "cut").withColumnsRenamed({"doc_id": "of_doc", "t1": "of_t1"})
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("words")))
    none = F.array().cast("array<struct<start:int,words:int>>")
    return _of(classes.select("doc_id", "t1", "n_words", "words_sha256", "copy"), cut, "left").select(
        "doc_id", "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), whole).otherwise(F.coalesce("removed", none)).alias("removed"),
        F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept")).alias("kept"), "words_sha256")
