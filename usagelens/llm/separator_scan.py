"""Token counts of flat, unindexed token files by a scan for the end id.

A file is nothing but ids of a fixed width; a document ends at the end id.
Files are read block by block: a vectorised search gives the places of the
end id in a block, and so the lengths of what begins and ends in it.  What
is open at the end of a block is stitched by prefix sums over the blocks:
documents before a block, ids before it, and where the last document before
it ended.  A document may go over any number of blocks and files.

``write_flat`` makes such files.  With a header every document begins with
``HEADER`` ids below ``BASE`` that spell its ``doc_id``, so that counts can
be told to documents although nothing is indexed or sorted.

Defined cases: null text is empty; an empty document has no ids; ids after
the last end id are a document that is not ``closed``; empty files and
folders of empty files give no documents; any 64-bit ``doc_id`` can be
spelled, and a null one as the largest number of the header, which comes back
null; strings of special tokens are read as text, so that no text holds the
end id; a file must stay under 2 GB, which is what the reader takes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from usagelens.llm import wordhash
from usagelens.llm.library_tokens import encoder
from usagelens.llm.shared import arrow, stored

BLOCK = 1 << 20  # ids searched at once
BASE, HEADER = 50_000, 5  # 50,000 ** 5 > 2 ** 64; every digit is below the end id
OFFSET = 1 << 63  # a doc_id is spelled as itself plus this
Batches = Iterator[pa.RecordBatch]


def _spelled(doc_id: int | None) -> list[int]:
    n = BASE ** HEADER - 1 if doc_id is None else doc_id + OFFSET
    return [n // BASE ** k % BASE for k in reversed(range(HEADER))]


def _flat(tokenizer: str, end_id: int, kind: str, header: bool) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            _, offsets = wordhash.text_buffers(batch.column(1))
            for at, to in wordhash.slices(offsets):
                rows = []
                for doc, ids in zip(batch.column(0).slice(at, to - at).to_pylist(),
                                    encoder(tokenizer, ordinary=True).encode(batch.column(1).slice(at, to - at))):
                    first = _spelled(doc) if header else []
                    whole = np.concatenate((first, ids, [end_id])).astype(kind).tobytes()
                    rows.append(whole[:-1])  # the writer adds the last byte
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["row"])
    return run


def write_flat(docs: DataFrame, to: str, tokenizer: str, end_id: int, kind: str = ">u2", header: bool = False) -> None:
    """Writes the ids of (doc_id, text), each document followed by
    ``end_id``, as flat files of ``kind`` (numpy's name of the id type).

    Spark's text writer puts bytes through as they are and one byte after
    each row; that byte is the last one of the end id, which so has to be
    below 128 (big-endian ids see to that for most end ids).
    """
    last = int(np.array(end_id, kind).tobytes()[-1])
    if last > 127:
        raise ValueError(f"the last byte of end id {end_id} as {kind} is not below 128")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    (rows.transform(arrow, _flat(tokenizer, end_id, kind, header), "row binary")
     .select(F.col("row").cast("string").alias("row"))
     .write.option("lineSep", chr(last)).text(to))


def _blocks(end_id: int, kind: str, header: bool, block: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                ids = np.frombuffer(content.as_buffer(), kind)
                begin = 0  # of the document that is open, in a file of headers
                for k, at in enumerate(range(0, len(ids), block)):
                    part = ids[at:at + block]
                    ends = np.flatnonzero(part == end_id)
                    docs = None
                    if header and len(ends):
                        starts = np.concatenate(([begin], at + ends[:-1] + 1))
                        begin = at + int(ends[-1]) + 1
                        digits = ids[starts[:, None] + np.arange(HEADER)].astype(np.uint64)
                        spelled = np.zeros(len(starts), np.uint64)  # below 2 ** 64 but for null
                        for k_digit in range(HEADER):
                            spelled = spelled * np.uint64(BASE) + digits[:, k_digit]
                        own = (spelled ^ np.uint64(OFFSET)).view(np.int64)  # less OFFSET
                        null = (digits == BASE - 1).all(1)
                        docs = [None if no else x for x, no in zip(own.tolist(), null.tolist())]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([path.as_py()]), pa.array([k], pa.int64()), pa.array([len(part)], pa.int64()),
                        pa.array([ends], pa.list_(pa.int64())), pa.array([docs], pa.list_(pa.int64()))],
                        names=["path", "block", "n_ids", "ends", "doc_ids"])
    return run


def count_tokens(spark: SparkSession, path: str, end_id: int, kind: str = ">u2", header: bool = False,
                 block: int = BLOCK) -> DataFrame:
    """(ordinal, doc_id, start, n_tokens, closed) of every document in the
    flat files of a folder, taken in the order of their names.  ``start`` is
    the place of its first id; neither end id nor header are counted.  With
    ``header`` a document must not go over files.

    A task holds one file in memory, so files should be no larger than a
    partition, as Spark writes them.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    blocks = stored(files.transform(
        arrow,
        _blocks(end_id, kind, header, block),
        "path string, block long, n_ids long, ends array<long>, doc_ids array<long>"), "blocks")

    def before(order: Window) -> Callable:
        rows = order.rowsBetween(Window.unboundedPreceding, -1)
        return lambda c, f=F.sum: f(c).over(rows)
    zero, own = F.lit(0).cast("long"), before(Window.partitionBy("path").orderBy("block"))
    inside = (blocks.select("path", "block", "n_ids", F.size("ends").cast("long").alias("n_docs"),
                            F.try_element_at("ends", F.lit(-1)).alias("last"))
              .withColumn("ids_in", F.coalesce(own("n_ids"), zero))
              .withColumn("docs_in", F.coalesce(own("n_docs"), zero))
              .withColumn("after", F.col("ids_in") + F.col("last") + 1)
              .withColumn("open_in", own("after", F.max)))
    of_file = before(Window.orderBy("path"))  # one row a file
    sums = (inside.groupBy("path").agg(F.sum("n_ids").alias("n_ids"), F.sum("n_docs").alias("n_docs"),
                                       F.max("after").alias("after"))
            .withColumn("ids_at", F.coalesce(of_file("n_ids"), zero))
            .withColumn("docs_at", F.coalesce(of_file("n_docs"), zero))
            .withColumn("after", F.col("ids_at") + F.col("after"))
            .withColumn("open_at", F.coalesce(of_file("after", F.max), zero)))
    sums = stored(sums, "files")
    placed = (inside.select("path", "block", "ids_in", "docs_in", "open_in")
              .join(sums.select("path", "ids_at", "docs_at", "open_at"), "path")
              .select("path", "block", (F.col("ids_at") + F.col("ids_in")).alias("ids_before"),
                      (F.col("docs_at") + F.col("docs_in")).alias("docs_before"),
                      F.coalesce(F.col("ids_at") + F.col("open_in"), "open_at").alias("open")))
    i, at = F.col("i"), F.col("ids_before")
    closed = (blocks.join(placed, ["path", "block"])
              .select("docs_before", "ids_before", "open", "ends", "doc_ids", F.posexplode("ends").alias("i", "end"))
              .select((F.col("docs_before") + i).alias("ordinal"), F.get("doc_ids", i).alias("doc_id"),
                      F.when(i == 0, F.col("open")).otherwise(at + F.get("ends", i - 1) + 1).alias("start"),
                      (at + F.col("end")).alias("end"), F.lit(True).alias("closed")))
    rest = (sums.agg(F.sum("n_docs").alias("ordinal"), F.lit(None).cast("long").alias("doc_id"),
                     F.coalesce(F.max("after"), zero).alias("start"), F.sum("n_ids").alias("end"),
                     F.lit(False).alias("closed")).where("end > start"))
    skip = HEADER if header else 0
    start = F.col("start") + skip
    return closed.unionByName(rest).select("ordinal", "doc_id", start.alias("start"),
                                           (F.col("end") - start).alias("n_tokens"), "closed")
