"""Token-id files with Elias-Fano document boundaries.

Documents go in ascending ``doc_id`` order (ties by a hash of the text) by
one range shuffle; each task packs its documents into shards of about
``SHARD_IDS`` ids and writes them as Parquet rows:

    part, shard      task of the range order, number of the shard in it
    doc_ids          ids of its documents, in order
    n_ids            number of token ids
    width, ids       2 or 4 bytes an id (2 if the vocabulary allows), little-endian
    low_bits, low,   Elias-Fano code of where its documents end, counted
    upper, ones      from the start of the shard

Offsets in a shard are local; what lies before a shard is the sum of the
tasks and shards before it, taken when the files are read.  Spark's commit
protocol publishes a task's file whole or not at all.

Defined cases: null text is empty, so its document is the end id alone; a
document is never cut, so one longer than a shard makes a larger shard; null
``doc_id`` sorts first; repeated rows are documents of their own; no rows
give files without shards; strings of special tokens become those tokens, as
the library has it; a single document must stay under 2 GB of ids, which is
what a binary cell holds.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from usagelens.llm import elias_fano, wordhash
from usagelens.llm.library_tokens import encoder, vocabulary_size
from usagelens.llm.shared import arrow

SHARD_IDS = 1 << 20
SCHEMA = ("part int, shard int, doc_ids array<long>, n_ids long, width int, ids binary, "
          "low_bits int, low binary, upper binary, ones binary")
Batches = Iterator[pa.RecordBatch]


def _shard(part: int, shard: int, doc_ids: list, ids: list[np.ndarray], width: int) -> pa.RecordBatch:
    ends = np.cumsum([len(x) for x in ids])
    bits, low, upper, ones = elias_fano.encode(ends, int(ends[-1]))
    blob = np.concatenate(ids).astype(f"<u{width}").tobytes()
    row = [part, shard, doc_ids, int(ends[-1]), width, blob, bits, low, upper, ones]
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.binary(),
             pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)


def _packed(tokenizer: str, end_id: int, width: int, shard_ids: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        part, shard, held, docs, size = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            _, offsets = wordhash.text_buffers(batch.column(1))
            for at, to in wordhash.slices(offsets):
                for doc, ids in zip(batch.column(0).slice(at, to - at).to_pylist(),
                                    encoder(tokenizer).encode(batch.column(1).slice(at, to - at))):
                    held.append(np.append(ids, np.uint32(end_id)).astype(f"<u{width}"))
                    docs.append(doc)
                    size += len(ids) + 1
                    if size >= shard_ids:
                        yield _shard(part, shard, docs, held, width)
                        shard, held, docs, size = shard + 1, [], [], 0
        if held:
            yield _shard(part, shard, docs, held, width)
    return run


def write(docs: DataFrame, to: str, tokenizer: str, end_id: int, shard_ids: int = SHARD_IDS) -> None:
    """Encodes (doc_id, text) without special tokens, appends ``end_id`` to
    each document and writes the shards to the folder ``to``."""
    width = 2 if max(vocabulary_size(tokenizer), end_id + 1) <= 1 << 16 else 4
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tie = F.xxhash64("text")
    (rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
     .transform(arrow, _packed(tokenizer, end_id, width, shard_ids), SCHEMA)
     .write.option("compression", "zstd").parquet(to))


def _documents(batches: Batches) -> Batches:
    for batch in batches:
        for row in batch.to_pylist():
            n = len(row["doc_ids"])
            ends = elias_fano.select(np.arange(n), row["low_bits"], row["low"], row["upper"], row["ones"])
            starts = np.concatenate(([0], ends[:-1]))
            ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays([
                pa.array([row["part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32()),
                pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(ends - starts),
                pa.array([ids[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())],
                names=["part", "shard", "doc_id", "local", "n_tokens", "ids"])


def _digests(batches: Batches) -> Batches:
    for batch in batches:
        crc = [zlib.crc32(x) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(crc, pa.int64())],
                                         names=["part", "shard", "doc_id", "local", "n_tokens", "ids_crc32"])


def _shard_starts(shards: DataFrame) -> DataFrame:
    """(of_part, of_shard, before): ids before each shard.  Only the row a
    writing task has goes through one task."""
    tasks = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    first = tasks.select(F.col("part").alias("of"), (F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("base"))
    order = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    return (shards.select("part", "shard", (F.sum("n_ids").over(order) - F.col("n_ids")).alias("inside"))
            .join(first, F.col("part") == F.col("of"))
            .select(F.col("part").alias("of_part"), F.col("shard").alias("of_shard"),
                    (F.col("base") + F.col("inside")).alias("before")))


def _placed(documents: DataFrame, shards: DataFrame) -> DataFrame:
    starts = _shard_starts(shards)
    return (documents.join(starts, (F.col("part") == F.col("of_part")) & (F.col("shard") == F.col("of_shard")))
            .withColumn("start", F.col("before") + F.col("local"))
            .drop("part", "shard", "local", "of_part", "of_shard", "before"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the files: (doc_id, n_tokens, ids, start), ``ids``
    unsigned 32-bit little-endian with the end id."""
    shards = spark.read.schema(SCHEMA).parquet(path)
    documents = shards.transform(
        arrow,
        _documents, "part int, shard int, doc_id long, local long, n_tokens long, ids binary")
    return _placed(documents, shards)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, start) of the documents of the files;
    the ids themselves do not leave the task that reads them."""
    shards = spark.read.schema(SCHEMA).parquet(path)
    documents = shards.transform(
        arrow,
        lambda batches: _digests(_documents(batches)),
        "part int, shard int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return _placed(documents, shards)
