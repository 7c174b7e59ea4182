"""A training-corpus pipeline of four stages over ``documents``.

Quality rules, MinHash near-dedup, benchmark decontamination, and byte-level
BPE.  Every stage works on all its predecessor kept, written as Parquet and
read again; all but the last return the columns of ``documents``.

Defined cases: the operators' own (see their modules); rows without a
``doc_id`` are judged like any other, by a key made of their text, which comes
after all ids, so that of copies the one with an id stays, and of copies
without an id one; rows that repeat a ``doc_id`` are one document, of which
the row with the smallest text hash stays; columns of documents other than
doc_id, text and source pass through, whatever their names.
"""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.llm import byte_bpe, decontaminate, host_rules
from usagelens.llm.minhash_dedup import near_duplicates
from usagelens.llm.shared import files_for, stored, table

SHINGLE_WORDS = 5
NEAR = Fraction(8, 10)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their own and their host's rules."""
    return host_rules.quality(docs).where("kept").select("doc.*")


#: Keys of rows without a ``doc_id`` lie from here on.
UNNAMED = 1 << 62


def _keyed(docs: DataFrame) -> DataFrame:
    """(key, doc): the rows of ``docs`` with a key that is never null."""
    own = F.lit(UNNAMED) + F.xxhash64("text").bitwiseAND(F.lit(UNNAMED - 1))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), own).alias("key"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def _texts(keyed: DataFrame) -> DataFrame:
    return keyed.select(F.col("key").alias("doc_id"), F.col("doc.text").alias("text"))


def _without(keyed: DataFrame, gone: DataFrame) -> DataFrame:
    """``keyed`` without the keys of a table (a column ``gone``, distinct)."""
    return keyed.join(gone, keyed["key"] == gone["gone"], "left_anti")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest ``doc_id``."""
    keyed = _keyed(docs)
    found = stored(near_duplicates(_texts(keyed), SHINGLE_WORDS, NEAR), "near")
    files = files_for(spark, found.count())
    gone = stored(found.where("not kept").select(F.col("doc_id").alias("gone")).distinct(), "copies", files)
    left = _without(keyed, gone)
    again = stored(found.where("kept").groupBy(F.col("doc_id").alias("gone"))
                   .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gone"), "repeats", files)
    if again.isEmpty():
        return left.select("doc.*")
    # rows that repeat a key: the one of the smallest hash stays
    named = left.join(again, left["key"] == again["gone"], "left_semi")
    one = named.groupBy("key").agg(F.min_by("doc", F.struct(F.xxhash64("doc.text"), F.xxhash64("doc"))).alias("doc"))
    return _without(left, again).unionByName(one).select("doc.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    keyed = _keyed(docs)
    found = decontaminate.contaminated(_texts(keyed), table(spark, sf_dir, "benchmark"))
    gone = stored(found.select(F.col("doc_id").alias("gone")).distinct(), "contaminated")
    return _without(keyed, gone).select("doc.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ids by the ranks,
    decoded again."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = byte_bpe.round_trip(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", tokens),
]

#: SQL can express neither near-dedup nor BPE; the tests hold run() against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; returns the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
