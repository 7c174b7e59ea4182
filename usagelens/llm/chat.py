"""Chat rendering of maximal conversations.

A logging client that stores the whole conversation after every turn leaves
snapshots: conversations that are a prefix of longer ones.  Every turn gets
a position-tagged 128-bit hash, and the running XOR of a conversation's
hashes identifies each of its prefixes.  A conversation whose full hash is a
proper prefix hash of any conversation goes (anti-join); of equal
conversations the smallest ``conv_id`` stays.  Only what stays is rendered.

A conversation of very many turns is numbered and hashed in blocks of turns
whose sums are carried over, so no task has to order all of it; only the
rendering brings its turns together, in the one text they become.

Defined cases: turns are ordered by ``turn`` (nulls first), then role, then
text, and repeated rows count as turns; null role and null text differ from
empty ones in the comparison and are rendered as ``unknown`` and as nothing;
rows without ``conv_id`` belong to no conversation and are left out; no rows
give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.shared import stored

BLOCK = 256  # turn numbers a block
START, END = "<|im_start|>", "<|im_end|>"


def turn_text(role: Column, text: Column) -> Column:
    """One rendered turn.  Marks inside a text are broken up by a space, so
    a text cannot begin or end a turn."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"<\|(im_start|im_end)\|>", "<| $1 |>")
    return F.concat(F.lit(START), F.coalesce(role, F.lit("unknown")), F.lit("\n"), plain, F.lit(END + "\n"))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, h1, h2): turns numbered from 1, with the
    hash of the conversation up to and including each."""
    block = F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                        F.col("text").cast("string").alias("text")).where("conv_id is not null") \
        .withColumn("block", block)
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    over = Window.partitionBy("conv_id").orderBy("block")
    blocks = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    blocks = blocks.select(F.col("conv_id").alias("c"), F.col("block").alias("b"),
                           (F.sum("n").over(over) - F.col("n")).alias("before"))
    key = (F.col("conv_id") == F.col("c")) & (F.col("block") == F.col("b"))
    placed = (rows.withColumn("k", F.row_number().over(inside)).join(blocks, key)
              .withColumn("place", (F.col("k") + F.col("before")).cast("long")))
    for name, salt in (("x1", "a"), ("x2", "b")):
        placed = placed.withColumn(name, F.xxhash64(
            F.lit(salt), "place", F.col("role").isNull(), "role", F.col("text").isNull(), "text"))
    placed = stored(placed.select("conv_id", "block", "place", "role", "text", "x1", "x2"), "turns")
    sums = placed.groupBy("conv_id", "block").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"))
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    sums = sums.select(F.col("conv_id").alias("c"), F.col("block").alias("b"),
                       F.coalesce(F.bit_xor("s1").over(earlier), zero).alias("s1"),
                       F.coalesce(F.bit_xor("s2").over(earlier), zero).alias("s2"))
    running = (Window.partitionBy("conv_id", "block").orderBy("place")
               .rowsBetween(Window.unboundedPreceding, 0))
    return (placed.withColumn("r1", F.bit_xor("x1").over(running)).withColumn("r2", F.bit_xor("x2").over(running))
            .join(sums, key)
            .select("conv_id", "place", "role", "text", F.col("r1").bitwiseXOR(F.col("s1")).alias("h1"),
                    F.col("r2").bitwiseXOR(F.col("s2")).alias("h2")))


def maximal(hashed: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the conversations that are no proper
    prefix of another; ``n_copies`` counts the equal ones, itself included."""
    at = ["place", "h1", "h2"]
    ends = hashed.groupBy("conv_id").agg(F.max(F.struct(*at)).alias("end")).select("conv_id", "end.*")
    whole = ends.groupBy(*at).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    last = ends.select(F.col("conv_id").alias("c"), F.col("place").alias("n"))
    proper = (hashed.select("conv_id", *at).join(last, F.col("conv_id") == F.col("c"))
              .where("place < n").select(*at).distinct())
    return whole.join(proper, at, "left_anti").select("conv_id", F.col("place").alias("n_turns"), "n_copies")


def render(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) -> (conv_id, n_turns, n_copies, text)."""
    hashed = stored(prefix_hashes(turns), "prefixes")
    keep = stored(maximal(hashed), "maximal")
    texts = (hashed.select("conv_id", "place", turn_text(F.col("role"), F.col("text")).alias("t"))
             .join(keep.select("conv_id"), "conv_id", "left_semi")
             .groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "t"))),
                                                              lambda x: x["t"]), "").alias("text")))
    return keep.join(texts, "conv_id").select("conv_id", "n_turns", "n_copies", "text")
