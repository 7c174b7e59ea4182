"""MinHash near-duplicates by tensored banding.

Two families of ``halves`` collections, each collection the hash of
``rows`` minhash values.  A table is keyed by a pair (one collection of the
first family, one of the second), so ``halves ** 2`` tables of
``2 * rows`` values a key cost ``2 * halves * rows`` minhash values instead
of ``2 * rows * halves ** 2``.  Two sets meet in a table if a collection of
each family agrees.

1. One pass over the texts: shingle-set size, a 128-bit digest of the set
   and the collections.  Equal digests are one class (exact copies and
   texts of the same shingles are never compared).
2. A class whose first-family collections all stand alone can meet nobody:
   only collections that repeat take part in forming table keys.
3. Pairs of a table are confirmed on full shingle sets, in rounds.  First
   every class with the smallest class it meets anywhere.  Then, of tables
   that still hold several components, every member with one pivot class.
   Members not linked with the pivot are compared by their differences from
   it: linked sets must share enough of the difference (an exact bound, see
   ``_across``), and unrelated edits of one text share next to nothing, so a
   group of copies costs about its size, not its square.  A link inside a
   component already joined cannot change the result; no pair across
   components is left out.
4. Components by star rounds on written tables.  Links that a later round
   finds are links of the components found before, so only new ones between
   components go through star rounds again.

The chance that a pair exactly at the threshold meets in no table is at most
``2 * (1 - threshold ** rows) ** halves``; ``halves_for`` sizes it below
1e-4, and it falls fast above the threshold.

Defined cases: null text is empty; a text without words has no shingles and
is linked with nothing; a text shorter than a shingle is one shingle; rows
of one ``doc_id`` count as one document; a null ``doc_id`` is linked with
nothing, has a null component and is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm import wordhash
from usagelens.llm.shared import arrow, components, files_for, stored

ROWS = 3
MISS = 1e-4


def halves_for(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss / 2) / math.log(1 - threshold ** rows))


def _signatures(k: int, rows: int, halves: int):
    seeds = np.random.Generator(np.random.PCG64(7)).integers(
        1, 2 ** 63, (2 * halves * rows, 2), dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, hashes, bounds in wordhash.shingled(batch.column(1), k):
                yield _signature_rows(batch.column(0).slice(at, to - at), hashes, bounds, seeds, rows)
    return run


def _signature_rows(ids: pa.Array, hashes: np.ndarray, bounds: np.ndarray, seeds: np.ndarray,
                    rows: int) -> pa.RecordBatch:
    n = len(bounds) - 1
    size = np.zeros(n, np.int64)
    digest = np.zeros((2, n), np.uint64)
    for i in range(n):
        one = np.sort(hashes[bounds[i]:bounds[i + 1]])
        one = one[np.concatenate(([True], one[1:] != one[:-1]))] if len(one) else one
        size[i] = len(one)
        digest[0, i] = one.sum(dtype=np.uint64)
        digest[1, i] = wordhash.mix(one).sum(dtype=np.uint64)
    full = np.flatnonzero(size)
    groups = len(seeds) // rows
    halves = np.zeros((n, groups), np.uint64)
    if len(full):
        starts, work = bounds[full], np.empty_like(hashes)
        for i, (salt, odd) in enumerate(seeds):
            np.bitwise_xor(hashes, salt, out=work)
            np.multiply(work, odd | np.uint64(1), out=work)
            low = np.minimum.reduceat(work, starts)
            halves[full, i // rows] = wordhash.mix(halves[full, i // rows] ^ low)
    return pa.RecordBatch.from_arrays(
        [ids.cast(pa.int64()), pa.array(size), wordhash.long_array(digest[0]), wordhash.long_array(digest[1]),
         wordhash.long_lists(halves.reshape(-1), np.arange(n + 1) * groups)],
        names=["doc_id", "n_shingles", "d1", "d2", "halves"])


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, hashes, bounds in wordhash.shingled(batch.column(1), k):
                own = [np.unique(hashes[bounds[i]:bounds[i + 1]]) for i in range(to - at)]
                ends = np.concatenate(([0], np.cumsum([len(x) for x in own])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at).cast(pa.int64()),
                     wordhash.long_lists(np.concatenate(own), ends)], names=["class_id", "shingles"])
    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets reach the similarity num / den."""
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    common = F.size(F.array_intersect("sa", "sb"))
    of = lambda x: sets.select(F.col("class_id").alias(x), F.col("shingles").alias(f"s{x}"),
                               F.size("shingles").alias(f"n{x}"))
    return (pairs.join(of("a"), "a").join(of("b"), "b")
            .where(den * small >= num * large)
            .withColumn("common", common)
            .where(den * F.col("common") >= num * (F.col("na") + F.col("nb") - F.col("common")))
            .select("a", "b"))


def _named(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """``rows`` with the component of their ``class_id``."""
    return (rows.join(joined, rows.class_id == joined.node, "left")
            .select(*[rows[c] for c in rows.columns], F.coalesce("component", "class_id").alias("component")))


def _merged(joined: DataFrame, edges: DataFrame, files: int) -> DataFrame:
    """The components ``joined`` (node, component) with the links (a, b)
    between components added."""
    edges = stored(edges.where("a != b").distinct(), "edges", files)
    if edges.isEmpty():
        return joined
    of = stored(components(edges), "merged", files).select(F.col("node").alias("old"), F.col("component").alias("new"))
    renamed = (joined.join(of, F.col("component") == F.col("old"), "left")
               .select("node", F.coalesce("new", "component").alias("component")))
    alone = of.select(F.col("old").alias("node"), F.col("new").alias("component"))  # in no link before
    return stored(renamed.unionByName(alone).distinct(), "joined", files)


def _apart(members: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(class_id, pivot) with the set's size ``n``, the size ``apart`` of its
    symmetric difference from the pivot's set, whether the two are
    ``linked``, and the head of that difference: what the pivot lacks first,
    then what it has, each in the order of the hashes.

    Sets x and y are linked only if |x ^ y| <= (den - num) / (den + num)
    (|x| + |y|), which is at most (den - num) / num |x|.  With differences dx
    and dy from the same pivot, |x ^ y| = |dx| + |dy| - 2 |dx & dy|, so the
    overlap they need is known, and its first element is among the first
    ``head`` ones of each.
    """
    own = sets.select("class_id", F.col("shingles").alias("own"))
    other = sets.select(F.col("class_id").alias("pivot"), F.col("shingles").alias("other"))
    n, apart = F.col("n"), F.col("apart")
    head = apart - F.greatest(F.lit(1), F.ceil((num * (apart + 1) - (den - num) * n) / (2 * num) - 1e-9)) + 1
    return (members.join(own, "class_id").join(other, "pivot")
            .withColumn("n", F.size("own"))
            .withColumn("diff", F.concat(F.sort_array(F.array_except("own", "other")),
                                         F.sort_array(F.array_except("other", "own"))))
            .withColumn("apart", F.size("diff"))
            .select("class_id", "component", "pivot", "n", "apart",
                    ((den + num) * apart <= (den - num) * (n + F.size("other"))).alias("linked"),
                    F.slice("diff", 1, head.cast("int")).alias("head")))


def _across(apart: DataFrame, num: int, den: int, files: int) -> DataFrame:
    """Pairs (a, b) of different components that may still be linked: two
    members of a pivot that share an element of their differences early
    enough for the rest to reach the overlap needed.

    Linked x and y must share one.  Else |dx| + |dy| <= q (|x| + |y|) with
    q = (den - num) / (den + num); one of them, say x, is not linked with the
    pivot p (both being linked, they are of one component), so
    |dx| > q (|x| + |p|), hence |dy| < q (|y| - |p|) <= q |dy|, which no |dy|
    satisfies.
    """
    of = lambda side, rows: rows.select(
        "pivot", *[F.col(c).alias(f"{c}_{side}") for c in rows.columns if c != "pivot"])
    tokens = apart.select("pivot", "class_id", "component", "n", "apart", F.posexplode("head").alias("at", "token"))
    # what members of one component alone share cannot join components
    shared_by = stored(tokens.groupBy("pivot", "token")
                       .agg(F.min("component").alias("low"), F.max("component").alias("top"))
                       .where("low < top").select("pivot", "token"), "tokens", files)
    tokens = stored(tokens.join(shared_by, ["pivot", "token"]), "shared-tokens", files)
    left = of("a", tokens).withColumnRenamed("token_a", "token")
    right = of("b", tokens).withColumnRenamed("token_b", "token")
    most = (den - num) * (F.col("n_a") + F.col("n_b"))
    both = F.col("apart_a") + F.col("apart_b")
    shared = F.least(F.col("apart_a") - F.col("at_a"), F.col("apart_b") - F.col("at_b"))
    differ = (F.col("class_id_a") > F.col("class_id_b")) & (F.col("component_a") != F.col("component_b"))
    pairs = left.join(right, (left.pivot == right.pivot) & (left.token == right.token) & differ
                      & ((den + num) * (both - 2 * shared) <= most))
    return pairs.select(F.col("class_id_a").alias("a"), F.col("class_id_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, k: int = 3, threshold: Fraction = Fraction(85, 100),
                    rows: int = ROWS, halves: int | None = None) -> DataFrame:
    """Documents (doc_id, text) -> (doc_id, n_shingles, component_id, kept).

    ``kept`` is true for the document a component is named after.
    """
    halves = halves or halves_for(float(threshold), rows)
    num, den = threshold.numerator, threshold.denominator
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(texts.transform(
        arrow,
        _signatures(k, rows, halves),
        "doc_id long, n_shingles long, d1 long, d2 long, halves array<long>"), "signatures")

    # tables below have some rows a document at most, so its number tells how many tasks they ask for
    files = files_for(docs.sparkSession, signed.count())
    wide = 4 * files  # of rows that hold whole sets
    full = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    # written first, as other sides of joins below: a join of two plain
    # exchanges is one whose hot keys Spark can split
    classes = stored(full.groupBy("d1", "d2").agg(F.min("doc_id").alias("class_id")), "class-ids", files)
    of_class = stored(full.select("doc_id", "d1", "d2", "halves").join(classes, ["d1", "d2"])
                      .select("doc_id", "class_id", "d1", "d2",
                              F.when(F.col("doc_id") == F.col("class_id"), F.col("halves")).alias("halves")),
                      "classes", files)

    # one row a class, then the collections of the first family that two classes or more share
    each = stored(of_class.where(F.col("halves").isNotNull()).select("class_id", "d1", "d2", "halves")
                  .dropDuplicates(["class_id", "d1", "d2"]), "each", files)
    first = each.select("class_id", F.posexplode(F.slice("halves", 1, halves)).alias("i", "half"))
    shared = stored(first.groupBy("i", "half").agg(F.min("class_id").alias("low"), F.max("class_id").alias("top"))
                    .where("low < top").select("i", "half"), "shared", files)
    left = stored(first.join(shared, ["i", "half"]), "halves", files)
    # the tables: keys from pairs of collections
    right = each.select("class_id", F.slice("halves", halves + 1, halves).alias("right"))
    keys = left.join(right, "class_id").select("class_id", F.explode(F.transform(
        "right", lambda x, j: F.xxhash64(F.col("i"), F.col("half"), j, x))).alias("key"))
    tables = stored(keys.groupBy("key").agg(F.min("class_id").alias("hub"), F.max("class_id").alias("top"))
                    .where("hub < top").select("key", "hub"), "tables", files)
    met = stored(keys.join(tables, "key"), "met", files)

    # rows of one doc_id with different texts: their classes are one
    owner = of_class.groupBy("doc_id").agg(F.min("class_id").alias("b"))
    same = stored(of_class.join(owner, "doc_id").where("class_id != b")
                  .select(F.col("class_id").alias("a"), "b").distinct(), "same", files)
    # a component, and so a pivot, may be named after a class that met nobody but is one with another
    needed = met.select(F.col("class_id").alias("doc_id")).unionByName(same.select(F.col("b").alias("doc_id")))
    sets = stored(texts.join(needed.distinct(), "doc_id")
                  .select("doc_id", "text").transform(arrow, _sets(k), "class_id long, shingles array<long>"), "sets", wide)
    pairs = met.groupBy(F.col("class_id").alias("a")).agg(F.min("hub").alias("b")).where("a > b")
    links = stored(_confirmed(pairs, sets, num, den).unionByName(same), "links", wide)
    joined = stored(components(links), "joined", files)

    # tables that still hold several components: every member against one pivot class of the table
    named = stored(_named(met, joined), "named", files)
    several = stored(named.groupBy("key").agg(F.min("component").alias("pivot"), F.max("component").alias("top"))
                     .where("pivot < top").select("key", "pivot"), "several", files)
    members = stored(named.join(several, "key").where("class_id != pivot")
                     .select("class_id", "component", "pivot").distinct(), "members", files)
    if not members.isEmpty():
        apart = stored(_apart(members, sets, num, den), "apart", wide)
        joined = _merged(joined, apart.where("linked").select(F.col("component").alias("a"), F.col("pivot").alias("b")), files)
        renamed = _named(apart.drop("component"), joined)
        found = stored(_confirmed(_across(renamed, num, den, files), sets, num, den), "found", wide)
        # of the classes found, their components
        left, right = (joined.select(F.col("node").alias(f"node_{x}"), F.col("component").alias(f"of_{x}")) for x in "ab")
        edges = (found.join(left, F.col("a") == F.col("node_a"), "left").join(right, F.col("b") == F.col("node_b"), "left")
                 .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
        joined = _merged(joined, edges, files)

    by_doc = (of_class.select("doc_id", "class_id").distinct()
              .join(joined, F.col("class_id") == F.col("node"), "left")
              .select(F.col("doc_id").alias("named"), F.coalesce("component", "class_id").alias("component_id")))
    by_doc = by_doc.groupBy("named").agg(F.min("component_id").alias("component_id"))
    out = signed.select("doc_id", "n_shingles").join(by_doc, F.col("doc_id") == F.col("named"), "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
