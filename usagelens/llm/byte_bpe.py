"""Byte-level BPE with a two-tier lookup, and its decoding.

A pre-token that is a vocabulary entry as a whole is found through a
minimal perfect hash of the vocabulary (hash and displace: every entry has a
slot of its own in a table without gaps; the stored bytes are compared, so
strangers are told apart).  Any other pre-token is merged pair by pair, the
lowest rank first and the leftmost of equals, from a heap of pairs over
linked bytes, in n log n.

Tokenising runs on Arrow batches inside tasks; each distinct pre-token of a
chunk is resolved once.

Defined cases: null text is empty and has no ids; texts of any length are
encoded whole; a null id column passes through.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm import wordhash
from usagelens.llm.pieces import PieceEncoder, gather
from usagelens.llm.shared import arrow

_U = np.uint64
_BYTES = np.random.Generator(np.random.PCG64(5)).integers(1, 2 ** 63, 256, dtype=np.uint64)
_ODD = 0x9E3779B97F4A7C15


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each key, from one pass over all their bytes."""
    lengths = np.fromiter(map(len, keys), np.int64, len(keys))
    data = np.frombuffer(b"".join(keys), np.uint8)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    mixed = wordhash.mix(_BYTES[data] + place.astype(np.uint64) * _U(_ODD))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(mixed, out=total[1:])
    one = wordhash.mix(total[starts + lengths] - total[starts] + lengths.astype(np.uint64))
    return one, wordhash.mix(one ^ _U(_ODD))


class PerfectHash:
    """A minimal perfect hash of distinct keys: ``slots`` maps key i to its
    own number below n, and any other key to some number below n."""

    LOAD = 4  # keys a bucket, on average

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        self.buckets = max(1, n // self.LOAD)
        self.shift = np.zeros(self.buckets, np.int64)
        one, two = _hashes(keys)
        bucket = (one % _U(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(sizes)
        taken = np.zeros(n, bool)
        for b in np.argsort(-sizes, kind="stable"):
            own = two[order[ends[b] - sizes[b]:ends[b]]]
            if len(own) < 2:
                break
            base = 0
            while True:
                tries = np.arange(base, base + 64)
                at = self._place(own[:, None], tries[None, :])
                free = ~taken[at].any(0)
                ordered = np.sort(at, 0)
                free &= (ordered[1:] != ordered[:-1]).all(0)
                if free.any():
                    k = int(np.argmax(free))
                    self.shift[b] = base + k
                    taken[at[:, k]] = True
                    break
                base += 64
        rest = np.flatnonzero(sizes == 1)  # one key each: any free slot, named directly
        self.shift[rest] = -1 - np.flatnonzero(~taken)

    def _place(self, two: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (wordhash.mix(two + shift.astype(np.uint64) * _U(_ODD)) % _U(self.n)).astype(np.int64)

    def slots(self, keys: list[bytes]) -> np.ndarray:
        one, two = _hashes(keys)
        shift = self.shift[(one % _U(self.buckets)).astype(np.int64)]
        return np.where(shift < 0, -1 - shift, self._place(two, np.maximum(shift, 0)))


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a pre-token that is no vocabulary entry."""
    n = len(piece)
    ends = list(range(1, n + 1))  # of the part that begins at i; 0 once it is merged away
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        mid = ends[i]
        if not mid or mid >= n or ends[mid] != end:
            continue  # one of the parts has changed meanwhile
        ends[i], ends[mid] = end, 0
        if end < n:
            before[end] = i
            if (r := ranks.get(piece[i:ends[end]])) is not None:
                heapq.heappush(heap, (r, i, ends[end]))
        left = before[i]
        if left >= 0 and (r := ranks.get(piece[left:end])) is not None:
            heapq.heappush(heap, (r, left, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:ends[i]]])
        i = ends[i]
    return out


class Vocabulary:
    """Ranks with their perfect hash; small (a few MB), made once on the driver."""

    def __init__(self, ranks: dict[bytes, int]):
        self.keys = list(ranks)
        self.perfect = PerfectHash(self.keys)
        self.by_slot: list[bytes] = [b""] * len(self.keys)
        self.rank_of_slot = np.zeros(len(self.keys), np.int64)
        for key, slot in zip(self.keys, self.perfect.slots(self.keys).tolist()):
            self.by_slot[slot] = key
            self.rank_of_slot[slot] = ranks[key]
        size = max(ranks.values()) + 1
        of_rank = [b""] * size
        for key, rank in ranks.items():
            of_rank[rank] = key
        self.blob = np.frombuffer(b"".join(of_rank), np.uint8)
        self.lengths = np.fromiter(map(len, of_rank), np.int64, size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.ranks = ranks

    def resolve(self, pieces: list[str]) -> list[bytes]:
        keys = [p.encode() for p in pieces]
        slots = self.perfect.slots(keys)
        whole = self.rank_of_slot[slots].astype("<u4").tobytes()
        return [whole[4 * j:4 * j + 4] if self.by_slot[slot] == key
                else np.array(merge(key, self.ranks), "<u4").tobytes()
                for j, (key, slot) in enumerate(zip(keys, slots.tolist()))]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.blob, self.starts[ids], self.lengths[ids])


Batches = Iterator[pa.RecordBatch]


def _runs(column: pa.Array, size: int = wordhash.SEGMENT) -> Iterator[tuple[int, int]]:
    lengths = np.array(pa.compute.fill_null(pa.compute.binary_length(column), 0))
    yield from wordhash.slices(np.concatenate(([0], np.cumsum(lengths))), size)


def _encoded(vocabulary, pattern: str, text: int, drop_text: bool) -> Callable[[Batches], Batches]:
    """Appends ``ids`` to the columns and leaves out the text if told to."""
    def run(batches: Batches) -> Batches:
        words = vocabulary.value
        encoder = PieceEncoder(pattern, words.resolve)
        for batch in batches:
            for at, to in _runs(batch.column(text)):
                rows = batch.slice(at, to - at)
                ids = encoder.encode([t or "" for t in rows.column(text).to_pylist()])
                keep = [c for i, c in enumerate(rows.columns) if not (drop_text and i == text)]
                names = [c for i, c in enumerate(rows.schema.names) if not (drop_text and i == text)]
                yield pa.RecordBatch.from_arrays(
                    [*keep, pa.array([x.tobytes() for x in ids], pa.binary())], names=[*names, "ids"])
    return run


def _decoded(vocabulary, ids: int) -> Callable[[Batches], Batches]:
    """Appends ``decoded`` to the columns."""
    def run(batches: Batches) -> Batches:
        words = vocabulary.value
        for batch in batches:
            for at, to in _runs(batch.column(ids), 4 * wordhash.SEGMENT):
                rows = batch.slice(at, to - at)
                out = [None if x is None else words.decode(np.frombuffer(x, "<u4")).tobytes()
                       for x in rows.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(out, pa.binary())],
                                                 names=[*rows.schema.names, "decoded"])
    return run


def _shared(df: DataFrame, ranks: dict[bytes, int]):
    return df.sparkSession.sparkContext.broadcast(Vocabulary(ranks))


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids``: binary, unsigned 32-bit little-endian."""
    at = df.columns.index(text)
    schema = df.withColumn("ids", F.lit(b"")).schema
    return df.transform(arrow, _encoded(_shared(df, ranks), pattern, at, False), schema)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the bytes the ids stand for."""
    at = df.columns.index(ids)
    schema = df.withColumn("decoded", F.lit(b"")).schema
    return df.transform(arrow, _decoded(_shared(df, ranks), at), schema)


def round_trip(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """The columns but the text, then ``ids`` and ``decoded``: both steps in
    one pass, one Python worker a task."""
    at, shared = df.columns.index(text), _shared(df, ranks)
    rest = df.drop(text)
    first = _encoded(shared, pattern, at, True)
    then = _decoded(shared, len(rest.columns))
    schema = rest.withColumn("ids", F.lit(b"")).withColumn("decoded", F.lit(b"")).schema
    return df.transform(arrow, lambda batches: then(first(batches)), schema)
