"""Vectorised words and word shingles of whole UTF-8 texts (numpy over Arrow).

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased (unless ``fold`` is off).  A word is hashed
to 64 bits from prefix sums of a polynomial over its bytes, a shingle from
the hashes of its words; no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes worked on at once.  A longer text is cut at white space, so memory
# beyond 8 bytes a word does not grow with it.
SEGMENT = 1 << 20

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2 ** 63, 256, dtype=np.uint64) | _U(1)
_BASE = 0x9E3779B97F4A7C15
_STEP = _U(0xD6E8FEB86659FD93)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_EXACT = _BYTE.copy()  # of texts whose case counts
for _c in range(65, 91):
    _BYTE[_c] = _BYTE[_c + 32]
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for i < n."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SEGMENT + 1)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 2 ** 64))):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _powers[key] = np.cumprod(row, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


class Windows:
    """128-bit hashes of any runs of words of a sequence of word hashes."""

    def __init__(self, words: np.ndarray):
        up, self._down = _power(len(words) + 1)
        self._sums = []
        for own in (words, mix(words ^ _STEP)):
            total = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(own * up[:len(words)], out=total[1:])
            self._sums.append(total)

    def of(self, starts: np.ndarray, length: int, half: int) -> np.ndarray:
        """Half 0 or 1 of the hashes of the runs of ``length`` words at ``starts``."""
        total = self._sums[half]
        return mix((total[starts + length] - total[starts]) * self._down[starts] + _U(length))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1] or bytes(8), kind)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[offsets[0]:offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def _segment_words(data: np.ndarray, starts: np.ndarray, letters: np.ndarray = _BYTE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of one segment; ``starts`` are the
    places where a text begins, which end a word too."""
    n = len(data)
    inside = ~_WHITE[data]
    cut = np.zeros(n + 1, bool)
    cut[starts] = True
    cut[0] = cut[n] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:n]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _power(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(letters[data] * up[:n], out=total[1:])
    return mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * _STEP), s


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets into them per text)."""
    hashes, first, at, n = [], [], 0, len(data)
    while at < n:
        end = min(n, at + SEGMENT)
        if end < n:  # go on to where a word ends
            k = int(np.searchsorted(offsets, end))
            stop = int(offsets[k])
            while end < stop and not _WHITE[data[end]]:
                step = np.flatnonzero(_WHITE[data[end:min(stop, end + SEGMENT)]])
                end = end + int(step[0]) if len(step) else min(stop, end + SEGMENT)
        inside = offsets[(offsets >= at) & (offsets < end)] - at
        h, s = _segment_words(data[at:end], inside, _BYTE if fold else _EXACT)
        hashes.append(h)
        first.append(s + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(first), offsets)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of every text in order, repeats
    included, and offsets into them per text.  A text of fewer than ``k``
    words has its whole sequence as one; one without words has none."""
    counts = np.diff(bounds)
    sizes = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out_at = np.concatenate(([0], np.cumsum(sizes)))
    out = np.zeros(int(out_at[-1]), np.uint64)
    m = len(words) - k + 1
    if m > 0:
        every = np.zeros(m, np.uint64)
        for j in range(k):
            every = every * _STEP + words[j:j + m]
        whole = np.repeat(counts >= k, sizes)
        place = np.repeat(bounds[:-1] - out_at[:-1], sizes) + np.arange(len(out))
        out[whole] = mix(every[place[whole]] + _U(k))
    for n in range(1, k):
        at = np.flatnonzero(counts == n)
        if len(at):
            h = np.zeros(len(at), np.uint64)
            for j in range(n):
                h = h * _STEP + words[bounds[at] + j]
            out[out_at[at]] = mix(h + _U(n))
    return out, out_at


def slices(offsets: np.ndarray, size: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``size`` bytes, at least one text each."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to
        at = to


def shingled(texts: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end text, shingle hashes, offsets) run by run."""
    data, offsets = text_buffers(texts)
    for at, to in slices(offsets):
        part = data[offsets[at]:offsets[to]]
        words, bounds = word_hashes(part, offsets[at:to + 1] - offsets[at])
        yield at, to, *shingle_hashes(words, bounds, k)


def long_array(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64())


def long_lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), long_array(values))
