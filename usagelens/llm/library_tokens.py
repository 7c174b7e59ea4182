"""Ids by the tokenizers library, each distinct unit of text encoded once.

A byte-level model whose pattern takes one space with the word that follows
encodes what lies between two such spaces independently: a unit is a space
with the text up to the next one.  Units are told apart by two 64-bit hashes
worked out over all bytes at once, looked up in a table of those a worker
has met, and only new ones go to the library.  A text in which a space
stands next to other white space, or any white space beyond ASCII occurs, is
encoded whole, and so is one that holds the string of a special token, which
the library makes that token's id unless it is told to read it as text
(``ordinary``).  The tests hold the result against the library on whole texts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa

from usagelens.llm import wordhash
from usagelens.llm.pieces import gather

_U = np.uint64
# Units a worker remembers (some 80 MB); when they are met it starts anew.
REMEMBER = 1 << 20
_rng = np.random.Generator(np.random.PCG64(99))
_TABLES = [(_rng.integers(1, 2 ** 63, 256, dtype=np.uint64) | _U(1), base | 1)
           for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
_powers: list[tuple[np.ndarray, np.ndarray]] = []
# ASCII white space, and the other control characters some call white space
_GAP = np.zeros(256, bool)
_GAP[:0x21] = True
#: The UTF-8 bytes of the white space beyond ASCII.
_WIDE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2(?:\x80[\x80-\x8a\xa8\xa9\xaf]|\x81\x9f)|\xe3\x80\x80")
JOINED = 200  # new units that go to the library as one text
AT_ONCE = 32  # texts the library is given at once, as it keeps much about each


def _hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(data)
    if not _powers or len(_powers[0][0]) <= n:
        size = max(n, wordhash.SEGMENT) + 1
        _powers[:] = []
        for _, base in _TABLES:
            rows = [np.full(size, b, np.uint64) for b in (base, pow(base, -1, 2 ** 64))]
            for row in rows:
                row[0] = 1
            _powers.append((np.cumprod(rows[0], dtype=np.uint64), np.cumprod(rows[1], dtype=np.uint64)))
    out = []
    for (table, _), (up, down) in zip(_TABLES, _powers):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(table[data] * up[:n], out=total[1:])
        out.append(wordhash.mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)))
    return out[0] | _U(1), out[1]  # 0 marks an empty place of the table


class _Known:
    """Open-addressing table from hashes to the ids of a unit."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.n, self.ids_n = 0, 0
        self.ids = np.zeros(1 << 16, np.uint32)
        self.two, self.start, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self._resize(1 << 15)

    def _resize(self, entries: int) -> None:
        """Room for so many entries, in a table twice as large."""
        for name in ("two", "start", "length"):
            old = getattr(self, name)
            new = np.zeros(entries, old.dtype)
            new[:len(old)] = old
            setattr(self, name, new)
        key, at = getattr(self, "key", None), getattr(self, "at", None)
        self.key, self.at = np.zeros(2 * entries, np.uint64), np.zeros(2 * entries, np.int32)
        if self.n:
            used = np.flatnonzero(key)
            self._place(key[used], at[used])

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Entry of each unit, -1 if unknown, -2 if another unit has its first hash."""
        mask = _U(len(self.key) - 1)
        place, out, left = one & mask, np.full(len(one), -1, np.int64), np.arange(len(one))
        while len(left):
            key = self.key[place[left]]
            hit = key == one[left]
            out[left[hit]] = self.at[place[left[hit]]]
            left = left[~hit & (key != 0)]
            place[left] = (place[left] + _U(1)) & mask
        clash = (out >= 0) & (self.two[np.maximum(out, 0)] != two)
        out[clash] = -2
        return out

    def _place(self, one: np.ndarray, entry: np.ndarray) -> None:
        mask = _U(len(self.key) - 1)
        place, left = one & mask, np.arange(len(one))
        while len(left):
            free = left[self.key[place[left]] == 0]
            self.key[place[free]] = one[free]
            won = free[self.key[place[free]] == one[free]]
            self.at[place[won]] = entry[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            place[left] = (place[left] + _U(1)) & mask

    def full(self, more: int) -> bool:
        return self.n > 0 and self.n + more > REMEMBER

    def add(self, one: np.ndarray, two: np.ndarray, ids: np.ndarray, length: np.ndarray) -> None:
        """Units that are not known, each once."""
        n, size = self.n + len(one), len(self.two)
        while size < n:
            size *= 2
        if size > len(self.two):
            self._resize(size)
        room = len(self.ids)
        while self.ids_n + len(ids) > room:
            room *= 2
        if room > len(self.ids):
            grown = np.zeros(room, np.uint32)
            grown[:self.ids_n] = self.ids[:self.ids_n]
            self.ids = grown
        new = slice(self.n, n)
        self.two[new], self.length[new] = two, length
        self.start[new] = self.ids_n + np.cumsum(length) - length
        self.ids[self.ids_n:self.ids_n + len(ids)] = ids
        self.ids_n += len(ids)
        self._place(one, np.arange(self.n, n, dtype=np.int32))
        self.n = n


class Library:
    """The tokenizers library with the byte-level model of a file.  With
    ``ordinary``, strings of special tokens are text like any other."""

    def __init__(self, path: str, ordinary: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        added = [re.escape(t.content.encode()) for t in self.model.get_added_tokens_decoder().values() if t.content]
        if ordinary:
            self.model.encode_special_tokens = True
        self.special = re.compile(b"|".join(added)) if added and not ordinary else None
        vocabulary = self.model.get_vocab(with_added_tokens=False)
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # a character a byte
        self.bytes[list(vocabulary.values())] = list(map(len, vocabulary))

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        some = (texts[i:i + AT_ONCE] for i in range(0, len(texts), AT_ONCE))
        return [np.array(e.ids, np.uint32) for part in some
                for e in self.model.encode_batch_fast(part, add_special_tokens=False)]

    def units(self, units: list[bytes], special: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, number of ids of each); ``special`` says that some
        may hold strings of special tokens.  Units of a space and a
        word follow each other in one text, which encodes to theirs in a row;
        the bytes of the ids tell where each ends."""
        joins = np.fromiter((len(u) > 1 and u[0] == 0x20 and not _GAP[u[-1]]
                             and not (special and self.special.search(u)) for u in units), bool, len(units))
        order = np.concatenate((np.flatnonzero(joins), np.flatnonzero(~joins)))
        row, alone = [units[i] for i in order[:joins.sum()]], [units[i] for i in order[joins.sum():]]
        texts = [b"".join(row[i:i + JOINED]).decode() for i in range(0, len(row), JOINED)]
        ids = np.concatenate([np.zeros(0, np.uint32), *self.whole(texts)])
        ends = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum(np.fromiter(map(len, row), np.int64, len(row)))) + 1
        single = self.whole([u.decode() for u in alone])
        ids = np.concatenate([ids, *single])
        length = np.concatenate((np.diff(ends, prepend=0), np.array([len(x) for x in single], np.int64)))
        starts = np.cumsum(length) - length
        back = np.empty(len(units), np.int64)
        back[order] = np.arange(len(units))
        return gather(ids, starts[back], length[back]), length[back]


class UnitEncoder:
    """Ids (unsigned 32-bit) of texts."""

    def __init__(self, library: Library):
        self.library, self.known = library, _Known()

    def _units(self, data: np.ndarray, starts: np.ndarray, special: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ids of each unit, first byte of each unit) of one segment;
        an unknown-to-be clash of hashes gives -1 ids."""
        begin = data == 0x20
        begin[starts[starts < len(data)]] = True
        s = np.flatnonzero(begin)
        e = np.append(s[1:], len(data))
        one, two = _hashes(data, s, e)
        codes, own = pd.factorize(one)
        first = np.zeros(len(own), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        entry = self.known.find(own, two[first])
        new = np.flatnonzero(entry == -1)
        if len(new):
            raw = data.tobytes()
            if self.known.full(len(new)):
                self.known.clear()
                entry[:], new = -1, np.arange(len(own))
            found = self.library.units([raw[a:b] for a, b in zip(s[first[new]].tolist(), e[first[new]].tolist())],
                                       special)
            self.known.add(own[new], two[first[new]], *found)
            entry[new] = np.arange(self.known.n - len(new), self.known.n)
        of = entry[codes]
        same = (of >= 0) & (two == two[first][codes])
        length = np.where(same, self.known.length[np.maximum(of, 0)], 0)
        ids = gather(self.known.ids, self.known.start[np.maximum(of, 0)], length)
        return ids, np.where(same, length, -1), s

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null is empty."""
        data, offsets = wordhash.text_buffers(texts)
        whole = self._whole(data, offsets)
        special = False
        if self.library.special:
            found = [m.start() for m in self.library.special.finditer(data.tobytes())]
            whole[np.searchsorted(offsets, found, "right") - 1] = True
            special = bool(found)
        parts: list[list[np.ndarray]] = [[] for _ in range(len(texts))]
        at = 0
        while at < len(data):
            end = min(len(data), at + wordhash.SEGMENT)
            if end < len(data):  # go on to where a unit begins
                stop = int(offsets[np.searchsorted(offsets, end)])
                while end < stop and data[end] != 0x20:
                    step = np.flatnonzero(data[end:min(stop, end + wordhash.SEGMENT)] == 0x20)
                    end = end + int(step[0]) if len(step) else min(stop, end + wordhash.SEGMENT)
            lo, hi = np.searchsorted(offsets, [at, end], "right") - [1, 0]
            lo, hi = int(lo), int(min(hi, len(texts)))
            starts = np.clip(offsets[lo:hi + 1] - at, 0, end - at)
            if not whole[lo:hi].all():
                ids, length, s = self._units(data[at:end], starts[:-1], special)
                ends = np.concatenate(([0], np.cumsum(np.maximum(length, 0))))
                bounds = np.searchsorted(s, starts)
                for i in range(lo, hi):
                    a, b = bounds[i - lo], bounds[i - lo + 1]
                    if (length[a:b] < 0).any():
                        whole[i] = True
                    parts[i].append(ids[ends[a]:ends[b]])
            at = end
        out = [np.concatenate(p) if p else np.zeros(0, np.uint32) for p in parts]
        odd = np.flatnonzero(whole).tolist()
        for i, ids in zip(odd, self.library.whole([data[offsets[i]:offsets[i + 1]].tobytes().decode() for i in odd])):
            out[i] = ids
        return out

    @staticmethod
    def _whole(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts that have to be encoded whole."""
        gap = _GAP[data]
        pair = gap[1:] & gap[:-1] & ((data[1:] == 0x20) | (data[:-1] == 0x20))
        places = np.flatnonzero(pair)
        if (data >= 0x80).any():
            wide = np.array([m.start() for m in _WIDE.finditer(data.tobytes())], np.int64)
            places = np.concatenate((places, wide))
        out = np.zeros(len(offsets) - 1, bool)
        out[np.searchsorted(offsets, places, "right") - 1] = True
        return out


_ENCODERS: dict[tuple[str, bool], UnitEncoder] = {}  # of this Python worker


def encoder(path: str, ordinary: bool = False) -> UnitEncoder:
    """Reads the tokenizer file once a Python worker."""
    if (path, ordinary) not in _ENCODERS:
        _ENCODERS[path, ordinary] = UnitEncoder(Library(path, ordinary))
    return _ENCODERS[path, ordinary]


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
