"""Pre-tokens of whole texts, resolved once per distinct pre-token."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import regex

# Pre-tokens worked on at once, and resolved pre-tokens a worker remembers.
# Both bound memory only; the result is the same for any value.
CHUNK = 200_000
REMEMBER = 400_000

Resolve = Callable[[list[str]], list[bytes]]


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``values[start:start + length]`` one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class PieceEncoder:
    """Ids (unsigned 32-bit) of texts whose pre-tokens encode independently.
    ``resolve`` gives the ids of unknown pre-tokens as little-endian bytes."""

    def __init__(self, pattern: str, resolve: Resolve):
        self.pattern = regex.compile(pattern)
        self.resolve = resolve
        self.known: dict[str, bytes] = {}

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, number of ids of each piece)."""
        codes, own = pd.factorize(np.array(pieces, dtype=object))
        own = own.tolist()
        new = [p for p in own if p not in self.known]
        if len(self.known) + len(new) > REMEMBER:
            self.known = {p: self.known[p] for p in own if p in self.known}
        if new:
            self.known.update(zip(new, self.resolve(new)))
        found = [self.known[p] for p in own]
        values = np.frombuffer(b"".join(found), "<u4")
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(lengths) - lengths
        return gather(values, starts[codes], lengths[codes]), lengths[codes]

    def _chunks(self, texts: list[str]) -> Iterator[tuple[list[int], list[int], list[str]]]:
        """(texts, number of pieces of each, their pieces): chunks of about
        ``CHUNK`` pieces; a long text goes over several."""
        at: list[int] = []
        counts: list[int] = []
        pieces: list[str] = []
        for i, text in enumerate(texts):
            matches = iter(self.pattern.findall(text)) if len(text) <= CHUNK \
                else (m.group() for m in self.pattern.finditer(text))
            while some := list(islice(matches, CHUNK)):
                at.append(i)
                counts.append(len(some))
                pieces += some
                if len(pieces) >= CHUNK:
                    yield at, counts, pieces
                    at, counts, pieces = [], [], []
        if pieces:
            yield at, counts, pieces

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for at, counts, pieces in self._chunks(texts):
            ids, lengths = self._ids(pieces)
            place = np.concatenate(([0], np.cumsum(lengths)))
            end = 0
            for i, n in zip(at, counts):
                parts[i].append(ids[place[end]:place[end + n]])
                end += n
        return [np.concatenate(p) if p else np.zeros(0, "<u4") for p in parts]
