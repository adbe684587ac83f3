"""Ids of words already encoded, in flat arrays, for gathering whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class WordCache:
    """Word to ids; ``encode(words)`` gives the ids of new words, one after the
    other, and the number of each. Beyond ``most`` words it starts anew."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int):
        self.encode, self.most = encode, most
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.off, self.len, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def places(self, words: Iterable[str]) -> None:
        """Encodes the words that are new."""
        if len(self.place) > self.most:
            self._forget()
        new = list(set(words).difference(self.place))
        if new:
            ids, n = self.encode(new)
            off = len(self.flat) + np.cumsum(n) - n
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.off, self.len, self.flat = (
                np.concatenate(x) for x in ((self.off, off), (self.len, n), (self.flat, ids.astype(np.int32)))
            )

    def texts(self, cut: list[list[str]], before: int = 0, after: int = 0) -> list[np.ndarray]:
        """The ids of each list of words, with room of that size at its ends."""
        self.places(chain.from_iterable(cut))
        w = np.fromiter(map(self.place.__getitem__, chain.from_iterable(cut)), np.int64, sum(map(len, cut)))
        return self._gather(w, np.cumsum([0] + [len(c) for c in cut]), before, after)

    def split_texts(self, texts: list[str], before: int = 0, after: int = 0) -> list[np.ndarray]:
        """The same for texts whose words stand between ASCII white space."""
        parts = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = parts.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        self.places(words)
        own = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        return self._gather(own[coded.indices.to_numpy(zero_copy_only=False)], parts.offsets.to_numpy(), before, after)

    def _gather(self, w: np.ndarray, cuts: np.ndarray, before: int, after: int) -> list[np.ndarray]:
        n = self.len[w]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.repeat(self.off[w] - ends[:-1], n) + np.arange(ends[-1])]
        bounds = ends[cuts].tolist()
        out = []
        for a, b in zip(bounds, bounds[1:], strict=False):
            one = np.empty(b - a + before + after, np.int32)
            one[before : before + b - a] = ids[a:b]
            out.append(one)
        return out
