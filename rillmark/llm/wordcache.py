"""Values that depend on a word alone, computed once per distinct word of a task."""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np

# distinct words remembered; beyond, the memory starts anew
WORDS = 300_000
# new words computed at once
BLOCK = 40_000


class WordValues:
    """``compute`` maps a list of distinct words to an array with one row each."""

    def __init__(
        self,
        compute: Callable[[list[bytes]], np.ndarray],
        most: int = WORDS,
        known: tuple[dict[bytes, int], np.ndarray] | None = None,
    ) -> None:
        """``known``: words whose rows need no computation, by place."""
        self.compute, self.known = compute, known
        self.most = most + (len(known[0]) if known else 0)
        self._begin()

    def _begin(self) -> None:
        self.place: dict[bytes, int] = dict(self.known[0]) if self.known else {}
        self.values: np.ndarray | None = self.known[1] if self.known and len(self.known[1]) else None
        self.used = len(self.place)

    def _add(self, words: list[bytes]) -> None:
        rows = self.compute(words)
        if self.values is None or self.used + len(rows) > len(self.values):
            room = np.zeros((max(1024, 2 * (self.used + len(rows))), *rows.shape[1:]), rows.dtype)
            if self.used:
                room[: self.used] = self.values[: self.used]
            self.values = room
        self.values[self.used : self.used + len(rows)] = rows
        self.place.update(zip(words, range(self.used, self.used + len(rows)), strict=True))
        self.used += len(rows)

    def of(self, tokens: list[bytes]) -> np.ndarray:
        """One row per token."""
        if self.used > self.most:
            self._begin()
        known = np.fromiter(map(self.place.get, tokens, repeat(-1)), np.int64, len(tokens))
        missing = np.flatnonzero(known < 0)
        if len(missing):
            fresh = list({tokens[i] for i in missing.tolist()})
            for at in range(0, len(fresh), BLOCK):
                self._add(fresh[at : at + BLOCK])
            known[missing] = [self.place[tokens[i]] for i in missing.tolist()]
        if self.values is None:
            return self.compute([])
        return self.values[known]


def laid_out(words: list[bytes], first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """All words in one array of bytes, each between the markers ``first`` and ``last``; and where each begins."""
    joined = b"".join(bytes((first,)) + w + bytes((last,)) for w in words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    return np.frombuffer(joined, np.uint8).astype(np.int64), np.cumsum(lengths) - lengths
