"""An FM-index over the words of one shard, in numpy.

Symbols: 0 separates (document ends and words that no phrase holds), 1 ... n are phrase words.
Every separator counts as smaller than all words and as different from every other separator, so a
suffix never has to be compared beyond its own run of phrase words.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by prefix doubling; only suffixes still tied are sorted again."""
    n = len(symbols)
    breaks = symbols == 0
    n_breaks = int(breaks.sum())
    rank = symbols.astype(np.int64) + (n_breaks - 1)
    rank[breaks] = np.arange(n_breaks)
    width = max(1, int(rank.max(initial=0) + 1).bit_length())
    step = max(1, min(4, 62 // width))
    padded = np.concatenate([rank + 1, np.zeros(step, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(step):
        key = (key << (width if i else 0)) | padded[i : i + n]
    order = np.argsort(key)
    sorted_key = key[order]
    starts = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]) if n else np.zeros(0, bool)
    # rank of a suffix: the place where its group of ties begins
    heads = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = heads
    tied = ~starts | np.concatenate([~starts[1:], [False]])
    places = np.flatnonzero(tied)
    while len(places):
        suffixes = order[places]
        ahead = suffixes + step
        follow = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        again = np.lexsort((follow, rank[suffixes])) if n > 1 << 31 else np.argsort((rank[suffixes] << 32) | (follow + 1))
        suffixes, follow = suffixes[again], follow[again]
        group = rank[suffixes]
        order[places] = suffixes
        fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])])
        heads = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
        rank[suffixes] = places[heads]
        still = ~fresh | np.concatenate([~fresh[1:], [False]])
        places = places[still]
        step *= 2
    return order


class Wavelet:
    """Wavelet matrix with prefix counts: rank and access in one step per bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, alphabet: int) -> None:
        self.bits = max(1, (alphabet - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        now = symbols.astype(np.int32)
        for level in range(self.bits - 1, -1, -1):
            bit = (now >> level) & 1
            self.ones.append(np.concatenate([np.zeros(1, np.int32), np.cumsum(bit, dtype=np.int32)]))
            high = bit.astype(bool)
            self.zeros.append(int(len(now) - self.ones[-1][-1]))
            now = np.concatenate([now[~high], now[high]])

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        low = np.zeros_like(upto)
        for i, level in enumerate(range(self.bits - 1, -1, -1)):
            set_ = ((symbol >> level) & 1).astype(bool)
            ones, zeros = self.ones[i], self.zeros[i]
            a, b = ones[low], ones[upto]
            low = np.where(set_, zeros + a, low - a)
            upto = np.where(set_, zeros + b, upto - b)
        return upto - low

    def access_rank(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it occurs before."""
        symbol, low, at = np.zeros_like(place), np.zeros_like(place), place
        for i in range(self.bits):
            ones, zeros = self.ones[i], self.zeros[i]
            a, b = ones[low], ones[at]
            set_ = (ones[at + 1] - b).astype(bool)
            symbol = (symbol << 1) | set_
            low = np.where(set_, zeros + a, low - a)
            at = np.where(set_, zeros + b, at - b)
        return symbol, at - low


class FMIndex:
    def __init__(self, symbols: np.ndarray, alphabet: int) -> None:
        """``symbols`` end with a separator; ``alphabet`` is the number of symbols with the separator."""
        order = suffix_array(symbols)
        before = np.concatenate([symbols[-1:], symbols[:-1]])
        self.wavelet = Wavelet(before[order], alphabet)
        counts = np.bincount(symbols, minlength=alphabet)
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.size = len(symbols)
        # sampled suffix positions: every SAMPLEth place of the text, and every start of a run
        marked = (order % SAMPLE == 0) | (before[order] == 0)
        self.marks = np.concatenate([np.zeros(1, np.int32), np.cumsum(marked, dtype=np.int32)])
        self.positions = order[marked]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of equally long phrases (one per row): the range of suffixes each begins."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        live = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[live, column]
            low[live] = self.first[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.wavelet.rank(symbol, high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: walk back to the nearest sampled one."""
        found = np.empty(len(rows), np.int64)
        open_, at, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(open_):
            sampled = self.marks[at + 1] > self.marks[at]
            found[open_[sampled]] = self.positions[self.marks[at[sampled]]] + steps
            open_, at = open_[~sampled], at[~sampled]
            symbol, earlier = self.wavelet.access_rank(at)
            at = self.first[symbol] + earlier
            steps += 1
        return found
