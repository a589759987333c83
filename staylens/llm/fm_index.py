"""A word-level FM-index in numpy: suffix order, Burrows-Wheeler transform, wavelet ranks, sampled positions."""

from __future__ import annotations

import numpy as np

#: Every so many text positions keeps its place; the others are found by at most so many steps back.
SAMPLE_EVERY = 8


def suffix_order(text: np.ndarray, symbols: int) -> np.ndarray:
    """Positions of text in suffix order. Symbol 0 separates: each 0 differs from all others and sorts by its place,
    so comparing stops there and copies of long texts cost no more rounds than their longest run without a 0."""
    n = len(text)
    bits = max(1, int(symbols).bit_length())
    width = max(1, 62 // bits)
    ends = np.flatnonzero(text == 0)
    place = np.append(ends, n)
    stop = place[np.searchsorted(ends, np.arange(n))] if n else place  # next separator at or after each position
    room = np.minimum(stop - np.arange(n), width)
    key = np.zeros(n, np.int64)
    padded = np.concatenate([text.astype(np.int64), np.zeros(width, np.int64)])
    for j in range(width):
        key = (key << bits) | np.where(j < room, padded[j : j + n], 0)
    order = np.argsort(key, kind="stable")
    changed = np.empty(n, np.int64)
    depth = width
    sorted_key = key[order]
    changed[:1], changed[1:] = 0, sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = _first_rows(np.cumsum(changed))
    while len(at := np.flatnonzero(_tied(rank[order]))):  # only suffixes that are not yet alone in their rank
        who = order[at]
        ahead = np.minimum(who + depth, n - 1)
        second = np.where(stop[who] < who + depth, stop[who], n + 1 + rank[ahead])
        by = np.lexsort((second, rank[who]))
        who, second, first = who[by], second[by], rank[who[by]]
        order[at] = who
        step = np.empty(len(who), bool)
        step[:1], step[1:] = True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        # A rank is the number of its first row, so ranks of untouched suffixes stay as they are.
        head = at[np.maximum.accumulate(np.where(step, np.arange(len(who)), 0))]
        rank[who] = head
        depth *= 2
    return order


def _tied(sorted_rank: np.ndarray) -> np.ndarray:
    same = sorted_rank[1:] == sorted_rank[:-1]
    out = np.zeros(len(sorted_rank), bool)
    out[1:] |= same
    out[:-1] |= same
    return out


def _first_rows(sorted_rank: np.ndarray) -> np.ndarray:
    step = np.empty(len(sorted_rank), bool)
    step[:1], step[1:] = True, sorted_rank[1:] != sorted_rank[:-1]
    return np.maximum.accumulate(np.where(step, np.arange(len(sorted_rank)), 0))


class BitRank:
    """Ones before a position of a bit row, by 64-bit words and their running counts."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def bit(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class Wavelet:
    """A wavelet matrix: ranks of a symbol, and symbols with their ranks, for many positions at once."""

    def __init__(self, row: np.ndarray, symbols: int):
        self.levels: list[tuple[int, BitRank, int]] = []
        for shift in range(max(1, int(symbols).bit_length()) - 1, -1, -1):
            bits = ((row >> shift) & 1).astype(bool)
            self.levels.append((shift, BitRank(bits), int(len(bits) - bits.sum())))
            row = np.concatenate([row[~bits], row[bits]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbol[k] before position i[k]."""
        start = np.zeros_like(i)
        for shift, ranks, zeros in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            a, b = ranks.ones(start), ranks.ones(i)
            start = np.where(one, zeros + a, start - a)
            i = np.where(one, zeros + b, i - b)
        return i - start

    def symbol_and_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and its occurrences before."""
        symbol = np.zeros_like(i)
        start = np.zeros_like(i)
        for _, ranks, zeros in self.levels:
            one = ranks.bit(i).astype(bool)
            a, b = ranks.ones(start), ranks.ones(i)
            start = np.where(one, zeros + a, start - a)
            i = np.where(one, zeros + b, i - b)
            symbol = (symbol << 1) | one
        return symbol, i - start


class FMIndex:
    """Index of one shard of symbols; 0 is the separator and in no pattern. The text has to end in 0."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_order(text, symbols)
        self.n = len(text)
        self.wavelet = Wavelet(text[order - 1].astype(np.int64), symbols)
        counts = np.bincount(text, minlength=symbols + 2)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        kept = (order % SAMPLE_EVERY == 0) | (text[order - 1] == 0)
        self.sampled = BitRank(kept)
        self.places = order[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of right-aligned patterns (len(lengths) x longest), all searched backward together."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.n, np.int64)
        for back in range(1, patterns.shape[1] + 1):
            at = np.flatnonzero((lengths >= back) & (low < high))
            if not len(at):
                break
            c = patterns[at, -back]
            low[at] = self.first[c] + self.wavelet.rank(c, low[at])
            high[at] = self.first[c] + self.wavelet.rank(c, high[at])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: steps back to a sampled one."""
        out = np.empty(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            done = self.sampled.bit(at).astype(bool)
            out[todo[done]] = self.places[self.sampled.ones(at[done])] + steps
            todo, at, steps = todo[~done], at[~done], steps + 1
            if len(todo):
                c, rank = self.wavelet.symbol_and_rank(at)
                at = self.first[c] + rank
        return out
