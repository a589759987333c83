"""BagMinHash signatures of weighted sets in numpy.

An element of weight w owns Poisson processes over the discretised weights: one on [0, 1) and one on each
[2^(j-1), 2^j), each with a seed of its own and a rate of its width. A point has a time, a register and, within a wider
interval, a place found by halving; it counts where its place lies below w. A register keeps the least time. Two sets
agree in a register with the probability of their weighted Jaccard similarity. Points are drawn in order of time and a
process stops once it is later than the largest register, so heavy elements cost the log of their weight.
"""

from __future__ import annotations

import numpy as np

from staylens.llm.words import mix

_CELLS = 300_000
#: Upper key bits for the number of the set in its slice; an element keeps the other bits, the same in any slice.
_SET_BITS = np.uint64(20)


def weigh(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each set with their counts: (set, element, count), ordered by set."""
    n = np.diff(bounds)
    bits = _SET_BITS
    owner = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    key = np.sort((owner << (np.uint64(64) - bits)) | (hashes >> bits))
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(first)
    key = key[at]
    return (key >> (np.uint64(64) - bits)).astype(np.int64), key << bits, np.diff(np.append(at, len(first)))


def signatures(sets: int, owner: np.ndarray, element: np.ndarray, weight: np.ndarray, m: int) -> np.ndarray:
    """sets x m registers as uint64 bits of the least times; an empty set's are all infinite."""
    registers = np.full(sets * m, np.inf)
    level = np.zeros(len(owner), np.int64)
    who = np.arange(len(owner))
    seeds, lows, widths, owners, weights = [], [], [], [], []
    while len(who):  # one process for each interval that begins below the weight
        low = np.where(level[who] > 0, 1 << np.maximum(level[who] - 1, 0), 0)
        keep = low < weight[who]
        who, low = who[keep], low[keep]
        seeds.append(mix(element[who] ^ mix(level[who].astype(np.uint64) + np.uint64(0x51))))
        lows.append(low)
        widths.append(np.maximum(low, 1))
        owners.append(owner[who])
        weights.append(weight[who])
        level[who] += 1
    seed, low, width, own, w = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (seeds, lows, widths, owners, weights))
    time = np.zeros(len(seed))
    drawn, block = 0, 1
    while len(seed):
        block = max(1, min(block, _CELLS // len(seed)))
        step = np.arange(drawn, drawn + block, dtype=np.uint64)
        noise = mix(seed[:, None].astype(np.uint64) + (step + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        gap = -np.log(((noise >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / width[:, None]
        times = np.cumsum(np.concatenate([time[:, None], gap], axis=1), axis=1)[:, 1:]
        more = mix(noise ^ np.uint64(0xD6E8FEB86659FD93))
        register = (more & np.uint64(0xFFFFFFFF)) % np.uint64(m)
        place = low[:, None] + ((more >> np.uint64(32)).astype(np.int64) & (width[:, None] - 1))
        counts = place < w[:, None]
        np.minimum.at(registers, (own[:, None] * m + register.astype(np.int64))[counts], times[counts])
        time = times[:, -1]
        latest = registers.reshape(sets, m).max(axis=1)
        go = time < latest[own]
        seed, low, width, own, w, time = (x[go] for x in (seed, low, width, own, w, time))
        drawn += block
        block = min(64, block * 2)
    return registers.view(np.uint64).reshape(sets, m)


def band_keys(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key for each band of rows registers; keys of different bands differ."""
    keys = np.zeros((len(registers), bands), np.uint64)
    keys[:] = mix(np.arange(bands, dtype=np.uint64) + np.uint64(0xB5))
    for r in range(rows):
        keys = mix(keys ^ registers[:, r : bands * rows : rows])
    return keys


def sketches(registers: np.ndarray) -> np.ndarray:
    """Four bits of each register, 16 registers to a word. They agree with probability J + (1 - J) / 16."""
    nibbles = (mix(registers) & np.uint64(15)).astype(np.uint8)
    return (nibbles[:, ::2] | (nibbles[:, 1::2] << 4)).view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two multisets given as arrays with repeats; of two empty ones 0."""
    if not len(a) or not len(b):
        return 0.0
    both, sizes = np.concatenate([np.sort(a), np.sort(b)]), (len(a), len(b))
    values, which = np.unique(both, return_inverse=True)
    in_a = np.bincount(which[: sizes[0]], minlength=len(values))
    in_b = np.bincount(which[sizes[0] :], minlength=len(values))
    return float(np.minimum(in_a, in_b).sum() / np.maximum(in_a, in_b).sum())
