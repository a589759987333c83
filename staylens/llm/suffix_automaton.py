"""Runs of a sequence from a suffix automaton whose end positions are merged small to large.

The states of the automaton form a tree (suffix links); a state's end positions are those of its children and, but for clones,
its own. They are merged from the leaves up, the smaller set into the larger. Where a position comes to lie next to one of
another part at distance d, both prefixes have exactly length(state) letters in common at their ends, so d <= length(state)
is a square that ends there and begins length(state) before the smaller position; left of that the period breaks.

For a run with smallest period q the prefixes that end at its last letter and q before it meet in the state of length
(run's length - q) >= q, and no position between them is in that state (it would give the run a smaller period). So each run is
among the squares found, with its true start, and the farthest end of all squares of one start and distance is its end. A distance
that is a multiple of a smaller period gives the same start, no later end, and is dropped.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np

#: Positions of one block of a set.
BLOCK = 512


class Positions:
    """Distinct whole numbers in ascending order, in blocks, so that an insertion moves few of them."""

    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, first: int):
        self.blocks, self.firsts, self.size = [[first]], [first], 1

    def insert(self, x: int) -> tuple[int, int]:
        """Inserts x and returns its neighbours, -1 where there is none."""
        firsts, blocks = self.firsts, self.blocks
        k = bisect_left(firsts, x) - 1 if len(firsts) > 1 else 0
        if k < 0:
            k = 0
        block = blocks[k]
        i = bisect_left(block, x)
        before = block[i - 1] if i else -1  # the first block alone can be entered at its front
        after = block[i] if i < len(block) else (blocks[k + 1][0] if k + 1 < len(blocks) else -1)
        block.insert(i, x)
        if not i:
            firsts[k] = x
        if len(block) > BLOCK:
            half = len(block) // 2
            blocks.insert(k + 1, block[half:])
            firsts.insert(k + 1, block[half])
            del block[half:]
        self.size += 1
        return before, after

    def __iter__(self):
        for block in self.blocks:
            yield from block


def automaton(letters: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Lengths, suffix links and first end positions of the states; own ends are -1 for clones. State 0 is the empty one."""
    length, link, step, own = [0], [-1], [{}], [-1]
    last = 0
    for i, c in enumerate(letters):
        new = len(length)
        length.append(i + 1)
        link.append(0)
        step.append({})
        own.append(i)
        p = last
        while p != -1 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p != -1:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                step.append(step[q].copy())
                own.append(-1)
                while p != -1 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return length, link, own


def runs(letters: list[int], least: int = 2) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of each run of at least ``least`` letters and two periods, by start and period."""
    length, link, own = automaton(letters)
    sets: list = [None if e < 0 else Positions(e) for e in own]
    ends: dict[tuple[int, int], int] = {}

    def seed(before: int, after: int, common: int) -> None:
        d = after - before
        if d <= common:
            key = (before - common + 1, d)
            if ends.get(key, -1) < after:
                ends[key] = after

    for v in np.argsort(np.array(length), kind="stable")[:0:-1].tolist():
        mine, up = sets[v], link[v]
        if not up:
            sets[v] = None  # the empty state has no squares
            continue
        theirs, common = sets[up], length[up]
        if theirs is None:
            sets[up] = mine
        else:
            small, large = (mine, theirs) if mine.size < theirs.size else (theirs, mine)
            last = -1  # positions come in ascending order, so only the one before can be of x's own part
            for x in small:
                before, after = large.insert(x)
                if before != last:
                    seed(before, x, common)
                if after >= 0:
                    seed(x, after, common)
                last = x
            sets[up] = large
        sets[v] = None
    by_start: dict[int, list[tuple[int, int]]] = {}
    for (start, d), end in ends.items():
        by_start.setdefault(start, []).append((d, end))
    found = []
    for start, group in by_start.items():
        kept: list[tuple[int, int]] = []
        for d, end in sorted(group):
            if not any(d % q == 0 and end <= e for q, e in kept):
                kept.append((d, end))
                if end - start + 1 >= least:
                    found.append((start, end - start + 1, d))
    return sorted(found, key=lambda r: (r[0], r[2]))
