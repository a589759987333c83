"""Collinear chains of word anchors and their alignment."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Score of an anchor and cost of each word that lies between two anchors, on either side.
ANCHOR_SCORE = 12.0
GAP_COST = 0.15
#: Skips (words of a, words of b) that an extension tries at a mismatch, and the words that have to agree after one.
SKIPS = ((1, 1), (1, 0), (0, 1), (2, 2), (2, 1), (1, 2), (3, 3))
AGREE = 4
#: Words up to which an extension is tried on lists.
SHORT = 256


class Passage(NamedTuple):
    """Words start:stop of a against other_start:other_stop of b, and how many of them agree."""

    start: int
    stop: int
    other_start: int
    other_stop: int
    matched: int

    @property
    def identity(self) -> float:
        return self.matched / max(1, self.stop - self.start, self.other_stop - self.other_start)


class Fenwick:
    """Greatest value over a prefix of places, with the item that gave it."""

    def __init__(self, n: int):
        self.value = [float("-inf")] * (n + 1)
        self.item = [-1] * (n + 1)

    def put(self, place: int, value: float, item: int) -> None:
        i = place + 1
        while i < len(self.value):
            if value > self.value[i]:
                self.value[i], self.item[i] = value, item
            i += i & -i

    def best_before(self, place: int) -> tuple[float, int]:
        best, item, i = float("-inf"), -1, place
        while i > 0:
            if self.value[i] > best:
                best, item = self.value[i], self.item[i]
            i -= i & -i
        return best, item


def chains(anchors: list[tuple[int, int]], score: float = ANCHOR_SCORE, gap: float = GAP_COST) -> list[list[tuple[int, int]]]:
    """Disjoint chains, rising in both coordinates, the best first.

    The cost of a gap is linear in both coordinates, so the best predecessor is the greatest of f(i) + gap (x_i + y_i) over
    the anchors below and left: a prefix maximum over the ranks of y while x is swept.
    """
    points = sorted(set(anchors))
    ranks = {y: r for r, y in enumerate(sorted({y for _, y in points}))}
    tree = Fenwick(len(ranks))
    f, before = [0.0] * len(points), [-1] * len(points)
    at = 0
    while at < len(points):
        to = at
        while to < len(points) and points[to][0] == points[at][0]:
            x, y = points[to]
            best, item = tree.best_before(ranks[y])
            gain = best - gap * (x + y)
            f[to], before[to] = (score + gain, item) if gain > 0 else (score, -1)
            to += 1
        for i in range(at, to):
            x, y = points[i]
            tree.put(ranks[y], f[i] + gap * (x + y), i)
        at = to
    used = [False] * len(points)
    out = []
    for i in sorted(range(len(points)), key=lambda i: (-f[i], i)):
        if not used[i]:
            own = []
            while i >= 0 and not used[i]:
                used[i] = True
                own.append(points[i])
                i = before[i]
            out.append(own[::-1])
    return out


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common start."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def _extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """From the starts of a and b: words of a, of b and matches of an extension over few differences."""
    short = len(b) <= SHORT  # plain lists are quicker then; a skip of a needs AGREE words of b, so no more of a can be reached
    if short:
        a, b = a[: 2 * len(b) + 8].tolist(), b.tolist()
    i = j = matched = 0
    while True:
        if short:
            n, most = 0, min(len(a) - i, len(b) - j)
            while n < most and a[i + n] == b[j + n]:
                n += 1
        else:
            n = _agreeing(a[i:], b[j:])
        i, j, matched = i + n, j + n, matched + n
        for x, y in SKIPS:
            rest = min(len(a) - i - x, len(b) - j - y)
            p, q = a[i + x : i + x + AGREE], b[j + y : j + y + AGREE]
            if rest >= AGREE and (p == q if short else _agreeing(p, q) == AGREE):
                i, j = i + x, j + y
                break
        else:
            return i, j, matched


def _common(a: list, b: list) -> int:
    """Length of the longest common subsequence of two short runs."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def align(a: np.ndarray, b: np.ndarray, chain: list[tuple[int, int]], k: int, identity: float, least: int) -> list[Passage]:
    """Passages of a chain that reach the identity over at least ``least`` words of a.

    Between anchors the words are aligned by a longest common subsequence, beyond its ends the chain is extended. A chain that
    as a whole falls short is cut at its worst gap and both parts are tried.
    """
    (x, y), (x_last, y_last) = chain[0], chain[-1]
    n = x_last + k - x
    if n == y_last + k - y and all(q - p == y - x for p, q in chain) and (a[x : x + n] == b[y : y + n]).all():
        return _parts(a, b, [Passage(x, x + n, y, y + n, n)], identity, least)  # as all of its pieces would be, none with a loss
    pieces: list[Passage] = []
    for x, y in chain:
        n = k
        if pieces:
            last = pieces[-1]
            over = max(0, last.stop - x, last.other_stop - y)
            x, y, n = x + over, y + over, n - over
            if n <= 0:
                continue
            if x > last.stop or y > last.other_stop:
                p, q = a[last.stop : x], b[last.other_stop : y]
                same = len(p) if len(p) == len(q) and (p == q).all() else _common(p.tolist(), q.tolist())
                pieces.append(Passage(last.stop, x, last.other_stop, y, same))
        pieces.append(Passage(x, x + n, y, y + n, n))
    return _parts(a, b, pieces, identity, least)


def _parts(a, b, pieces: list[Passage], identity: float, least: int) -> list[Passage]:
    if not pieces:
        return []
    first, last = pieces[0], pieces[-1]
    left = _extend(a[: first.start][::-1], b[: first.other_start][::-1])
    right = _extend(a[last.stop :], b[last.other_stop :])
    whole = Passage(
        first.start - left[0],
        last.stop + right[0],
        first.other_start - left[1],
        last.other_stop + right[1],
        sum(p.matched for p in pieces) + left[2] + right[2],
    )
    if whole.stop - whole.start < least:
        return []
    if whole.identity >= identity:
        return [whole]
    lost = [max(p.stop - p.start, p.other_stop - p.other_start) - p.matched for p in pieces]
    worst = int(np.argmax(lost))
    if not lost[worst]:
        return []
    return _parts(a, b, pieces[:worst], identity, least) + _parts(a, b, pieces[worst + 1 :], identity, least)
