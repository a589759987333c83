"""Word splitting and hashing of whole Arrow text batches with numpy.

Texts stay UTF-8 bytes. Every byte of a character beyond ASCII counts as a word byte, so both word
definitions used here can be told from bytes alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that one slice holds at most (a longer text is a slice of its own).
SLICE_BYTES = 1_000_000
SLICE_ROWS = 1 << 19
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))

_CODES = np.arange(256)
LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)
SAME = _CODES.astype(np.uint8)
#: Words are runs of anything but space and \t\n\v\f\r.
BLANK_SPLIT = ~((_CODES == 32) | ((_CODES >= 9) & (_CODES <= 13)))
#: Words are runs of digits, letters a-z (either case) and characters beyond ASCII.
ALNUM_SPLIT = ((_CODES >= 48) & (_CODES <= 57)) | ((_CODES >= 65) & (_CODES <= 90)) | ((_CODES >= 97) & (_CODES <= 122)) | (_CODES >= 128)


class Texts(NamedTuple):
    """Texts of rows first..first+n: bytes and n + 1 offsets into them."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Words of a slice: byte range and hash of each; words of text i are bounds[i]:bounds[i + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; uint64 in and out."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[Texts]:
    """A text column in slices of bounded bytes and rows."""
    data, offsets = text_buffers(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, min(at + rows, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1))
        yield Texts(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def split_words(texts: Texts, is_word: np.ndarray = BLANK_SPLIT, fold: np.ndarray = SAME) -> Words:
    """Words and their hashes (of the bytes as fold maps them)."""
    data, offsets = texts.data, texts.offsets
    inside = is_word[data]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < len(data))]
        before[cuts] = False
        after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # a long text is hashed in parts, cut between words
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE_BYTES, "right")))
        low = starts[at]
        part = fold[data[low : ends[to - 1]]].astype(np.uint64) + np.uint64(1)
        powers = np.full(len(part) + 1, _STEP)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * powers[:-1], out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        back = np.full(len(part) + 1, _BACK)
        back[0] = 1
        np.cumprod(back, out=back)
        hashes[at:to] = mix((sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64))
        at = to
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets))


def shingles(words: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words and bounds by text; a text of fewer words, but not none, is one shingle."""
    h, bounds = words.hashes, words.bounds
    n = np.diff(bounds)
    many = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    out_bounds = np.zeros(len(bounds), np.int64)
    np.cumsum(many, out=out_bounds[1:])
    if not len(h):
        return np.zeros(0, np.uint64), out_bounds
    short = np.flatnonzero((n > 0) & (n < k))
    rolled = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for j in range(k):
        rolled = mix(rolled ^ h[j : j + len(rolled)]) if j else mix(h[: len(rolled)])
    owner = np.repeat(np.arange(len(n)), many)
    at = bounds[owner] + np.arange(out_bounds[-1]) - out_bounds[owner]
    out = np.zeros(len(at), np.uint64)
    full = ~np.isin(owner, short) if len(short) else np.ones(len(at), bool)
    out[full] = rolled[at[full]]
    for i in short:
        value = mix(np.array([n[i]], np.uint64))
        for x in h[bounds[i] : bounds[i + 1]]:
            value = mix(value ^ x)
        out[out_bounds[i]] = value[0]
    return out, out_bounds
