"""Words of Arrow text batches as numbers, exactly: equal numbers within a slice are equal bytes."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from staylens.llm.words import SAME, Texts


class CodedWords(NamedTuple):
    """Byte range and code of each word, the words by code (some unused), and the bounds of each text's words."""

    starts: np.ndarray
    ends: np.ndarray
    codes: np.ndarray
    names: pa.Array
    bounds: np.ndarray


def coded_words(texts: Texts, is_word: np.ndarray, fold: np.ndarray = SAME) -> CodedWords:
    """Runs of bytes that is_word marks, as fold maps them; words end where their text does."""
    data, offsets = texts.data, texts.offsets
    edges = np.zeros(len(data) + 1, bool)
    inside = is_word[data]
    if len(data):
        edges[1:-1] = inside[1:] != inside[:-1]
        edges[0], edges[-1] = inside[0], inside[-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    cuts = np.unique(cuts[inside[cuts] & inside[cuts - 1]]) if len(cuts) else cuts
    # A word that goes on over the end of a text is two: its end and the next start fall on one byte.
    turns = np.sort(np.concatenate([np.flatnonzero(edges), cuts, cuts]), kind="stable")
    starts, ends = turns[::2], turns[1::2]
    if not len(starts):
        return CodedWords(starts, ends, np.zeros(0, np.int64), pa.array([], pa.large_binary()), np.zeros(len(offsets), np.int64))
    folded = np.ascontiguousarray(fold[data])
    pieces = pa.Array.from_buffers(pa.large_binary(), len(turns) - 1, [None, pa.py_buffer(turns.astype(np.int64)), pa.py_buffer(folded)])
    coded = pieces.dictionary_encode()  # words and, between them, gaps
    return CodedWords(starts, ends, coded.indices.to_numpy()[::2].astype(np.int64), coded.dictionary, np.searchsorted(starts, offsets))
