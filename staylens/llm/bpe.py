"""BPE encoding and decoding by a contiguous rank array.

A short word keeps its parts and the ranks of adjacent pairs in two contiguous arrays; the least rank is found by a scan,
one boundary is deleted and the two ranks beside it are refreshed. Words of one length are rows of one matrix and take each
step together, words of more than SHORT_WORD bytes one by one. Words of more than LONG_WORD bytes use a heap over linked
parts instead, so one endless word costs n log n. The tokenizer file gives the vocabulary, the merges and the special
tokens; nothing is trained.

Texts are cut at ASCII white space as bytes, the distinct chunks of a slice are split into words and its distinct words
merged once; their ids are dealt out to the texts as arrays, so nothing is remembered between slices. Texts are decoded
from their ids.

Nulls encode like empty texts: no token. Repeated rows each get their result; other columns pass through encode() and
decode(), but one named like the column that they add is replaced by it.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.llm.names import any_names
from staylens.llm.storage import table
from staylens.llm.words import BLANK_SPLIT, slices, text_buffers
from staylens.llm.workers import map_batches

SHORT_WORD, LONG_WORD = 40, 200
#: Bytes of text that are encoded at a time (a longer text is encoded as a whole).
SLICE_BYTES = 4_000_000
_NONE = 1 << 30


class Lists(NamedTuple):
    """Lists of ids; those of item i are ids[bounds[i]:bounds[i + 1]]."""

    ids: np.ndarray
    bounds: np.ndarray

    def take(self, items: np.ndarray) -> Lists:
        sizes = np.diff(self.bounds)[items]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        return Lists(self.ids[np.repeat(self.bounds[:-1][items] - bounds[:-1], sizes) + np.arange(bounds[-1])], bounds)


class Encoded(NamedTuple):
    """Ids of texts first..first+n; those of text i are ids[bounds[i]:bounds[i + 1]]."""

    first: int
    ids: np.ndarray
    bounds: np.ndarray


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else the next free one from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


class Tokenizer:
    """Encodes and decodes as the file at path says (BPE with word ends, lower case, white space dropped)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = np.array([a << 32 | b for a, b in self.ranks], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(self.ranks.values()), np.int32)[order]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in chain(vocab.items(), self.special.items())}
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.word = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] + r"|\n")
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int32)
        self.last = np.array([vocab[x + self.end] for x in letters], np.int32)
        #: What each id decodes to, and its digits, each with the space that follows; the last place is of ids the vocabulary lacks.
        most = max(self.tokens)
        self.names = pa.array([f"{self.tokens[i]} ".encode() if i in self.tokens else b"" for i in range(most + 1)] + [b""], pa.large_binary())
        self.digits = pa.array([f"{i} ".encode() for i in range(most + 1)], pa.large_binary())

    def merge(self, ids: list[int]) -> list[int]:
        """Token ids of one word from the ids of its bytes."""
        if len(ids) > LONG_WORD:
            return self._merge_long(ids)
        find = self.ranks.get
        ranks = [find(pair, _NONE) for pair in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            at = ranks.index(least)
            ids[at] = int(self.merged[least])
            del ids[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = find((ids[at], ids[at + 1]), _NONE)
            if at:
                ranks[at - 1] = find((ids[at - 1], ids[at]), _NONE)
        return ids

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NONE).astype(np.int32)

    def _merge_rows(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """merge() of words of one length, as rows: (numbers of words, their ids) as words are done."""
        word, ranks = np.arange(len(ids)), self._ranks(ids[:, :-1], ids[:, 1:])
        while len(ids) and ranks.shape[1]:
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(ids)), at]
            go = least < _NONE
            if not go.all():
                yield word[~go], ids[~go]
                word, ids, ranks, at, least = word[go], ids[go], ranks[go], at[go], least[go]
                if not len(ids):
                    return
            row, n = np.arange(len(ids)), ids.shape[1]
            ids[row, at] = self.merged[least]
            kept = np.ones(ids.shape, bool)
            kept[row, at + 1] = False
            ids = ids[kept].reshape(len(ids), n - 1)
            kept = np.ones(ranks.shape, bool)
            kept[row, at] = False
            ranks = ranks[kept].reshape(len(ids), n - 2)
            right, left = np.flatnonzero(at < n - 2), np.flatnonzero(at > 0)
            ranks[right, at[right]] = self._ranks(ids[right, at[right]], ids[right, at[right] + 1])
            ranks[left, at[left] - 1] = self._ranks(ids[left, at[left] - 1], ids[left, at[left]])
        yield word, ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.ranks[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.ranks]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = int(self.merged[rank]), False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (p := (ids[x], ids[y])) in self.ranks:
                    heapq.heappush(heap, (self.ranks[p], x, *p))
        return [x for x, kept in zip(ids, alive, strict=True) if kept]

    def merge_words(self, words: pa.Array) -> Lists:
        """Ids of each word of a string array without empty ones."""
        data, starts = text_buffers(words)
        sizes = np.diff(starts)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for n in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == n)
            raw = data[starts[own][:, None] + np.arange(n)]
            ids = self.inner[raw]
            ids[:, -1] = self.last[raw[:, -1]]
            if n > SHORT_WORD:
                done += [(own[i : i + 1], np.array([self.merge(x)], np.int32)) for i, x in enumerate(ids.tolist())]
            else:
                done += [(own[word], merged) for word, merged in self._merge_rows(ids)]
        counts = np.zeros(len(words), np.int64)
        for own, ids in done:
            counts[own] = ids.shape[1]
        bounds = np.concatenate([[0], np.cumsum(counts)])
        flat = np.zeros(bounds[-1], np.int32)
        for own, ids in done:
            flat[bounds[own][:, None] + np.arange(ids.shape[1])] = ids
        return Lists(flat, bounds)

    def _words(self, text: str) -> list[str]:
        """Words and line breaks of a text without special tokens."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # Letter by letter, as str.lower() writes a capital sigma by its place in the word.
        return self.word.findall(text.lower() if "\u03a3" not in text else "".join(map(str.lower, text)))

    def encode_chunks(self, chunks: list[str]) -> Lists:
        """Ids of each chunk; no chunk has a line break, so one ends each of them."""
        if any("<|" in c for c in chunks):
            parts = chain.from_iterable([*self.splitter.split(c), "\n"] for c in chunks)
            words = list(chain.from_iterable([p] if p in self.special else self._words(p) for p in parts))
        else:
            words = self._words("\n".join([*chunks, ""]))
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        # Line breaks have no id and special tokens their own; the pattern's words equal neither.
        known = pa.compute.index_in(coded.dictionary, value_set=pa.array(["\n", *self.special], pa.large_string()))
        plain = known.is_null().to_numpy(zero_copy_only=False)
        lists = self.merge_words(coded.dictionary.filter(known.is_null()))
        n, end = int(plain.sum()), lists.bounds[-1]
        place = np.where(plain, np.cumsum(plain) - 1, n + known.fill_null(0).to_numpy(zero_copy_only=False))[coded.indices.to_numpy()]
        lists = Lists(np.append(lists.ids, np.array([*self.special.values()], np.int32)), np.append(lists.bounds, end + np.arange(len(self.special) + 1)))
        found = lists.take(place)
        return Lists(found.ids, found.bounds[np.concatenate([[0], np.flatnonzero(place == n) + 1])])

    def encode_column(self, column: pa.Array) -> Iterator[Encoded]:
        """A text column in slices."""
        for texts in slices(column, SLICE_BYTES):
            inside = BLANK_SPLIT[texts.data]
            begins = inside.copy()
            begins[1:] &= ~inside[:-1]
            firsts = texts.offsets[:-1][texts.offsets[:-1] < len(texts.data)]
            begins[firsts] = inside[firsts]
            letters, starts = texts.data[inside], np.flatnonzero(begins[inside])
            places = pa.py_buffer(np.append(starts, len(letters)).astype(np.int64))
            chunks = pa.Array.from_buffers(pa.large_string(), len(starts), [None, places, pa.py_buffer(letters)]).dictionary_encode()
            found = self.encode_chunks(chunks.dictionary.to_pylist()).take(chunks.indices.to_numpy())
            yield Encoded(texts.first, found.ids, found.bounds[np.searchsorted(np.flatnonzero(begins), texts.offsets)])

    def encode(self, text: str) -> list[int]:
        return [i for e in self.encode_column(pa.array([text])) for i in e.ids.tolist()]

    def spelled(self, table: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that the table has for the ids, joined, and the byte bounds of each text."""
        ids = np.where((ids >= 0) & (ids < len(table)), ids, len(table) - 1)
        joined = table.take(pa.array(ids))
        _, places, data = joined.buffers()
        offsets = np.frombuffer(places, np.int64)[joined.offset : joined.offset + len(joined) + 1] if len(joined) else np.zeros(1, np.int64)
        return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets[bounds]

    def decode_column(self, ids: np.ndarray, bounds: np.ndarray) -> Iterator[memoryview]:
        """UTF-8 of each text's tokens, joined by a space; ids that the vocabulary lacks are left out."""
        data, at = self.spelled(self.names, ids, bounds)
        view = memoryview(data)
        return (view[a : max(a, b - 1)] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True))

    def decode(self, ids: list[int]) -> str:
        return bytes(next(self.decode_column(np.array(ids, np.int64), np.array([0, len(ids)])))).decode()


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """One per worker process and file."""
    return Tokenizer(path)


@any_names
def encode(docs: DataFrame, path: str | None = None, column: str = "text") -> DataFrame:
    """docs with token_ids array<int> in place of the text column."""
    path = path or default_path()
    rest = [f for f in docs.schema.fields if f.name not in (column, "token_ids")]
    schema = T.StructType([*rest, T.StructField("token_ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            for e in own.encode_column(batch.column(column)):
                part = batch.slice(e.first, len(e.bounds) - 1)
                ids = pa.ListArray.from_arrays(pa.array(e.bounds.astype(np.int32)), pa.array(e.ids))
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in rest), ids], names=schema.names)

    return docs.transform(map_batches, run, schema)


@any_names
def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """encode()'s result with decoded string in place of token_ids."""
    path = path or default_path()
    rest = [f for f in encoded.schema.fields if f.name not in ("token_ids", "decoded")]
    schema = T.StructType([*rest, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            lists = batch.column("token_ids")
            bounds = np.concatenate([[0], np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
            ids = pa.compute.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
            texts = pa.array([bytes(x).decode() for x in own.decode_column(ids, bounds)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), texts], names=schema.names)

    return encoded.transform(map_batches, run, schema)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the text decoded from them, of each row."""
    path = path or default_path()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            for e in own.encode_column(batch.column("text")):
                data, at = own.spelled(own.digits, e.ids, e.bounds)
                view = memoryview(data)
                ids = [sha(view[a : max(a, b - 1)]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                texts = [sha(x) for x in own.decode_column(e.ids, e.bounds)]
                arrays = [pa.array(np.diff(e.bounds)), pa.array(ids, pa.string()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(e.first, len(ids)), *arrays], names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).transform(map_batches, run, schema)


def op10_bpe(spark, sf_dir: str) -> DataFrame:
    """Contract query: every whole document encoded and decoded again."""
    return digests(table(spark, sf_dir, "documents"))
