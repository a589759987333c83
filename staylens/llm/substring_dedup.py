"""Repeated passages across documents by shared k-mer seeds and collinear chains.

Seeds are the minimizers of each text's word k-mers: of every ``window`` consecutive k-mers the least hash, so a passage
repeated exactly over k + window - 1 words shares one at least. A seed that several documents hold is matched with its
occurrence in the least doc_id: n occurrences give less than n matches, however many documents share a passage. Earlier
documents that hold only parts of a passage may take all of these. So where rows of shared seeds are left outside the passages
found, their seeds are matched with the preceding document too, and every run of ``least`` words along them is matched as a
whole, with the least doc_id that holds all of it: no exact repeat is lost.
Matches of a document with one source are chained, chains are aligned word by word, and what reaches ``least`` words at
``identity`` is a repeated passage of the later document. The first document keeps its text.

Source words travel as segments around the chains, each distinct segment once, so a long or popular source is never sent
whole to each of its matches.

Nulls: rows with a null doc_id or text take no part and stay as they are. Rows of one doc_id never match each other.
Repeated rows are found once and cut alike; extra columns are kept by cut() and ignored by passages().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.chaining import ANCHOR_SCORE, GAP_COST, align, chains
from staylens.llm.names import any_names
from staylens.llm.skew import HEAVY_ROWS, spread_join
from staylens.llm.storage import discard, table, written
from staylens.llm.words import ALNUM_SPLIT, LOWER, mix, slices, split_words
from staylens.llm.workers import map_batches

K = 6
WINDOW = 12
LEAST_WORDS = 50
IDENTITY = 0.8
#: Seeds of a file, at least, of the tables of shared seeds.
SEEDS_A_FILE = 100_000
#: Ranges of doc_ids that a seed's occurrences are dealt into.
BLOCKS = 256
#: Words that a segment has around its chain, and the grid that its ends are rounded to.
MARGIN, GRID = 40, 32
PASSAGE = "doc_id long, row_key long, source_id long, start long, stop long, source_start long, source_stop long, matched long, char_start long, char_stop long"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_key"), "text"
    )


def _pick(kmers: np.ndarray, window: int) -> np.ndarray:
    """Places of the minimizers of a run of k-mer hashes."""
    if len(kmers) <= window:
        return np.array([int(np.argmin(kmers))]) if len(kmers) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(kmers, window)
    return np.unique(views.argmin(axis=1) + np.arange(len(views)))


def seeds(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """(seed, doc_id, row_key, pos) of every minimizer; pos counts words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("row_key")
            for texts in slices(batch.column("text")):
                words = split_words(texts, ALNUM_SPLIT, LOWER)
                h = words.hashes
                rolled = np.zeros(max(0, len(h) - k + 1), np.uint64)
                for j in range(k):
                    rolled = mix(rolled ^ h[j : j + len(rolled)])
                at = _pick(rolled, window)
                row = np.searchsorted(words.bounds, at, "right") - 1
                inside = at + k <= words.bounds[row + 1]  # windows over two texts may pick k-mers that cross their border
                at, row = at[inside], row[inside]
                # A text of fewer k-mers than a window has all of them as seeds.
                few = np.flatnonzero((np.diff(words.bounds) >= k) & (np.diff(words.bounds) < k + window - 1))
                if len(few):
                    more = np.concatenate([np.arange(words.bounds[i], words.bounds[i + 1] - k + 1) for i in few])
                    at = np.unique(np.concatenate([at, more]))
                    row = np.searchsorted(words.bounds, at, "right") - 1
                take = pa.array(row + texts.first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rolled[at].view(np.int64)), ids.take(take), keys.take(take), pa.array((at - words.bounds[row]).astype(np.int32))],
                    names=["seed", "doc_id", "row_key", "pos"],
                )

    return _keyed(docs).transform(map_batches, run, "seed long, doc_id long, row_key long, pos int")


def shared_seeds(found: DataFrame) -> DataFrame:
    """Occurrences of the seeds that several documents hold, each with the first one in the seed's least doc_id as ``at`` and the
    seed's number of occurrences as ``n``."""
    place = F.struct("doc_id", "row_key", "pos")
    files = max(1, -(-found.count() // SEEDS_A_FILE))  # a count of a written table reads no rows
    shared = found.groupBy("seed").agg(F.min(place).alias("at"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
    shared = written(shared.filter("at.doc_id < last").select("seed", "at", "n").coalesce(files), "shared")
    # Written, so that what follows shuffles anew and only the shared seeds.
    held = written(spread_join(found, shared, "seed", "doc_id", counted=shared.select("seed", "n")).coalesce(files), "seeds")
    discard(shared)
    return held


def _matched(held: DataFrame, at: str) -> DataFrame:
    return held.filter(f"doc_id > {at}.doc_id").select(
        "doc_id", "row_key", F.col(f"{at}.doc_id").alias("source_id"), F.col(f"{at}.row_key").alias("source_key"), F.col("pos").alias("x"), F.col(f"{at}.pos").alias("y")
    )


def first_matches(held: DataFrame) -> DataFrame:
    """Each occurrence of a seed in a later document with the first one in its least doc_id."""
    return _matched(held, "at")


def _block(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are not above doc_id, by halving."""

    def part(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(doc_id < bounds[mid], part(low, mid)).otherwise(part(mid + 1, high))

    return part(0, len(bounds))


def previous_matches(held: DataFrame) -> DataFrame:
    """Each occurrence of a seed with the last one in the preceding doc_id, where that is not its least one.

    A seed's occurrences are dealt into BLOCKS ranges of doc_ids, each a group of its own; the blocks' last occurrences are
    pre-aggregated and passed on from block to block, so no task holds or sorts all rows of a hot seed.
    """
    place = F.struct("doc_id", "row_key", "pos")
    shares = [i / BLOCKS for i in range(1, BLOCKS)]
    bounds = held.agg(F.percentile_approx("doc_id", shares, 1_000)).first()[0] or []
    dealt = held.withColumn("block", _block(F.col("doc_id"), sorted(set(bounds))))
    ends = dealt.groupBy("seed", "block").agg(F.max(place).alias("high"))
    so_far = Window.partitionBy("seed").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    found = dealt.join(ends.select("seed", "block", F.max("high").over(so_far).alias("before")), ["seed", "block"])
    # A frame that only grows, so a block is read in order.
    own = Window.partitionBy("seed", "block").orderBy("doc_id").rangeBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("previous", F.coalesce(F.max(place).over(own), "before"))
    return _matched(found.filter("previous.doc_id > at.doc_id"), "previous")


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive words from each place on, by doubling."""
    size = 1
    while 2 * size <= n:
        h = mix(mix(h[:-size]) ^ h[size:]) if len(h) > size else h[:0]
        size *= 2
    rest = n - size
    return mix(mix(h[: len(h) - rest]) ^ h[rest:]) if len(h) > rest else h[:0]


def _runs(places: np.ndarray, k: int, window: int, least: int) -> Iterator[tuple[int, int]]:
    """Ranges of the places where a run of ``least`` words may begin that has a seed in each window of k-mers."""
    breaks = np.flatnonzero(np.diff(places) > window)
    first = np.maximum(0, places[np.concatenate([[0], breaks + 1])] - (window - 1))
    stop = places[np.concatenate([breaks, [len(places) - 1]])] + k + window - least
    return ((a, b) for a, b in zip(first.tolist(), stop.tolist(), strict=True) if a < b)


def unexplained(held: DataFrame, found: DataFrame, k: int, window: int, least: int) -> DataFrame:
    """(seed) of the rows of shared seeds, no further apart than a window, that span ``least`` words and that the passages found do
    not cover."""
    later = held.filter("doc_id > at.doc_id").groupBy("doc_id", "row_key").agg(F.array_sort(F.collect_set(F.struct("pos", "seed"))).alias("seeds"))
    spans = found.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own, covered in zip(batch.column("seeds"), batch.column("spans"), strict=True):
                places, names = (own.values.field(f).to_numpy(zero_copy_only=False) for f in ("pos", "seed"))
                open_words = np.ones(int(places[-1]) + k + window, bool)
                for span in covered.as_py() or ():
                    open_words[span["start"] : span["stop"]] = False
                before = np.concatenate([[0], np.cumsum(open_words)])
                wanted = np.zeros(len(open_words) + 1, np.int64)
                for a, b in _runs(places, k, window, least):
                    at = np.arange(a, b)
                    at = at[before[at + least] > before[at]]
                    np.add.at(wanted, at, 1)
                    np.add.at(wanted, at + least - k + 1, -1)
                out.append(names[np.cumsum(wanted)[places] > 0])
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64), pa.int64())], names=["seed"])

    later = later.filter(F.size("seeds") >= (least - k + 1) // window)
    return later.join(spans, ["doc_id", "row_key"], "left").select("seeds", "spans").transform(map_batches, run, "seed long").distinct()


def long_seeds(held: DataFrame, texts: DataFrame, k: int, window: int, least: int) -> DataFrame:
    """(seed, doc_id, row_key, pos) of every run of ``least`` words that shared seeds cover without a gap of a window.

    An exact repeat has a shared seed in each of its windows, so all of its runs are among these in both documents.
    """
    grouped = held.groupBy("doc_id", "row_key").agg(F.array_sort(F.collect_set("pos")).alias("places"))
    grouped = grouped.filter(F.size("places") >= (least - k + 1) // window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, places = batch.column("doc_id"), batch.column("row_key"), batch.column("places")
            for part in slices(batch.column("text")):
                words = split_words(part, ALNUM_SPLIT, LOWER)
                grams = _grams(words.hashes, least)
                rows, at = [], []
                for i in range(len(part.offsets) - 1):
                    n = int(words.bounds[i + 1] - words.bounds[i])
                    p = places[part.first + i].values.to_numpy(zero_copy_only=False)
                    runs = [np.arange(a, min(b, n - least + 1)) for a, b in _runs(p, k, window, least) if a < n - least + 1]
                    if runs:
                        at.append(np.unique(np.concatenate(runs)))
                        rows.append(np.full(len(at[-1]), i))
                if not rows:
                    continue
                row, pos = np.concatenate(rows), np.concatenate(at)
                take = pa.array(row + part.first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[words.bounds[row] + pos].view(np.int64)), ids.take(take), keys.take(take), pa.array(pos.astype(np.int32))],
                    names=["seed", "doc_id", "row_key", "pos"],
                )

    return grouped.join(texts, ["doc_id", "row_key"]).transform(map_batches, run, "seed long, doc_id long, row_key long, pos int")


def thinned(pairs: DataFrame, k: int, least: int) -> DataFrame:
    """Matches of ``least`` words as matches of k words, the ends of each run and one in 4 k words, near enough to be chained."""
    grouped = pairs.groupBy("doc_id", "row_key", "source_id", "source_key").agg(F.array_sort(F.collect_set(F.struct((F.col("y") - F.col("x")).alias("d"), "x"))).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "row_key", "source_id", "source_key"]
        for batch in batches:
            rows, xs, ys = [], [], []
            for i, at in enumerate(batch.column("at")):
                d, x = (at.values.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("d", "x"))
                breaks = np.flatnonzero((np.diff(d) != 0) | (np.diff(x) > least)) + 1
                for a, b in zip([0, *breaks], [*breaks, len(x)], strict=True):
                    last = x[b - 1] + least - k
                    some = np.unique(np.append(np.arange(x[a], last, 4 * k), last))
                    rows.append(np.full(len(some), i))
                    xs.append(some)
                    ys.append(some + d[a])
            join = lambda v: np.concatenate(v) if v else np.zeros(0, np.int64)
            take = pa.array(join(rows))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n).take(take) for n in names), pa.array(join(xs).astype(np.int32)), pa.array(join(ys).astype(np.int32))], names=[*names, "x", "y"]
            )

    return grouped.transform(map_batches, run, "doc_id long, row_key long, source_id long, source_key long, x int, y int")


def _may_chain(x: np.ndarray, y: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Groups of anchors that may give a chain of several: of two anchors, those that rise together within a gap's worth."""
    first = ends[:-1]
    two = np.diff(ends) == 2
    dx, dy = (v[np.minimum(first + 1, len(v) - 1)] - v[first] if len(v) else v for v in (x, y))
    rising = (np.sign(dx) == np.sign(dy)) & ((np.abs(dx) + np.abs(dy)) * GAP_COST < ANCHOR_SCORE)
    return np.flatnonzero(~two | rising)


def _sorted_anchors(x: np.ndarray, y: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each group's anchors in order, once each."""
    order = np.lexsort((y, x, group))
    x, y, group = x[order], y[order], group[order]
    once = np.ones(len(x), bool)
    once[1:] = (np.diff(x) != 0) | (np.diff(y) != 0) | (np.diff(group) != 0)
    return x[once], y[once], group[once]


def _single_chains(x: np.ndarray, y: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Groups of sorted anchors on one diagonal that are less than an anchor's score apart: each anchor's best predecessor is the one
    before and scores rise, so all of them are one chain."""
    same = np.diff(group) == 0
    dx, dy = np.diff(x), np.diff(y)
    apart = same & ((dx != dy) | (dx + 1 > ANCHOR_SCORE / GAP_COST / 2))
    return np.bincount(group[1:][apart], minlength=groups) == 0


def chained(pairs: DataFrame, k: int = K, window: int = WINDOW, least: int = LEAST_WORDS) -> DataFrame:
    """Chains of each document and source that can be part of a passage of ``least`` words."""
    short = least - 2 * (window - 1) - 2 * AROUND
    grouped = (
        pairs.groupBy("doc_id", "row_key", "source_id", "source_key")
        .agg(F.collect_list(F.struct("x", "y")).alias("anchors"), (F.max("x") - F.min("x") + k).alias("span"))
        .filter(F.col("span") >= short)
        .drop("span")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors = batch.column("anchors")
            ends = anchors.offsets.to_numpy()
            values = anchors.flatten()
            ends = ends - ends[0]
            x, y = (values.field(f).to_numpy() for f in ("x", "y"))
            tried = _may_chain(x, y, ends)
            group = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            inside = np.isin(np.arange(len(ends) - 1), tried)[group]
            x, y, group = _sorted_anchors(x[inside], y[inside], group[inside])
            ends = np.searchsorted(group, np.arange(len(ends)))
            single = _single_chains(x, y, group, len(ends) - 1)
            rows, xs, ys = [], [], []
            for i in tried.tolist():
                a, b = ends[i], ends[i + 1]
                if single[i]:
                    found = [(x[a:b], y[a:b])]
                else:
                    several = chains(list(zip(x[a:b].tolist(), y[a:b].tolist(), strict=True)))
                    found = [tuple(np.array(c, np.int32).T) for c in several if c[-1][0] - c[0][0] + k >= short]
                for u, v in found:
                    if u[-1] - u[0] + k >= short:
                        rows.append(i)
                        xs.append(u)
                        ys.append(v)
            take = pa.array(rows, pa.int64())
            low = [max(0, int(v[0]) - MARGIN) // GRID * GRID for v in ys]
            high = [-(-(int(v[-1]) + k + MARGIN) // GRID) * GRID for v in ys]
            flat = [pa.array(np.concatenate(v) if v else np.zeros(0), pa.int32()) for v in (xs, ys)]
            bounds = np.concatenate([[0], np.cumsum([len(u) for u in xs])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n).take(take) for n in ("doc_id", "row_key", "source_id", "source_key")),
                    pa.array(low, pa.int32()),
                    pa.array(high, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(flat, ["x", "y"])),
                ],
                names=["doc_id", "row_key", "source_id", "source_key", "low", "high", "chain"],
            )

    return grouped.transform(
        map_batches, run, "doc_id long, row_key long, source_id long, source_key long, low int, high int, chain array<struct<x:int,y:int>>"
    )


#: A passage may begin or end with so many words that no seed covers.
AROUND = 3


def segments(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """(source_id, source_key, low, high, words): word hashes of each distinct range of a source."""
    ranges = wanted.select("source_id", "source_key", "low", "high").distinct()
    grouped = ranges.groupBy("source_id", "source_key").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    named = texts.select(F.col("doc_id").alias("source_id"), F.col("row_key").alias("source_key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["source_id", "source_key", "low", "high", "words"]
        for batch in batches:
            for part in slices(batch.column("text")):
                words = split_words(part, ALNUM_SPLIT, LOWER)
                rows, low, high, held = [], [], [], []
                for i in range(len(part.offsets) - 1):
                    own = words.hashes[words.bounds[i] : words.bounds[i + 1]].view(np.int64)
                    for r in batch.column("ranges")[part.first + i].as_py():
                        rows.append(part.first + i)
                        low.append(r["low"])
                        high.append(r["high"])
                        held.append(own[r["low"] : r["high"]])
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("source_id").take(take), batch.column("source_key").take(take), pa.array(low, pa.int32()), pa.array(high, pa.int32()), pa.array(held, pa.list_(pa.int64()))],
                    names=names,
                )

    return grouped.join(named, ["source_id", "source_key"]).transform(
        map_batches, run, "source_id long, source_key long, low int, high int, words array<long>"
    )


def _lists(column: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Bounds of the rows' items, and all items."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten()


def aligned(wanted: DataFrame, parts: DataFrame, texts: DataFrame, k: int, identity: float, least: int) -> DataFrame:
    """Passages (see PASSAGE) of the chains."""
    full = wanted.join(parts, ["source_id", "source_key", "low", "high"])
    grouped = full.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("source_id", "low", "chain", "words")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PASSAGE.split(", ")]
        for batch in batches:
            rows: list[tuple] = []
            doc_ids, row_keys = (batch.column(n).to_pylist() for n in ("doc_id", "row_key"))
            of_row, found = _lists(batch.column("found"))
            sources, lows = found.field("source_id").to_pylist(), found.field("low").to_numpy()
            of_chain, anchors = _lists(found.field("chain"))
            xs, ys = (anchors.field(n).to_numpy() for n in ("x", "y"))
            of_words, others = _lists(found.field("words"))
            others = others.to_numpy()
            for part in slices(batch.column("text")):
                words = split_words(part, ALNUM_SPLIT, LOWER)
                letters = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
                for i in range(len(part.offsets) - 1):
                    at = words.bounds[i]
                    own = words.hashes[at : words.bounds[i + 1]].view(np.int64)
                    key = (doc_ids[part.first + i], row_keys[part.first + i])
                    base = letters[part.offsets[i]]
                    for f in range(of_row[part.first + i], of_row[part.first + i + 1]):
                        low = int(lows[f])
                        a, b = of_chain[f : f + 2]
                        chain = list(zip(xs[a:b].tolist(), (ys[a:b] - low).tolist(), strict=True))
                        for p in align(own, others[of_words[f] : of_words[f + 1]], chain, k, identity, least):
                            rows.append(
                                (*key, sources[f], p.start, p.stop, p.other_start + low, p.other_stop + low, p.matched,
                                 int(letters[words.starts[at + p.start]] - base), int(letters[words.ends[at + p.stop - 1]] - base))
                            )
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return grouped.join(texts, ["doc_id", "row_key"]).transform(map_batches, run, PASSAGE)


def _extended(docs: DataFrame, pairs: DataFrame, k: int, window: int, least: int, identity: float) -> DataFrame:
    """Passages (see PASSAGE) of matched seeds, written."""
    wanted = written(chained(pairs, k, window, least), "chains")
    involved = (
        wanted.select("doc_id", "row_key")
        .unionByName(wanted.select(F.col("source_id").alias("doc_id"), F.col("source_key").alias("row_key")))
        .distinct()
    )
    texts = written(_keyed(docs).join(involved, ["doc_id", "row_key"]).dropDuplicates(["doc_id", "row_key"]), "texts")
    found = written(aligned(wanted, segments(wanted, texts), texts, k, identity, least), "passages")
    discard(wanted, texts)
    return found


def passages(docs: DataFrame, k: int = K, window: int = WINDOW, least: int = LEAST_WORDS, identity: float = IDENTITY) -> DataFrame:
    """One row per passage of a document that repeats one of an earlier document: see PASSAGE."""
    all_seeds = written(seeds(docs, k, window), "all-seeds")
    held = shared_seeds(all_seeds)
    discard(all_seeds)
    found = _extended(docs, first_matches(held), k, window, least, identity)
    open_seeds = written(unexplained(held, found, k, window, least), "open-seeds")
    hot = held.select("seed", "n").filter(F.col("n") >= HEAVY_ROWS).distinct()
    left = written(spread_join(held, open_seeds, "seed", "doc_id", counted=hot), "left")
    discard(held, open_seeds)
    whole = thinned(first_matches(shared_seeds(written(long_seeds(left, _keyed(docs), k, window, least), "runs"))), k, least)
    more = _extended(docs, whole.unionByName(previous_matches(left)), k, window, least, identity)
    discard(left)
    return found.unionByName(more).distinct()


@any_names
def cut(docs: DataFrame, **settings) -> DataFrame:
    """docs with the repeated passages taken out of the later documents' texts; same columns and rows."""
    found = passages(docs, **settings).groupBy("doc_id", "row_key").agg(
        F.array_sort(F.collect_list(F.struct("char_start", "char_stop"))).alias("spans")
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<a:bigint,n:bigint>>").alias("gaps"))
    gap = lambda s, to: F.struct(s["at"].alias("a"), F.greatest(F.lit(0), to - s["at"]).cast("long").alias("n"))
    step = lambda s, x: F.struct(
        F.greatest(s["at"], x["char_stop"]).alias("at"), F.concat(s["gaps"], F.array(gap(s, x["char_start"]))).alias("gaps")
    )
    gaps = F.aggregate("spans", start, step, lambda s: F.concat(s["gaps"], F.array(gap(s, F.length("d.row.text").cast("long")))))
    left = F.array_join(F.transform(gaps, lambda g: F.substring(F.col("d.row.text"), (g["a"] + 1).cast("int"), g["n"].cast("int"))), "")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("row_key")).alias("d")
    same = (F.col("d.row.doc_id").cast("long") == F.col("f.doc_id")) & (F.col("d.row_key") == F.col("f.row_key"))
    text = F.when(F.col("spans").isNull(), F.col("d.row.text")).otherwise(left)
    return rows.join(found.alias("f"), same, "left").select(
        *[text.alias("text") if c == "text" else F.col("d.row")[c].alias(c) for c in docs.columns]
    )


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Every passage of 50 words or more that a document repeats from an earlier one, as pairs of doc_ids with word ranges."""
    found = passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "source_id", "start", "stop", "source_start", "source_stop", "matched")
