"""Near-duplicate documents by BagMinHash bands and verified multiset overlap.

Copies of one text are one node. Every node gets a BagMinHash signature of its multiset of five-word shingles; nodes
that agree in all registers of a band share a bucket. Within a bucket each node is first compared with LEADERS nodes of it
only, so a bucket of n nodes gives LEADERS n pairs at the most. Buckets whose nodes verified links have not all joined are
then searched across their components: their nodes are dealt into blocks of about BLOCK, every two blocks meet in a task of
their own, and their nodes are compared as arrays: first sketches, then counts of shingles by CELLS hashed cells, whose
common part is no less than that of the shingles themselves, so this bound loses no link. Only pairs that may be links leave
such a task; no bucket is held as a whole and its pairs are never written out. No candidate link between components is lost,
and none inside a component is needed. Pairs whose four-bit sketches of all registers lie SPREAD standard deviations below
the threshold are left out (one link in 30 000 at the threshold itself, fewer above). A link is a weighted Jaccard similarity
of THRESHOLD or more, counted over whole texts.

Nulls: a null text counts as an empty one; texts without words are no near-duplicates of others but copies of each other
if equal. A class is named by its least doc_id (null if it has none). Repeated rows fall into one class; extra columns are
kept by keep_one() and ignored by classes().
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.bagminhash import band_keys, signatures, similarity, sketches, weigh
from staylens.llm.graph import components
from staylens.llm.names import any_names
from staylens.llm.skew import spread_join
from staylens.llm.storage import discard, table, written
from staylens.llm.words import ALNUM_SPLIT, LOWER, shingles, slices, split_words
from staylens.llm.workers import map_batches

K = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 8
#: Nodes of a bucket that all others of it are compared with first.
LEADERS = 4
#: Nodes of a block of a bucket, pairs whose sketches are compared at a time, and pairs whose cells are.
BLOCK, SKETCHES_AT_ONCE, CELLS_AT_ONCE = 500, 200_000, 20_000
#: Cells that a text's shingles are counted by, in two bytes each.
CELLS = 512
#: Standard deviations below the threshold that a sketch may lie.
SPREAD = 4.0
#: Pairs of texts whose shingles a task holds at a time, and texts whose registers it does.
PAIRS_AT_ONCE, ROWS_AT_ONCE = 500, 4_096


def text_node(text: Column) -> Column:
    """16 bytes that stand for a text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(node, n, buckets, sketch) of each distinct text with words; n counts its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node")
            for texts in slices(batch.column("text"), rows=ROWS_AT_ONCE):
                hashes, bounds = shingles(split_words(texts, ALNUM_SPLIT, LOWER), K)
                owner, element, weight = weigh(hashes, bounds)
                registers = signatures(len(bounds) - 1, owner, element, weight, bands * rows)
                sizes = np.diff(bounds)
                has = np.flatnonzero(sizes > 0)
                keys = band_keys(registers[has], bands, rows).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [nodes.take(pa.array(has + texts.first)), pa.array(sizes[has], pa.int64()), _lists(keys), _lists(sketches(registers[has]))],
                    names=["node", "n", "buckets", "sketch"],
                )

    text = F.coalesce(F.col("text"), F.lit(""))
    named = docs.select(text_node(F.col("text")).alias("node"), text.alias("text"))
    return named.transform(map_batches, run, "node binary, n long, buckets array<long>, sketch array<long>").distinct()


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))


def least_agreeing(threshold: float, registers: int) -> float:
    """Registers whose sketches agree at least, of two sets at the threshold, but for SPREAD standard deviations."""
    share = threshold + (1 - threshold) / 16
    return registers * share - SPREAD * (registers * share * (1 - share)) ** 0.5


def may_link(threshold: float, registers: int, a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Whether (size, sketch) of two sets allow the threshold: sizes exactly, sketches as least_agreeing() says."""
    size = F.least(a[0], b[0]) >= F.greatest(a[0], b[0]) * threshold
    differ = F.lit(0)
    for i in range(registers // 16):  # a register differs if any of its four bits does
        x = a[1][i].bitwiseXOR(b[1][i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return size & (F.lit(registers) - differ >= least_agreeing(threshold, registers))


def shingle_cells(texts: DataFrame) -> DataFrame:
    """(node, cells) of texts (node, text): how many shingles fall in each cell; 65535 stands for as many or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text"), rows=ROWS_AT_ONCE):
                hashes, bounds = shingles(split_words(part, ALNUM_SPLIT, LOWER), K)
                n = len(bounds) - 1
                place = np.repeat(np.arange(n), np.diff(bounds)) * CELLS + (hashes % np.uint64(CELLS)).astype(np.int64)
                counts = np.minimum(np.bincount(place, minlength=n * CELLS), 65535).astype("<u2").reshape(n, CELLS)
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(part.first, n), pa.array([x.tobytes() for x in counts], pa.binary())], names=["node", "cells"])

    return texts.select("node", "text").transform(map_batches, run, "node binary, cells binary")


def cells_allow(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the cells of two sets of n_a and n_b shingles allow the threshold; never false of a link."""
    common = np.minimum(a, b)
    full = (common == 65535).any(axis=1)  # more than two bytes can tell
    most = common.sum(axis=1, dtype=np.int64)
    return full | (most >= threshold * (n_a + n_b - most) - 1e-6)


def _cell_pairs(cell: np.ndarray, block: np.ndarray, inner: np.ndarray, component: np.ndarray, n: np.ndarray, sketch: np.ndarray, counts: np.ndarray, threshold: float):
    """Index pairs of rows of one cell, ordered by cell, that are of different components and may be links."""
    registers = sketch.shape[1] * 16
    least = least_agreeing(threshold, registers)
    after = np.searchsorted(cell, cell, "right") - np.arange(len(cell)) - 1  # rows that follow in the cell
    ends = np.cumsum(after)
    at = 0
    while at < len(cell):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SKETCHES_AT_ONCE, "right")))
        i = np.repeat(np.arange(at, to), after[at:to])
        j = i + 1 + np.arange(len(i)) - np.repeat(ends[at:to] - after[at:to] - (ends[at - 1] if at else 0), after[at:to])
        likely = (component[i] != component[j]) & (inner[i] | (block[i] != block[j])) & (np.minimum(n[i], n[j]) >= np.maximum(n[i], n[j]) * threshold)
        i, j = i[likely], j[likely]
        x = sketch[i] ^ sketch[j]
        x |= x >> np.uint64(1)
        x |= x >> np.uint64(2)
        near = registers - np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1, dtype=np.int64) >= least
        i, j = i[near], j[near]
        for k in range(0, len(i), CELLS_AT_ONCE):
            p, q = i[k : k + CELLS_AT_ONCE], j[k : k + CELLS_AT_ONCE]
            good = cells_allow(counts[p], counts[q], n[p], n[q], threshold)
            yield p[good], q[good]
        at = to


def across(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of the rows (bucket, size, node, n, sketch, cells, component) of one bucket that are of different components and may be links."""
    blocks = F.ceil(F.col("size") / BLOCK)
    own = F.pmod(F.xxhash64("node"), blocks)
    dealt = rows.select(
        F.xxhash64("component").alias("component"), "bucket", "node", "n", "sketch", "cells", own.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other")
    ).select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "n", "component", "sketch", "cells")
    keys_of = ["bucket", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in chain(batches, [None]):
            table = pa.Table.from_batches([x for x in (held, batch) if x is not None]).combine_chunks() if held is not None or batch is not None else None
            if table is None or not table.num_rows:
                continue
            keys = np.stack([table.column(c).to_numpy() for c in keys_of])
            new = np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
            stop = table.num_rows if batch is None else int(np.flatnonzero(new)[-1])  # the last cell may go on in the next batch
            held = table.slice(stop).to_batches()[0] if stop < table.num_rows else None
            part = table.slice(0, stop)
            if stop:
                get = lambda c: part.column(c).to_numpy()  # noqa: E731, B023
                sketch = part.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(stop, -1)
                inner = keys[1, :stop] == keys[2, :stop]
                nodes = part.column("node").combine_chunks()
                counts = np.frombuffer(b"".join(part.column("cells").to_pylist()), "<u2").reshape(stop, CELLS)
                for i, j in _cell_pairs(np.cumsum(new[:stop]), get("block"), inner, get("component"), get("n"), sketch, counts, threshold):
                    yield pa.RecordBatch.from_arrays([nodes.take(pa.array(i)), nodes.take(pa.array(j))], names=["a", "b"])

    found = dealt.repartition(*keys_of).sortWithinPartitions(*keys_of).transform(map_batches, run, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Those (a, b) of pairs, a table, whose texts (node, text) reach the threshold, with their similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, PAIRS_AT_ONCE):
                batch = whole.slice(start, PAIRS_AT_ONCE)
                held = []
                for name in ("text_a", "text_b"):
                    sets: list[np.ndarray] = []
                    for part in slices(batch.column(name)):
                        hashes, bounds = shingles(split_words(part, ALNUM_SPLIT, LOWER), K)
                        sets += np.split(hashes, bounds[1:-1])
                    held.append(sets)
                found = np.array([similarity(x, y) for x, y in zip(*held, strict=True)])
                good = np.flatnonzero(found >= threshold)
                at = pa.array(good)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").take(at), batch.column("b").take(at), pa.array(found[good], pa.float64())], names=["a", "b", "similarity"]
                )

    named = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))
    many = lambda c: pairs.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    # A text may be in any share of the pairs.
    both = spread_join(spread_join(pairs, named("a"), "a", "b", counted=many("a")), named("b"), "b", "a", counted=many("b"))
    return both.select("a", "b", "text_a", "text_b").transform(map_batches, run, "a binary, b binary, similarity double")


def node_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the given nodes, from the row of the least doc_id (repeated rows may repeat it)."""
    rows = docs.select(text_node(F.col("text")).alias("node"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    first = rows.groupBy("node").agg(F.min("doc_id").alias("least")).join(nodes, "node")
    same = (F.col("r.node") == F.col("f.node")) & F.col("r.doc_id").eqNullSafe(F.col("f.least"))
    return rows.alias("r").join(first.alias("f"), same).select("r.node", "text")


def links(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """(verified links (a, b) that join all near-duplicates, components (node, component) of their nodes)."""
    registers = bands * rows
    signs = written(signed(docs, bands, rows), "signatures")
    entries = signs.select(F.explode("buckets").alias("bucket"), "node")
    crowded = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("bucket")
    crowd = written(entries.join(crowded, "bucket"), "crowd")
    own = written(signs.join(crowd.select("node").distinct(), "node").select("node", "n", "sketch"), "crowd-signatures")
    discard(signs)
    sizes = crowd.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    full = crowd.join(own, "node")
    leader = lambda seed: F.min(F.struct(F.xxhash64("node", F.lit(seed)).alias("rank"), "node", "n", "sketch"))
    names = [f"leader_{i}" for i in range(LEADERS)]
    heads = full.groupBy("bucket").agg(*[leader(i).alias(name) for i, name in enumerate(names)])
    likely = lambda x: (x["node"] != F.col("node")) & may_link(threshold, registers, (F.col("n"), F.col("sketch")), (x["n"], x["sketch"]))
    star = written(
        spread_join(full, heads, "bucket", "node", counted=sizes)
        .select("node", F.explode(F.array_distinct(F.transform(F.filter(F.array(*names), likely), lambda x: x["node"]))).alias("b"))
        .select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))
        .distinct(),
        "star",
    )
    texts = written(node_texts(docs, own.select("node")), "texts")
    if texts.count() > own.count():  # repeated rows of a least doc_id: one of each text is enough
        texts, every = written(texts.dropDuplicates(["node"]), "texts"), texts
        discard(every)
    first = written(verified(star, texts, threshold).select("a", "b"), "links")
    joined = components(first)
    # What is left: nodes of a bucket in different components. Pairs compared above are known not to be links.
    labelled = crowd.join(joined, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    spread = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size"))
    rest = written(spread_join(labelled, spread.filter("low <> high").select("bucket", "size"), "bucket", "node", counted=sizes), "open")
    counts = shingle_cells(texts.join(rest.select("node").distinct(), "node"))
    rest = rest.join(own.join(counts, "node"), "node")
    more = written(across(rest, threshold).join(star, ["a", "b"], "left_anti"), "pairs")
    second = written(verified(more, texts, threshold).select("a", "b"), "links")
    discard(crowd, own, texts, star, more)
    # Links found across components join these, so only they are left to connect.
    top = lambda c: joined.select(F.col("node").alias(c), F.col("component").alias(f"{c}_top"))
    bridges = second.join(top("a"), "a", "left").join(top("b"), "b", "left").select(F.coalesce("a_top", "a").alias("a"), F.coalesce("b_top", "b").alias("b"))
    over = components(bridges).select(F.col("node").alias("component"), F.col("component").alias("over"))
    ends = second.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    nodes = joined.unionByName(ends.join(joined, "node", "left_anti").select("node", F.col("node").alias("component")))
    return first.unionByName(second), spread_join(nodes, over, "component", "node", "left").select("node", F.coalesce("over", "component").alias("component"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (least doc_id of the class) and whether the row's text is the class's, one row per row of docs."""
    _, joined = links(docs, threshold)
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_node(F.col("text")).alias("node")), "nodes")
    texts = rows.groupBy("node").agg(F.min("doc_id").alias("least"))
    # Only texts that are linked to others meet by component.
    labelled = written(texts.join(joined, "node", "left"), "labelled")
    linked = labelled.filter("component IS NOT NULL")
    named = linked.groupBy("component").agg(F.min("least").alias("class_id"))
    alone = labelled.filter("component IS NULL").select(F.col("node").alias("component"), "node", "least", F.col("least").alias("class_id"))
    by_node = spread_join(linked, named, "component", "node").select("component", "node", "least", "class_id").unionByName(alone)
    return spread_join(rows, by_node, "node", "doc_id").select("doc_id", "class_id", "component", "node", "least")


@any_names
def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with one row for each class: that of the least doc_id."""
    found = classes(docs, threshold).filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    chosen = written(found.groupBy("component", "doc_id").agg(F.min(F.struct("node")).alias("at"), F.count(F.lit(1)).alias("n")).select("doc_id", "at.node", "n"), "chosen")
    rows = docs.select(F.struct(*docs.columns).alias("row"), text_node(F.col("text")).alias("node")).alias("d")
    same = (F.col("d.node") == F.col("c.node")) & F.col("d.row.doc_id").eqNullSafe(F.col("c.doc_id"))
    kept = rows.join(chosen.alias("c"), same).select("d.node", "d.row")
    if chosen.filter("n > 1").limit(1).count():  # repeated rows: only then one more shuffle
        kept = kept.dropDuplicates(["node"])
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op4_near_dup(spark, sf_dir: str) -> DataFrame:
    """One row per document: its class, named by the class's least doc_id, and whether it is the one to keep."""
    found = classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))
