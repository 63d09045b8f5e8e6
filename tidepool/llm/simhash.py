"""Operator 8: SimHash near-duplicates with BK-trees.

Fingerprints within ``radius`` bits are found exactly.  The 64 bits are cut into
radius + 2 blocks; two fingerprints within the radius agree on two blocks at
least, so each distinct fingerprint goes to the shards of all its pairs of
blocks (ten of about 26 bits for a radius of 3).  A shard's fingerprints form a
BK-tree: a child hangs under its parent by their Hamming distance, and a search
follows only the edges within the radius of its own distance.  A shard with more
than SHARD fingerprints becomes several trees; each tree is sent once to its own
task and the shard's later fingerprints are sent to it as searches.

Equal fingerprints are one node.  From each tree comes at most one row for a
fingerprint (to the least one it is linked with), never all pairs, and the
components of those rows are found by ``graph.components``.

Defined results: a null, empty or blank text has fingerprint zero and links like
any other; texts of any length are read whole; repeated rows are linked; an empty
table gives an empty table.  A component without any id that is not null has a null
component_id.  Further columns may have any name; only the two named ones are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import ragged, row_hash, stage
from tidepool.llm.graph import components

SHARD = 4096
SEARCHES = 512


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()     # bytes: A-Z and the six ASCII white spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lens + 1) - lens - 1
    ends = starts + lens
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        to = min(n, at + (1 << 16))
        first = starts[at:to].tolist()
        last = ends[np.minimum(np.arange(at, to) + shingle, len(words)) - 1].tolist()
        h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(first, last)), np.uint64, to - at)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def _fingerprints(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            fps = pa.array((fingerprint(t.as_py() or b"", shingle) for t in texts), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], fps], [*batch.schema.names[:-1], "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str, *more) -> DataFrame:
    """(id, further columns, fp), staged: every later step reads it."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), *more, F.col(text_col).cast("binary").alias("text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[:-1]) + ", fp long"
    return stage(rows.mapInArrow(_fingerprints(shingle), schema), "llm-fingerprints")


def block_masks(radius: int, fixed: int = 0) -> list[int]:
    """Masks of the bits set in ``fixed`` and two of the radius + 2 blocks of the others."""
    free = [b for b in range(64) if not fixed >> b & 1]
    edges = [len(free) * i // (radius + 2) for i in range(radius + 3)]
    blocks = [sum(1 << b for b in free[a:b]) for a, b in zip(edges, edges[1:])]
    return [fixed | a | b for a, b in combinations(blocks, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)).astype(np.int64)     # of signed longs it would count the absolute value's bits


class Forest:
    """BK-trees over sorted groups of fingerprints, one tree a group."""

    def __init__(self, fps: np.ndarray, group: np.ndarray):
        self.fps = fps
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)
        self.root = np.repeat(starts, np.diff(np.r_[starts, len(group)]))
        edges, kids = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        left = np.setdiff1d(np.arange(len(fps)), starts, assume_unique=True)
        at = self.root[left]
        while len(left):     # one level of all trees a turn: the first to take an edge becomes the child
            edge = at * 65 + _distance(fps[left], fps[at])
            taken, first, where = np.unique(edge, return_index=True, return_inverse=True)
            edges.append(taken)
            kids.append(left[first])
            at = left[first][where]
            rest = at != left
            left, at = left[rest], at[rest]
        edges, kids = np.concatenate(edges), np.concatenate(kids)
        order = np.argsort(edges, kind="stable")
        self.edges, self.kids = edges[order], kids[order]

    def within(self, fps: np.ndarray, roots: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (index into fps, node) at most ``radius`` apart."""
        q, node = np.arange(len(fps)), roots
        found_q, found_n = [q[:0]], [node[:0]]
        while len(q):
            d = _distance(fps[q], self.fps[node])
            near = d <= radius
            found_q.append(q[near])
            found_n.append(node[near])
            lo = np.searchsorted(self.edges, node * 65 + np.maximum(d - radius, 0), "left")
            hi = np.searchsorted(self.edges, node * 65 + np.minimum(d + radius, 64), "right")
            n = hi - lo
            ends = np.cumsum(n)
            node = self.kids[np.arange(int(n.sum())) + np.repeat(lo - (ends - n), n)]
            q = np.repeat(q, n)
        return np.concatenate(found_q), np.concatenate(found_n)


def _join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            return label
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while (label[label] != label).any():
            label = label[label]


def _links(fps: np.ndarray, group: np.ndarray, radius: int):
    """Fingerprints and the least one each is linked with, over one set of trees."""
    forest = Forest(fps, group)
    label = np.arange(len(fps))
    for i in range(0, len(fps), SEARCHES):
        q, node = forest.within(fps[i:i + SEARCHES], forest.root[i:i + SEARCHES], radius)
        label = _join_labels(label, q + i, node)
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return fps[linked], fps[label[linked]]


def _search_shards(radius: int) -> Callable:
    """Rows (mask, key, fingerprint) sorted by shard, to the links within each shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 3), np.int64)      # the last shard, as far as it has come
        for batch in chain(batches, [None]):
            if batch is not None:
                held = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns], axis=1).astype(np.int64)])
            if not len(held):
                continue
            starts = np.flatnonzero(np.r_[True, (held[1:, :2] != held[:-1, :2]).any(axis=1)])
            sizes = np.diff(np.r_[starts, len(held)])
            done = len(starts) - (batch is not None)       # the last shard may go on in the next batch
            pairs = np.flatnonzero(sizes[:done] > 1)
            rows = held[ragged(starts[pairs], sizes[pairs])]
            a, b = _links(rows[:, 2], np.repeat(pairs, sizes[pairs]), radius)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            held = held[starts[done]:] if done < len(starts) else held[:0]

    return run


def _dealt(fps: DataFrame, mask: Column) -> DataFrame:
    return fps.select(mask.alias("mask"), "fp").select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def links(distinct: DataFrame, radius: int, cap: int = SHARD) -> DataFrame:
    """(a, b) rows that connect all of the distinct fingerprints (column fp) within
    ``radius`` bits, one at most for a fingerprint and tree.  Shards above ``cap`` are
    cut again, unless so few bits are left that they hold 4^(radius + 2) at most."""
    spark, shard = distinct.sparkSession, ["mask", "key"]
    rows = _dealt(distinct, F.explode(F.array(*[F.lit(_signed(m)) for m in block_masks(radius)])))
    found = None
    while True:
        large = rows.groupBy(*shard).count().where((F.col("count") > cap) & (64 - F.bit_count("mask") > 2 * (radius + 2)))
        large = stage(large.select(*shard), "llm-large-shards")
        masks = [r.mask for r in large.select("mask").distinct().collect()]      # ten at first, ten more for each of them then
        small = rows.join(large, shard, "left_anti") if masks else rows
        small = small.repartition(*shard).sortWithinPartitions(*shard, "fp")
        here = small.mapInArrow(_search_shards(radius), "a long, b long")
        found = here if found is None else found.unionByName(here)
        if not masks:
            return found
        cuts = spark.createDataFrame([(m, _signed(to)) for m in masks for to in block_masks(radius, m % (1 << 64))], "mask long, to long")
        again = rows.join(large, shard, "left_semi").join(F.broadcast(cuts), "mask")
        # cuts of two shards may meet in one mask: a fingerprint is in a shard once
        rows = stage(_dealt(again.select("fp", "to").distinct(), F.col("to")), "llm-cut-shards")


def label(prints: DataFrame, radius: int) -> DataFrame:
    """Staged (id, .., fp) rows with ``root``, the least fingerprint of their component,
    and ``component_id``, its least id."""
    distinct = stage(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "llm-distinct")
    roots = components(links(distinct.select("fp"), radius))
    nodes = stage(distinct.join(roots, distinct.fp == roots.node, "left")
                  .select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "llm-nodes")
    least = stage(nodes.groupBy("root").agg(F.min("first_id").alias("component_id")), "llm-least")
    named = stage(nodes.select("fp", "root").join(least, "root").select("fp", "root", "component_id"), "llm-named")
    return prints.join(named, "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: id_col, fp (long), component_id."""
    prints = fingerprints(docs, shingle, id_col, text_col)
    return label(prints, radius).select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id (a null id
    last), of equal ids the one whose row hash is least; of wholly equal rows one."""
    row = row_hash(docs)
    prints = fingerprints(docs, shingle, id_col, text_col, row.alias("row"))
    best = (label(prints, radius).groupBy("root")
            .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("k")))
    # One pair of keys, never null, for the join and for the last step: the texts move once.
    keys = ["__id", "__row"]
    best = stage(best.select(F.coalesce("k.id", F.lit(0)).alias("__id"), F.col("k.row").alias("__row")), "llm-best")
    keyed = docs.withColumns({"__id": F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0)), "__row": row})
    return keyed.join(best.hint("merge"), keys).dropDuplicates(keys).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_digest(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs, shingle=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
