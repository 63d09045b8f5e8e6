"""Operator 6: shards of nearly equal bytes by histogram sort.

Rows are ordered by (hash of the text, id), so equal texts lie together.  Splitters are
found by counting: probes between the bounds known so far go to all partitions, which
count the exact bytes and rows between probes over narrow staged keys; the counts narrow
the bounds, and the next probes are finer, until every splitter is within ``tolerance`` of
its target or no key lies between its bounds.  Then the rows are exchanged once, by range.

Where a group of equal texts lies across a target, the splitter takes the group's nearer
edge if that is within the tolerance; a group too large for that is split by id, since
sizes must stay near equal.  A shard is several ranges of the exchange when the session
has more shuffle partitions than shards, so no task holds a whole shard; these are split
within shards found before, so a row's shard is the same in any session.  The counts tell
each range its first slot.

Defined results: a null text has no bytes; a null id comes before all others; rows equal
in text and id stay in one range, in the order of a hash of the whole row; texts of any
length are counted whole; an empty table gives an empty table; further columns are carried
along, whatever their names.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidepool.llm.common import row_hash, shuffle_partitions, stage

OVERHEAD = 16
PROBES = 15
_TOP = np.uint64(1) << np.uint64(63)


def _keys(k1, k2) -> np.ndarray:
    """Pairs of longs as 16-byte strings in the same order."""
    both = np.empty((len(k1), 2), ">u8")
    both[:, 0], both[:, 1] = k1.view(np.uint64) ^ _TOP, k2.view(np.uint64) ^ _TOP
    return np.ascontiguousarray(both).view("S16").reshape(-1)


def _probe(u: int) -> bytes:
    return min(u, (1 << 128) - 1).to_bytes(16, "big")


def _column(batch: pa.RecordBatch, i: int) -> np.ndarray:
    return batch.column(i).to_numpy().astype(np.int64)


def _count(probes: list[int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.array([_probe(p) for p in probes], "S16")
        size, rows = np.zeros(len(at) + 1, np.int64), np.zeros(len(at) + 1, np.int64)
        least, most = [None] * (len(at) + 1), [None] * (len(at) + 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = _keys(_column(batch, 0), _column(batch, 1))
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            where = np.searchsorted(at, keys, "right")      # keys at or above a probe lie right of it
            np.add.at(size, where, _column(batch, 2)[order])
            np.add.at(rows, where, 1)
            first = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
            for a, b in zip(first, np.r_[first[1:], len(keys)] - 1):
                w, lo, hi = where[a], bytes(keys[a]).ljust(16, b"\0"), bytes(keys[b]).ljust(16, b"\0")
                least[w] = lo if least[w] is None else min(least[w], lo)
                most[w] = hi if most[w] is None else max(most[w], hi)
        has = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(has), pa.array(size[has]), pa.array(rows[has]), pa.array([least[i].hex() for i in has], pa.string()),
             pa.array([most[i].hex() for i in has], pa.string())], ["i", "size", "rows", "least", "most"])
    return run


def _histogram(keys: DataFrame, probes: list[int]) -> dict[int, tuple]:
    """Interval number -> bytes, rows, least and greatest key; one row an interval reaches the driver."""
    parts = keys.mapInArrow(_count(probes), "i long, size long, rows long, least string, most string")
    found = parts.groupBy("i").agg(F.sum("size"), F.sum("rows"), F.min("least"), F.max("most")).collect()
    return {r[0]: (r[1], r[2], int(r[3], 16), int(r[4], 16)) for r in found}


def splitters(keys: DataFrame, n: int, tolerance: float, parts: int = 1) -> tuple[list[int], list[int]]:
    """Splitters over staged (k1, k2, size) rows into n shards of ``parts`` ranges each, and the
    rows of each range.  The shards' splitters come first, by the size of a shard alone, so they
    are the same for any ``parts``; the others lie evenly between those."""
    whole = _histogram(keys, [])
    if not whole:
        return [0] * (n * parts - 1), [0] * n * parts
    total, _, low, high = whole[0]
    outer = _search(keys, low, high, total, [total * i // n for i in range(1, n)], tolerance * total / n)
    edges = [(low, 0), *outer, (high + 1, total)]
    if parts > 1:
        inner = [a + (z - a) * k // parts for (_, a), (_, z) in zip(edges, edges[1:]) for k in range(1, parts)]
        found = iter(_search(keys, low, high, total, inner, tolerance * total / (n * parts)))
        # within its shard: a group of equal texts that is at its edge is the whole of a range
        edges = [e for lo, hi in zip(edges, edges[1:]) for e in (lo, *(min(max(next(found), lo), hi) for _ in range(parts - 1)))] + edges[-1:]
    done = [at for at, _ in edges[1:-1]]
    counts = _histogram(keys, done)
    return done, [counts[i][1] if i in counts else 0 for i in range(n * parts)]


def _search(keys: DataFrame, low: int, high: int, total: int, targets: list[int], slack: float) -> list[tuple[int, int]]:
    """(splitter, bytes below it) for each target, in order; each within ``slack`` or next to the key across it."""
    # bounds of each splitter: keys below lo hold below_lo bytes, keys below hi below_hi
    bounds = [[low, 0, high + 1, total] for _ in targets]
    done: list = [None] * len(targets)
    while not all(d is not None for d in done):
        probes = set()
        for b, d in zip(bounds, done):
            if d is None:
                lo, hi = b[0], b[2]
                step = 1 << 64 if lo >> 64 != (hi - 1) >> 64 else 1      # group edges first, then inside a group
                a, z = lo // step + 1, (hi - 1) // step
                count = z - a + 1
                probes |= {(a + (z - a) * k // max(1, min(PROBES, count) - 1)) * step for k in range(min(PROBES, count))} if count > 0 else set()
        probes = sorted(probes)
        found = _histogram(keys, probes)
        below, edges = 0, []
        for i in range(len(probes) + 1):
            if i in found:
                size, _, least, most = found[i]
                edges.append((least, below))             # all keys under ``least`` hold ``below`` bytes
                below += size
                edges.append((most + 1, below))
        for j, t in enumerate(targets):
            if done[j] is not None:
                continue
            cut = bisect.bisect_right(edges, t, key=lambda e: e[1])      # edges ascend in key and bytes
            lo = max([*edges[max(0, cut - 1):cut], tuple(bounds[j][:2])], key=lambda e: (e[1], e[0]))
            hi = min([*edges[cut:cut + 1], tuple(bounds[j][2:])], key=lambda e: (e[1], e[0]))
            near = min((lo, hi), key=lambda e: abs(e[1] - t))
            if abs(near[1] - t) <= slack or hi[0] - lo[0] <= 1:     # near enough, or a single key between
                done[j] = near
            bounds[j] = [lo[0], lo[1], hi[0], hi[1]]
    return sorted(done)


def _assign(at_splitters: list[int], per_shard: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.array([_probe(p) for p in at_splitters], "S16")
        for batch in batches:
            where = np.searchsorted(at, _keys(_column(batch, 0), _column(batch, 1)), "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(where)], [*batch.schema.names, "range"])
    return run


def _slots(first: list[int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            ranges = batch.column(batch.num_columns - 1).to_numpy()
            slot = np.empty(len(ranges), np.int64)
            for r in np.unique(ranges):
                here = ranges == r
                at = seen.get(int(r), first[r])
                slot[here] = at + np.arange(int(here.sum()))
                seen[int(r)] = at + int(here.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(slot)], [*batch.schema.names, "slot"])
    return run


def shard(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", tolerance: float = 0.01) -> DataFrame:
    """(row: struct of the columns of ``docs``, size, shard, slot)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    keyed = docs.select(F.xxhash64(text).alias("k1"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-1 << 63)).alias("k2"),
                        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
                        row_hash(docs).alias("k3"),
                        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    keys = stage(keyed.select("k1", "k2", "size"), "llm-keys")
    per_shard = -(-shuffle_partitions(spark) // n_shards)
    at, rows = splitters(keys, n_shards, tolerance, per_shard)
    first = [sum(rows[r - r % per_shard:r]) for r in range(len(rows))]
    ranged = keyed.mapInArrow(_assign(at, per_shard), StructType([*keyed.schema.fields, StructField("range", IntegerType())]))
    dealt = ranged.repartitionById(n_shards * per_shard, "range").sortWithinPartitions("range", "k1", "k2", "k3")
    slotted = dealt.mapInArrow(_slots(first), StructType([*ranged.schema.fields, StructField("slot", LongType())]))
    return slotted.select("row", "size", F.floor(F.col("range") / per_shard).cast("int").alias("shard"), "slot")


def shard_digest(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("row.text").cast("binary"), F.lit(b""))
    return shard(docs, 40).select("row.doc_id", "size", F.crc32(text).alias("text_crc32"), F.lit("bytes").alias("law"),
                                  "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
