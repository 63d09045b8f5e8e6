"""Operator 9: suffix-array dedup with a logarithmic family of index levels.

Removes every byte covered by a string of ``length`` bytes that also starts anywhere
else, exactly.  A suffix array over every byte would be some thirty times the
compressed input, so the arrays are sparse: suffixes are kept at sampled places only,
the least hash of ANCHOR bytes in every window of ``length`` bytes (its first such
place).  Equal strings of ``length`` bytes have the same place sampled, so equal
strings always meet.  One sampled suffix answers for a run of window starts; two
64-bit digests order it: one of its ANCHOR bytes, and one of the whole context, the
bytes of all the run's windows.  Neighbours in that order that agree on both repeat
every window of the run; those that agree on the first alone may repeat some.

Each task takes its share of the suffixes in batches as they arrive.  A batch becomes
a sorted array, levels of equal size merge (1, 2, 4 .. batches), so that every suffix
is merged a logarithmic number of times, and the last merge is scanned for neighbours
that agree.  Suffixes are dealt by both digests first, then one row of an anchor from
each task by the anchor alone, so a passage that a third of all texts share is no task
of its own.

Runs that may repeat in part are settled in a second round.  Their window starts are
cut into buckets of eight at fixed distances from the sampled place; the windows of a
bucket share all but seven bytes at either end, so a digest of the shared bytes and
those 14 bytes tell, for each start, which windows are equal, without the text.

Texts are known by a 64-bit digest and their size, so copies of a text are one text
that occurs often; repeated rows need no number of their own, and a task that runs
again makes the same rows.

Defined results: a null text counts as empty; texts shorter than ``length`` keep all
bytes; texts of any length are read whole; an empty table gives an empty table; ids
may be null; only the named columns are read, so further columns may have any name.
A cut that would split a UTF-8 character is made by bytes, as asked; ``dedup`` drops
the split character's other bytes, so that texts stay valid.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tidepool.llm.common import ragged, small_batches, stage

LENGTH = 200
ANCHOR = 64
BUCKET = 8
PIECE = 2 << 20     # bytes of text hashed at a time
HELD = 1 << 20      # suffixes that a scan task compares before it sends them

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE_BITS = np.uint64(24)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Hasher:
    """Digests of any substrings of a piece of text, from sums of byte codes times powers."""

    def __init__(self, room: int):
        self.codes = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
        self.power = np.cumprod(np.r_[np.uint64(1), np.full(room, _BASE, np.uint64)])
        self.back = np.cumprod(np.r_[np.uint64(1), np.full(room, _INVERSE, np.uint64)])

    def load(self, data: np.ndarray) -> None:
        n = len(data)
        if n >= len(self.power):
            self.__init__(n)
        self.sums = np.empty(n + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(self.codes[data] * self.power[:n], out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start])

    def all_of(self, k: int) -> np.ndarray:
        return _mix((self.sums[k:] - self.sums[:-k]) * self.back[:len(self.sums) - k])


def sample(hasher: Hasher, ends: np.ndarray, sizes: np.ndarray, length: int, anchor: int):
    """(sampled place, first start, last start) of each run of window starts, for texts
    that lie one after another in the loaded piece."""
    n = int(ends[-1]) if len(ends) else 0
    none = np.empty(0, np.int64)
    if n < length:
        return none, none, none
    span = length - anchor + 1
    keys = hasher.all_of(anchor)
    keys >>= _PLACE_BITS
    keys <<= _PLACE_BITS
    keys |= np.arange(len(keys), dtype=np.uint64)      # the first of equal hashes is the least
    least, reach = keys, 1
    while 2 * reach <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < span:
        least = np.minimum(least[:len(least) - (span - reach)], least[span - reach:])
    starts = np.arange(len(least))
    inside = starts + length <= np.repeat(ends, sizes)[:len(least)]
    starts = starts[inside]
    if not len(starts):
        return none, none, none
    place = (least[inside] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)])
    last = np.r_[new[1:], len(starts)] - 1
    return place[new], starts[new], starts[last]


def _pieces(batches: Iterator[pa.RecordBatch], before: int, after: int) -> Iterator[tuple]:
    """Rows whose texts come last, about PIECE bytes at a time: (rows, whole sizes, sizes as
    loaded, first byte loaded, starts taken from, to, bytes).  Texts longer than PIECE come
    in parts that take PIECE starts each and load some bytes ``before`` and ``after``."""
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        i = 0
        while i < len(sizes):
            if sizes[i] > PIECE:
                rows = batch.slice(i, 1)
                for lo in range(0, int(sizes[i]), PIECE):
                    a, b = max(0, lo - before), min(int(sizes[i]), lo + PIECE + after)
                    yield (rows, sizes[i:i + 1], np.array([b - a]), np.array([a]), np.array([lo]), np.array([lo + PIECE]),
                           data[offsets[i] + a:offsets[i] + b])
                i += 1
                continue
            long = np.flatnonzero(sizes[i:] > PIECE)
            j = min(int(np.searchsorted(offsets, offsets[i] + PIECE, "right")) - 1, i + int(long[0]) if len(long) else len(sizes))
            zero = np.zeros(j - i, np.int64)
            yield batch.slice(i, j - i), sizes[i:j], sizes[i:j], zero, zero, sizes[i:j], data[offsets[i]:offsets[j]]
            i = j


# A place in a text: start << 16 | (last start - start) << 8 | (sampled place - start).
def _spot(start, last, place):
    return start << 16 | (last - start) << 8 | (place - start)


SUFFIX_SCHEMA = "k1 long, k2 long, times int, key long, n_bytes int, spot long"


def _one_of_each(k1, k2, key, size, spot) -> pa.RecordBatch:
    """Suffixes that agree on both digests as one row with ``times`` 2; the others of them
    as known repeats (k2 null, dealt by their text), once for copies of a text."""
    order = np.lexsort((spot, key, k2, k1))
    same = np.r_[False, (k1[order][1:] == k1[order][:-1]) & (k2[order][1:] == k2[order][:-1])]
    copy = np.r_[False, (key[order][1:] == key[order][:-1]) & (spot[order][1:] == spot[order][:-1])] & same
    heads = np.flatnonzero(~same)
    times = np.minimum(np.diff(np.r_[heads, len(order)]), 2).astype(np.int32)
    out, rest = order[heads], order[same & ~copy]
    return pa.RecordBatch.from_arrays([
        pa.array(np.r_[k1[out], key[rest]]),
        pa.array(np.r_[k2[out], key[rest]], mask=np.r_[np.zeros(len(out), bool), np.ones(len(rest), bool)]),
        pa.array(np.r_[times, np.full(len(rest), 2, np.int32)]),
        pa.array(key[np.r_[out, rest]]), pa.array(size[np.r_[out, rest]].astype(np.int32)), pa.array(spot[np.r_[out, rest]])],
        ["k1", "k2", "times", "key", "n_bytes", "spot"])


def _suffixes(length: int, anchor: int) -> Callable:
    """Rows (key, text) to sampled suffixes, equal ones of up to HELD rows as one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(PIECE + length)
        held, n = [], 0
        for rows, whole, sizes, base, _, _, data in _pieces(batches, 0, length - 1):
            hasher.load(data)
            ends = np.cumsum(sizes)
            place, first, last = sample(hasher, ends, sizes, length, anchor)
            if not len(place):
                continue
            k1 = hasher.of(place, place + anchor)
            k2 = hasher.of(first, last + length) ^ _mix((place - first << 8 | last - first).astype(np.uint64))
            text = np.searchsorted(ends, first, "right")
            shift = (ends - sizes - base)[text]
            held.append((k1.view(np.int64), k2.view(np.int64), rows.column(0).to_numpy()[text], whole[text],
                         _spot(first - shift, last - shift, place - shift)))
            n += len(place)
            if n >= HELD:
                yield _one_of_each(*map(np.concatenate, zip(*held)))
                held, n = [], 0
        if held:
            yield _one_of_each(*map(np.concatenate, zip(*held)))
    return run


class Levels:
    """Sorted arrays of suffixes, of 1, 2, 4 .. batches; equal sizes merge."""

    def __init__(self, by: tuple):
        self.by, self.levels = by, []

    def add(self, rows: np.ndarray, size: int = 1) -> None:
        rows = rows[np.lexsort(tuple(rows[c] for c in self.by[::-1]))]
        while self.levels and self.levels[-1][0] == size:
            size, rows = 2 * size, self.merged(self.levels.pop()[1], rows)
        self.levels.append((size, rows))

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        rows = np.concatenate([a, b])      # two sorted runs: a stable sort merges them
        return rows[np.lexsort(tuple(rows[c] for c in self.by[::-1]))]

    def all(self) -> np.ndarray | None:
        while len(self.levels) > 1:
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append((a[0] + b[0], self.merged(a[1], b[1])))
        return self.levels[0][1] if self.levels else None


SUFFIX = np.dtype([("k1", "i8"), ("k2", "i8"), ("key", "i8"), ("spot", "i8"), ("n_bytes", "i4"), ("times", "i4")])
# Window starts a..b of a text repeat; or, with b -1, the run at spot a may repeat in part.
FACT_SCHEMA = "key long, n_bytes int, a long, b long"


def _facts(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (rows["key"], rows["n_bytes"], a, b)], ["key", "n_bytes", "a", "b"])


def _known(rows: np.ndarray) -> pa.RecordBatch:
    first = rows["spot"] >> 16
    return _facts(rows, first, first + (rows["spot"] >> 8 & 255))


def _in_part(rows: np.ndarray) -> pa.RecordBatch:
    return _facts(rows, rows["spot"], np.full(len(rows), -1))


CONTEXT_SCHEMA = "k1 long, open int, " + FACT_SCHEMA


def _scan_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All suffixes of each context (k1, k2) of one task.  Runs of a context that occurs
    twice repeat whole: facts.  Of the other runs, those of an anchor (k1) that has several
    contexts in this task may repeat in part: facts too, and one row (open 0) tells the rest
    of the anchor's contexts.  An anchor's only context here goes on to meet the others
    (open 1).  So an anchor of any number of contexts is one row a task afterwards."""
    def rows_out(facts: pa.RecordBatch, k1, open_=None) -> pa.RecordBatch:
        n = facts.num_rows
        opened = pa.nulls(n, pa.int32()) if open_ is None else pa.array(np.full(n, open_, np.int32))
        return pa.RecordBatch.from_arrays([pa.array(k1), opened, *facts.columns], ["k1", "open", *facts.schema.names])

    levels = Levels(("k1", "k2", "key", "spot"))
    for batch in batches:
        rows = np.empty(batch.num_rows, SUFFIX)
        known = np.asarray(batch.column(1).is_null())
        for i, c in enumerate(batch.schema.names):
            rows[c] = batch.column(i).fill_null(0).to_numpy()
        if known.any():
            yield rows_out(_known(rows[known]), rows["key"][known])
        levels.add(rows[~known])
    rows = levels.all()
    if rows is None or not len(rows):
        return
    new1 = np.r_[True, rows["k1"][1:] != rows["k1"][:-1]]
    new2 = new1 | np.r_[True, rows["k2"][1:] != rows["k2"][:-1]]
    new_place = new2 | np.r_[True, (rows["key"][1:] != rows["key"][:-1]) | (rows["spot"][1:] != rows["spot"][:-1])]
    anchor, context = np.cumsum(new1) - 1, np.cumsum(new2) - 1
    whole = (np.bincount(context, rows["times"]) > 1)[context]
    several = (np.bincount(anchor[new2]) > 1)[anchor]
    for at in range(0, len(rows), 1 << 16):
        part = slice(at, at + (1 << 16))
        r, is_whole, is_several, first1, first2 = rows[part], whole[part], several[part], new1[part], new2[part]
        known = is_whole & new_place[part]          # copies of a text name the same place: once
        yield rows_out(_known(r[known]), r["key"][known])
        in_part = r[is_several & first2]            # one run of each context, whole or not
        yield rows_out(_in_part(in_part), in_part["key"])
        told, alone = r[is_several & first1], r[~is_several & first2]
        yield rows_out(_in_part(told), told["k1"], 0)
        yield rows_out(_in_part(alone), alone["k1"], 1)


ANCHOR_ROW = np.dtype([("k1", "i8"), ("open", "i4"), ("n_bytes", "i4"), ("key", "i8"), ("a", "i8"), ("b", "i8")])


def _scan_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contexts of each anchor that were alone in their task: those with others beside
    them may repeat in part.  Facts pass through."""
    levels = Levels(("k1",))
    for batch in batches:
        fact = np.asarray(batch.column(1).is_null())
        yield pa.RecordBatch.from_arrays([c.filter(pa.array(fact)) for c in batch.columns[2:]], ["key", "n_bytes", "a", "b"])
        rows = np.empty(batch.num_rows, ANCHOR_ROW)
        for i, c in enumerate(batch.schema.names):
            rows[c] = batch.column(i).fill_null(0).to_numpy()
        levels.add(rows[~fact])
    rows = levels.all()
    if rows is None or not len(rows):
        return
    anchor = np.cumsum(np.r_[True, rows["k1"][1:] != rows["k1"][:-1]]) - 1
    rows = rows[(np.bincount(anchor) > 1)[anchor] & (rows["open"] == 1)]
    for at in range(0, len(rows), 1 << 16):
        r = rows[at:at + (1 << 16)]
        yield _facts(r, r["a"], r["b"])


def _per_text(reach: int) -> Callable:
    """Facts sorted by text to one row a text: ``known``, its a..b as pairs, those not more
    than ``reach`` apart as one, and ``todo``, the runs to settle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((4, 0), np.int64)       # the last text, as far as it has come
        for batch in chain(batches, [None]):
            if batch is not None:
                held = np.concatenate([held, np.stack([c.to_numpy().astype(np.int64) for c in batch.columns])], axis=1)
            if not held.shape[1]:
                continue
            new = np.flatnonzero(np.r_[True, (held[:2, 1:] != held[:2, :-1]).any(axis=0)])
            done = held.shape[1] if batch is None else int(new[-1])
            (key, size, a, b), held = held[:, :done], held[:, done:]
            heads = new[new < done]
            text = np.searchsorted(heads, np.arange(done), "right") - 1
            runs = b >= 0
            order = np.lexsort((a[runs], text[runs]))
            t, start = text[runs][order], a[runs][order]
            upto = np.maximum.accumulate((t << 40) + b[runs][order])     # the furthest b so far, text by text
            fresh = np.r_[True, (t[1:] << 40) + start[1:] > upto[:-1] + reach][:len(t)]
            at = np.flatnonzero(fresh)
            pairs = np.stack([start[at], upto[np.r_[at[1:], len(t)] - 1] & ((1 << 40) - 1)], 1) if len(at) else np.empty((0, 2), np.int64)
            todo = np.unique(np.stack([text[~runs], a[~runs]], 1), axis=0)
            yield pa.RecordBatch.from_arrays([
                pa.array(key[heads]), pa.array(size[heads].astype(np.int32)),
                _lists(2 * np.bincount(t[at], minlength=len(heads)), pairs.reshape(-1)),
                _lists(np.bincount(todo[:, 0], minlength=len(heads)), todo[:, 1])],
                ["key", "n_bytes", "known", "todo"])
    return run


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(values, pa.int64()))


TEXT_SCHEMA = "key long, n_bytes int, known array<long>, todo array<long>"
BUCKET_SCHEMA = "core long, before long, after long, key long, n_bytes int, spot long"


def _without_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, todo, n_bytes, ..) of a merge join, where copies of a text follow each other, once for each text."""
    last = None
    for batch in batches:
        if batch.num_rows:
            text = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in (0, 2)])
            fresh = np.r_[last is None or (text[:, 0] != last).any(), (text[:, 1:] != text[:, :-1]).any(axis=0)]
            last = text[:, -1].copy()
            yield batch if fresh.all() else batch.filter(pa.array(fresh))


def _buckets(length: int) -> Callable:
    """Rows (key, todo, .., text) to buckets of window starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(PIECE + length + 1024)
        for rows, whole, sizes, base, lo, hi, data in _pieces(_without_copies(batches), 512, length + 512):
            todo = rows.column(1)
            spot = todo.flatten().to_numpy()
            text = np.repeat(np.arange(len(sizes)), pc.list_value_length(todo).to_numpy())
            own = (spot >> 16 >= lo[text]) & (spot >> 16 < hi[text])
            spot, text = spot[own], text[own]
            offset = (np.cumsum(sizes) - sizes - base)[text]
            first = spot >> 16
            last, place = first + (spot >> 8 & 255), first + (spot & 255)
            # buckets by distance before the sampled place, the same for every text
            low, high = (place - last) // BUCKET, (place - first) // BUCKET
            each = ragged(low, high - low + 1)
            run_of = np.repeat(np.arange(len(spot)), high - low + 1)
            place, offset, text = place[run_of], offset[run_of], text[run_of]
            begin = place - each * BUCKET - (BUCKET - 1)       # the bucket's first start, may lie before the run
            lo = np.maximum(first[run_of], begin)
            hi = np.minimum(last[run_of], begin + BUCKET - 1)
            hasher.load(data)
            core = hasher.of(offset + begin + BUCKET - 1, offset + begin + length) ^ _mix(each.astype(np.uint64))
            padded = np.r_[np.zeros(BUCKET, np.uint8), data, np.zeros(BUCKET, np.uint8)].astype(np.int64)
            before = np.zeros(len(each), np.int64)
            after = np.zeros(len(each), np.int64)
            for i in range(BUCKET - 1):      # bytes outside the run's windows are never compared
                before |= np.where(begin + i >= lo, padded[offset + begin + i + BUCKET], 0) << (8 * i)
                after |= np.where(begin + i < hi, padded[np.minimum(offset + begin + length + i + BUCKET, len(padded) - 1)], 0) << (8 * i)
            yield pa.RecordBatch.from_arrays([
                pa.array(core.view(np.int64)), pa.array(before), pa.array(after),
                pa.array(rows.column(0).to_numpy()[text]), pa.array(whole[text].astype(np.int32)),
                pa.array(begin + BUCKET << 16 | (lo - begin) << 8 | (hi - begin))],
                ["core", "before", "after", "key", "n_bytes", "spot"])
    return run


PARTIAL = np.dtype([("core", "i8"), ("before", "i8"), ("after", "i8"), ("key", "i8"), ("spot", "i8"), ("n_bytes", "i4")])


def _scan_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each start of a bucket: equal core, bytes before and bytes after it make equal windows."""
    levels = Levels(("core",))
    for batch in batches:
        rows = np.empty(batch.num_rows, PARTIAL)
        for i, c in enumerate(batch.schema.names):
            rows[c] = batch.column(i).to_numpy()
        levels.add(rows)
    rows = levels.all()
    if rows is None or not len(rows):
        return
    count = np.diff(np.r_[np.flatnonzero(np.r_[True, rows["core"][1:] != rows["core"][:-1]]), len(rows)])
    rows = rows[np.repeat(count, count) > 1]
    # copies of a text bring equal rows: one of each
    order = np.lexsort((rows["spot"], rows["n_bytes"], rows["key"], rows["core"]))
    rows = rows[order]
    if not len(rows):
        return
    rows = rows[np.r_[True, (rows["core"][1:] != rows["core"][:-1]) | (rows["key"][1:] != rows["key"][:-1])
                      | (rows["n_bytes"][1:] != rows["n_bytes"][:-1]) | (rows["spot"][1:] != rows["spot"][:-1])]]
    begin = (rows["spot"] >> 16) - BUCKET
    lo, hi = rows["spot"] >> 8 & 255, rows["spot"] & 255
    for t in range(BUCKET):
        has = np.flatnonzero((lo <= t) & (t <= hi))
        # the window at start begin + t takes bytes t.. of those before the core and the first t after the bucket's first window
        before = rows["before"][has] >> (8 * t)
        after = rows["after"][has] & ((1 << (8 * t)) - 1)
        core = rows["core"][has]
        order = np.lexsort((after, before, core))
        same = (core[order][1:] == core[order][:-1]) & (before[order][1:] == before[order][:-1]) & (after[order][1:] == after[order][:-1])
        twice = order[np.r_[False, same] | np.r_[same, False]]
        twice = has[twice]
        yield _facts(rows[twice], begin[twice] + t, begin[twice] + t)


def cuts(docs: DataFrame, row, text_col: str, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(row, text as bytes, known): every document, with the (first, last) window starts
    of its text that repeat, null if none does."""
    if not 0 < anchor <= length <= anchor + 255:
        raise ValueError("length must lie in anchor .. anchor + 255: places keep their distances in 8 bits")
    blob = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    keyed = docs.select(F.xxhash64(blob).alias("key"), F.octet_length(blob).alias("n_bytes"), row.alias("row"), blob.alias("text"))
    suffixes = keyed.select("key", "text").mapInArrow(_suffixes(length, anchor), SUFFIX_SCHEMA)
    contexts = suffixes.repartition("k1", "k2").mapInArrow(_scan_contexts, CONTEXT_SCHEMA)
    facts = contexts.repartition("k1").mapInArrow(_scan_anchors, FACT_SCHEMA)

    def by_text(facts, reach):
        return (facts.repartition("key", "n_bytes").sortWithinPartitions("key", "n_bytes")
                .mapInArrow(_per_text(reach), TEXT_SCHEMA))

    texts = stage(by_text(facts, 1), "llm-repeats")
    # Both joins with the documents read all columns of ``keyed``: one exchange of the texts serves both.
    # The hints keep that plan at small sizes too.
    todo = keyed.join(texts.where(F.size("todo") > 0).select("key", "n_bytes", "todo").hint("merge"), ["key", "n_bytes"])
    buckets = todo.select("key", "todo", "n_bytes", "row", "text").mapInArrow(_buckets(length), BUCKET_SCHEMA)
    more = buckets.repartition("core").mapInArrow(_scan_buckets, FACT_SCHEMA)
    pairs = F.expr("transform(sequence(0, size(known) - 1, 2), i -> struct(known[i] AS a, known[i + 1] AS b))")
    known = (texts.where(F.size("known") > 0).select("key", "n_bytes", F.explode_outer(pairs).alias("r"))
             .select("key", "n_bytes", "r.a", "r.b"))
    spans = by_text(known.unionByName(more), length).select("key", "n_bytes", "known")
    return keyed.join(spans.hint("merge"), ["key", "n_bytes"], "left").select("row", "text", "known")


def _cut(length: int, whole_characters: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 512):
            kept, n_removed, n_spans = [], [], []
            for text, known in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                out, at, spans = [], 0, 0
                for first, last in zip(known[::2], known[1::2]) if known else ():
                    a, b = first, last + length
                    if a > at or not spans:
                        out.append(text[at:a])
                        spans += 1
                    at = b
                if known:
                    out.append(text[at:])
                    text, n = b"".join(out), len(text)
                    n_removed.append(n - len(text))
                    if whole_characters:
                        text = b"".join(p.decode("utf-8", "ignore").encode() for p in out)
                else:
                    n_removed.append(0)
                n_spans.append(spans)
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64())],
                ["row", "kept", "n_removed", "n_spans"])
    return run


def remove_repeats(docs: DataFrame, row, text_col: str = "text", length: int = LENGTH, whole_characters: bool = False) -> DataFrame:
    """(row, kept, n_removed, n_spans) of every document; ``kept`` is the rest of its bytes."""
    found = cuts(docs, row, text_col, length)
    fields = [found.schema["row"], StructField("kept", BinaryType()), StructField("n_removed", LongType()), StructField("n_spans", LongType())]
    return found.mapInArrow(_cut(length, whole_characters), StructType(fields))


def dedup(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated strings cut from the text; a null text stays null."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col], F.col(f"`{text_col}`").isNull().alias("__none"))
    rest = remove_repeats(docs, row, text_col, length, whole_characters=True)
    text = F.when(~F.col("row").getField("__none"), F.col("kept").cast("string"))
    return rest.select([text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])


def repeats_digest(docs: DataFrame) -> DataFrame:
    found = remove_repeats(docs, F.struct("doc_id"))
    return found.select("row.doc_id", (F.octet_length("kept") + F.col("n_removed")).alias("n_bytes"), "n_removed", "n_spans",
                        F.sha2("kept", 256).alias("kept_sha256"))
