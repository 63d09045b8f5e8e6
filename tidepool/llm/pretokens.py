"""Distinct-word shuffle, shared by the tokenising operators.

Texts are cut into pre-tokens once.  Documents are taken in blocks of a bounded
size; a block keeps, for each document, the positions of its pre-tokens as codes
into the block's own list of distinct words (so a word is never repeated in what
moves), and that list goes, in parts dealt by the word's hash, to the task that
holds the word for the whole corpus.  There each distinct word is worked on
once, the results go back to the blocks, and documents are put together again by
position.  A word that makes up a third of all tokens is one row per block and
part, like any other.

Blocks and word lists leave in one exchange, by ``k`` (the block, or a negative
number for a part); both readers take all of its columns, so that Spark runs the
exchange once and the join by block finds the blocks where they are.  A block's
number holds a digest of its words: were a lost task to cut its rows otherwise
the second time (an input in no fixed order), the join would find no answer and
the job would fail, not go wrong.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import pack, ragged, shuffle_partitions, small_batches, unpack

# No byte of UTF-8 text is 0xFF, so it can stand between words.
SEPARATOR = b"\xff"

BLOCK_SCHEMA = "k long, block long, part int, first int, ids array<long>, counts binary, codes binary, words binary"
NAMES = ["k", "block", "part", "first", "ids", "counts", "codes", "words"]


def _cutter(pattern: str):
    # White space is the Unicode property, as in the library that reads the rank
    # files; the regex module's \s also takes \x1c-\x1f.
    spelled = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"(?!\S)", r"(?!\P{White_Space})").replace(r"\s", r"\p{White_Space}")
    return regex.compile(spelled)


def _cut_blocks(pattern: str, parts: int, block_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _cutter(pattern).findall
        seq = itertools.count(TaskContext.get().partitionId() << 32)

        def flush(ids, counts, codes, words):
            raw = [w.encode() for w in words]
            block = xxhash.xxh64_intdigest(SEPARATOR.join(raw), next(seq)) >> 1
            part = np.fromiter((zlib.crc32(b) % parts for b in raw), np.int32, len(raw))
            order = sorted(range(len(raw)), key=lambda i: (part[i], raw[i]))
            rank = np.empty(len(raw), np.uint32)
            rank[order] = np.arange(len(raw), dtype=np.uint32)
            flat = rank[np.concatenate(codes)] if codes else np.empty(0, np.uint32)
            rows = [(block, block, -1, 0, ids, pack(np.asarray(counts, np.uint32)), pack(flat), None)]
            cuts = part[order]
            starts = np.flatnonzero(np.r_[True, cuts[1:] != cuts[:-1]]) if len(cuts) else []
            for a, b in zip(starts, [*starts[1:], len(cuts)]):
                joined = SEPARATOR.join(raw[i] for i in order[a:b])
                rows.append((-1 - int(cuts[a]), block, int(cuts[a]), int(a), None, None, None,
                             len(joined).to_bytes(8, "little") + pa.compress(joined, codec="zstd", asbytes=True)))
            cols = list(zip(*rows))
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], NAMES)

        ids, counts, codes, size = [], [], [], 0
        words: dict = defaultdict(itertools.count().__next__)
        for batch in small_batches(batches, 256):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = "" if text is None else text
                if ids and size + len(text) > block_bytes:
                    yield flush(ids, counts, codes, words)
                    ids, counts, codes, size = [], [], [], 0
                    words = defaultdict(itertools.count().__next__)
                found = find(text)
                ids.append(doc)
                counts.append(len(found))
                codes.append(np.fromiter(map(words.__getitem__, found), np.uint32, len(found)))
                size += len(text)
        if ids:
            yield flush(ids, counts, codes, words)

    return run


def cut(docs: DataFrame, pattern: str, id_col: str = "doc_id", text_col: str = "text",
        block_bytes: int = 8 << 20) -> DataFrame:
    """Blocks of documents (part -1) and the parts of their word lists, dealt by k."""
    parts = 4 * shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_cut_blocks(pattern, parts, block_bytes), BLOCK_SCHEMA).repartition("k")


def _each_word(work: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solve, current = None, None
        known: dict[bytes, tuple[int, bytes]] = {}
        for batch in batches:
            cols = [batch.column(NAMES.index(c)).to_pylist() for c in ("part", "block", "first", "words")]
            out = []
            for part, block, first, packed in zip(*cols):
                if part < 0:
                    continue
                if part != current:       # rows come part by part: what is held is one part's words
                    known, current, solve = {}, part, work()
                n = int.from_bytes(packed[:8], "little")
                words = pa.decompress(packed[8:], decompressed_size=n, codec="zstd", asbytes=True).split(SEPARATOR)
                new = [w for w in words if w not in known]
                known.update(zip(new, solve(new)))
                got = [known[w] for w in words]
                lens = np.fromiter((g[0] for g in got), np.uint32, len(got))
                out.append((block, first, pack(lens), pack(np.frombuffer(b"".join([g[1] for g in got]), np.uint32))))
            cols = list(zip(*out)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                ["block", "first", "lens", "vals"])

    return run


def solve_words(blocks: DataFrame, work: Callable) -> DataFrame:
    """Each distinct word of the corpus once through ``work()``, a maker of a
    function from a sorted list of words to (number, uint32 values as bytes) for
    each; the answers, one row per block and part."""
    words = blocks.sortWithinPartitions("part", "block")
    return words.mapInArrow(_each_word(work), "block long, first int, lens binary, vals binary")


def _per_document(values: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            for ids, counts, codes, found in zip(*(batch.column(names.index(c)).to_pylist() for c in ("ids", "counts", "codes", "found"))):
                if ids is None:
                    continue
                found = sorted(found or [], key=lambda e: e["first"])
                lens = np.concatenate([unpack(e["lens"], np.uint32) for e in found] or [np.empty(0, np.uint32)]).astype(np.int64)
                codes, counts = unpack(codes, np.uint32), unpack(counts, np.uint32).astype(np.int64)
                if len(codes) and codes.max() >= len(lens):
                    raise ValueError("a block has no answers for its words: its input came in another order when read again")
                ends = np.cumsum(counts)
                each = lens[codes]
                upto = np.r_[0, np.cumsum(each)]
                per_doc = upto[ends] - upto[ends - counts]
                arrays = [pa.array(ids, pa.int64()), pa.array(counts), pa.array(per_doc)]
                if not values:
                    yield pa.RecordBatch.from_arrays(arrays, ["id", "n_words", "n"])
                    continue
                vals = np.concatenate([unpack(e["vals"], np.uint32) for e in found] or [np.empty(0, np.uint32)])
                starts = np.cumsum(lens) - lens
                # documents in runs of a few MB, so no Arrow batch holds a whole block
                cut_at, i = np.cumsum(per_doc), 0
                while i < len(ids):
                    j = max(i + 1, int(np.searchsorted(cut_at, (cut_at[i - 1] if i else 0) + (1 << 20), "right")))
                    w = slice(int(ends[i] - counts[i]), int(ends[j - 1]))
                    flat = vals[ragged(starts[codes[w]], each[w])].astype("<u4").tobytes()
                    offs = np.r_[0, np.cumsum(per_doc[i:j]) * 4].astype(np.int64)
                    body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(offs), pa.py_buffer(flat)])
                    yield pa.RecordBatch.from_arrays([a.slice(i, j - i) for a in arrays] + [body.cast(pa.binary())],
                                                     ["id", "n_words", "n", "vals"])
                    i = j

    return run


def reassemble(blocks: DataFrame, solved: DataFrame, values: bool) -> DataFrame:
    """Per document: id, number of words, sum of the words' numbers and, with
    ``values``, their values one after another (uint32, little-endian)."""
    answers = solved.groupBy("block").agg(F.collect_list(F.struct("first", "lens", "vals")).alias("found"))
    joined = blocks.join(answers.withColumnRenamed("block", "k"), "k", "left")
    return joined.mapInArrow(_per_document(values), "id long, n_words long, n long" + (", vals binary" if values else ""))
