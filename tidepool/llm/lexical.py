"""Ranked lexical search by pipelined term partitioning.

The terms of the items are dealt to a few owners by a hash.  One pass over the documents
writes, for each block of documents, its lengths and one posting list per owner and item
bundle.  Bundles then travel: an item bundle carries its sparse accumulators (item,
document, score so far) of a block from owner to owner, and at each owner a cogroup by
(bundle, block) adds the integer contributions of that owner's postings.  After the last
owner a task keeps the best documents of each item, and a window picks among the tasks.

Scores are whole numbers.  A term in ``df`` of the ``N`` documents that hold any term
weighs ``w = floor(1000 ln((2N+2) / (2df+1)))``; a document with ``n`` of all ``L`` terms
has ``m = 75 + 25nN div L``; an item's score sums ``w ((10^9 tf) div (1000 tf + 12 m))``
over its terms, repeats included.

Bounds: a block has 2,048 documents at most, a bundle 256 items, so an accumulator has
half a million cells.  What travels with the tasks are the terms of the items of one
pass, 16 MB of item text at most (one longer item goes alone); more items take more
passes over the documents.  No posting list is ever whole in a task: a word that every
document has is a list per block.

Nulls, empty texts and texts without a term have no terms: such a document is not counted
and such an item has no rows.  A document without an id counts in N, L and df but cannot
be returned.  Of equal (id, text) items one is searched; equal document rows are documents
each.  Ties go to the smaller id.  Further columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import pack, small_batches, stage, unpack

# Fixed by the definition of a term: what is neither an ASCII digit or letter nor beyond ASCII separates.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

OWNERS = 4
BLOCK_DOCS, BLOCK_BYTES = 2048, 8 << 20
BUNDLE_ITEMS, PASS_BUNDLES, PASS_BYTES = 256, 32, 16 << 20
HEAD, STATS = -1, -2                       # rows of a block's documents, and of a task's counts

POSTED = "owner int, bundle int, block long, n long, total long, a binary, b binary, c binary"
ACC = "bundle int, block long, ids binary, lens binary, cells binary, scores binary"


def terms(text: str | None) -> list[bytes]:
    return TERM.findall(text.encode().translate(LOWER)) if text else []


class _Items:
    """The items of one pass: bounded, and shipped with the tasks."""

    def __init__(self, rows: list[tuple[int | None, str | None]], owners: int):
        self.owners, self.ids = owners, [i for i, _ in rows]
        self.vocabulary: dict[bytes, int] = {}
        wanted = []                                    # (bundle, owner) -> [(term, item within the bundle, repeats)]
        for no, (_, text) in enumerate(rows):
            for term, times in Counter(terms(text)).items():
                wanted.append((no // BUNDLE_ITEMS, zlib.crc32(term) % owners,
                               self.vocabulary.setdefault(term, len(self.vocabulary)), no % BUNDLE_ITEMS, times))
        self.pairs: dict[tuple[int, int], np.ndarray] = {}
        for b, o, t, i, times in sorted(wanted):
            self.pairs.setdefault((b, o), []).append((t, i, times))
        self.pairs = {k: np.array(v, np.int64) for k, v in self.pairs.items()}
        self.bundles = -(-len(rows) // BUNDLE_ITEMS)

    def size(self, bundle: int) -> int:
        return min(BUNDLE_ITEMS, len(self.ids) - bundle * BUNDLE_ITEMS)


def _row_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    names = ["owner", "bundle", "block", "n", "total", "a", "b", "c"]
    cols = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def _post(items: _Items):
    """Documents to blocks: a head per bundle, and a posting list per bundle and owner; counts once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = items.vocabulary, items.vocabulary.keys()
        held = {k: np.unique(v[:, 0]) for k, v in items.pairs.items()}
        df = np.zeros(len(vocabulary), np.int64)
        block, with_terms, total = TaskContext.get().partitionId() << 32, 0, 0
        ids, lens, found, size = [], [], [], 0

        def flush():
            nonlocal block
            doc = np.repeat(np.arange(len(found), dtype=np.uint16), [len(x) for x in found])
            term = np.concatenate([np.array(x, np.int64)[:, 0] if x else np.empty(0, np.int64) for x in found])
            tf = np.concatenate([np.array(x, np.int64)[:, 1] if x else np.empty(0, np.int64) for x in found])
            order = np.argsort(term, kind="stable")
            term, doc, tf = term[order], doc[order], tf[order]
            rows = [(HEAD, b, block, None, None, pack(np.array(ids, np.int64)), pack(np.array(lens, np.int64)), None)
                    for b in range(items.bundles)]
            for (b, owner), mine in held.items():
                at = np.isin(term, mine)
                if at.any():
                    rows.append((owner, b, block, None, None, pack(term[at].astype(np.int32)), pack(doc[at]), pack(tf[at])))
            block += 1
            return _row_batch(rows)

        for batch in small_batches(batches, 256):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = terms(text)
                if not words:
                    continue
                with_terms, total = with_terms + 1, total + len(words)
                often = Counter(words)
                hits = [(vocabulary[t], often[t]) for t in known & often.keys()]
                if hits:
                    df[[t for t, _ in hits]] += 1
                if doc is None or not hits:
                    continue
                ids.append(doc)
                lens.append(len(words))
                found.append(hits)
                size += len(text)
                if len(ids) == BLOCK_DOCS or size > BLOCK_BYTES:
                    yield flush()
                    ids, lens, found, size = [], [], [], 0
        if ids:
            yield flush()
        at = np.flatnonzero(df)
        yield _row_batch([(STATS, 0, 0, with_terms, total, pack(at), pack(df[at]), None)])

    return run


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, df in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(unpack(at, np.int64)), pa.array(unpack(df, np.int64))], ["term", "df"])


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def lengths(n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """m of documents with n terms each; the product may pass 64 bits in a very large corpus."""
    if len(n) and int(n.max()) * 25 * n_docs >= 1 << 63:
        return np.array([75 + 25 * int(x) * n_docs // total for x in n], np.int64)
    return 75 + 25 * n * n_docs // total


def _add(items: _Items, owner: int, weight: np.ndarray, n_docs: int, total: int):
    """One owner's stage: a bundle's accumulators of a block and the owner's postings for them."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows:
            return left
        bundle, row, post = left["bundle"][0].as_py(), left.to_pylist()[0], right.to_pylist()[0]
        n = unpack(row["lens"], np.int64)
        term, doc, tf = unpack(post["a"], np.int32), unpack(post["b"], np.uint16), unpack(post["c"], np.int64)
        gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * lengths(n, n_docs, total)[doc]))
        score = np.zeros(items.size(bundle) * len(n), np.int64)
        score[unpack(row["cells"], np.int32)] = unpack(row["scores"], np.int64)
        score = score.reshape(-1, len(n))
        pairs = items.pairs[bundle, owner]
        first, last = np.searchsorted(term, pairs[:, 0]), np.searchsorted(term, pairs[:, 0], "right")
        for (_, item, times), a, b in zip(pairs.tolist(), first.tolist(), last.tolist()):
            if a < b:
                score[item, doc[a:b]] += times * gain[a:b]       # a document is in a list once
        score = score.reshape(-1)
        cells = np.flatnonzero(score).astype(np.int32)
        return pa.table({"bundle": left["bundle"], "block": left["block"], "ids": left["ids"], "lens": left["lens"],
                         "cells": pa.array([pack(cells)], pa.binary()), "scores": pa.array([pack(score[cells])], pa.binary())})

    return run


def _best(items: _Items, k: int):
    """The k best documents of each item among the blocks that one task sees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def offer(item, ids, scores):
            if item in best:
                ids, scores = np.concatenate([best[item][0], ids]), np.concatenate([best[item][1], scores])
            order = np.lexsort((ids, -scores))[:k]
            best[item] = ids[order], scores[order]

        for batch in batches:
            for row in batch.to_pylist():
                ids, cells, scores = (unpack(row[c], t) for c, t in (("ids", np.int64), ("cells", np.int32), ("scores", np.int64)))
                if not len(cells):
                    continue
                item, doc = cells // len(ids), cells % len(ids)
                starts = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
                for a, b in zip(starts, [*starts[1:], len(item)]):
                    offer(row["bundle"] * BUNDLE_ITEMS + int(item[a]), ids[doc[a:b]], scores[a:b])
        for item, (ids, scores) in best.items():
            n = len(ids)
            yield pa.RecordBatch.from_arrays([pa.array([item] * n, pa.int32()), pa.array([items.ids[item]] * n, pa.int64()),
                                              pa.array(ids), pa.array(scores)], ["item", "item_id", "doc_id", "score"])

    return run


def _one_pass(docs: DataFrame, items: _Items, k: int) -> DataFrame:
    posted = stage(docs.mapInArrow(_post(items), POSTED), "llm-postings")
    stats = posted.where(F.col("owner") == STATS)
    n_docs, total = stats.agg(F.sum("n"), F.sum("total")).first()
    counts = stats.select("a", "b").mapInArrow(_counts, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(len(items.vocabulary), np.int64)
    for term, n in counts.collect():                       # a row for each term of this pass at most
        df[term] = n
    weight = weights(df, n_docs or 0)
    nothing = F.lit(pack(np.empty(0, np.int64)))
    acc = posted.where(F.col("owner") == HEAD).select("bundle", "block", F.col("a").alias("ids"), F.col("b").alias("lens"),
                                                      nothing.alias("cells"), nothing.alias("scores"))
    for owner in range(items.owners):
        mine = posted.where(F.col("owner") == owner).select("bundle", "block", "a", "b", "c")
        acc = acc.groupBy("bundle", "block").cogroup(mine.groupBy("bundle", "block")).applyInArrow(
            _add(items, owner, weight, n_docs, total), ACC)
    found = acc.select("bundle", "ids", "cells", "scores").mapInArrow(_best(items, k), "item int, item_id long, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 20, owners: int = OWNERS, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The k best documents of each item: (item_id, rank, doc_id, score), scores above 0 only."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    wanted = (items.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).cast("string").alias("text"))
              .where(F.col("text").isNotNull()).distinct().orderBy("id", "text"))
    results, held, size = [], [], 0
    for item in wanted.toLocalIterator():                  # a pass holds what its bounds allow, however many items there are
        n = len(item["text"].encode())
        if held and (len(held) == BUNDLE_ITEMS * PASS_BUNDLES or size + n > PASS_BYTES):
            results.append(_one_pass(rows, _Items(held, owners), k))
            held, size = [], 0
        held.append((item["id"], item["text"]))
        size += n
    if held or not results:
        results.append(_one_pass(rows, _Items(held, owners), k))
    out = results[0] if len(results) == 1 else stage(results[0], "llm-ranked")
    for more in results[1:]:
        out = out.unionByName(stage(more, "llm-ranked"))
    return out
