"""Operator 4: substring dedup by hashing lines (or paragraphs), cut at punctuation.

A unit is a line or a paragraph; with ``clauses`` it is cut further after punctuation
marks, so that a passage which starts and ends inside other lines is caught as well.
Units are normalised (ASCII lower case, runs of white space as one space) and hashed to
128 bits.  Clauses under ``min_words`` words count only with their line: what lies between
the longer clauses is a unit named by the digest of the whole line and its place there.  So
a repeat of a line goes whole, whatever its words, and from other lines only longer clauses
go.  (A repeat of a line has an earlier line with all of its clauses, so to remove lines
first and clauses of the others after gives the same.)

All units with a digest form a
group; the earliest ranked occurrence stays, by (id, then text digest, then offset; null
ids last), and the rest are removed, their byte offsets in the original text retained.

``min_run`` spares what texts share by chance (headings, short phrases): later units next
to each other, with fewer than ``min_words`` words between them, are a run, and only runs of
``min_run`` words or more go, the words between counted and kept.  Nothing else changes: the
groups, their earliest occurrence and the offsets are those of all units.  Zero removes every
later unit.

Of the units of a batch with one digest only the first ranked can stay, so only that one
is shuffled; a line that a third of all documents share is one row per batch.

Defined results: a null or empty text has no units; texts of any length are read whole;
rows equal in id and text rank alike and get the same result; an empty table gives an
empty table; only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tidepool.llm.common import small_batches
from tidepool.llm.suffix_dedup import FACT_SCHEMA, TEXT_SCHEMA, _per_text

MIN_WORDS = 5
WHOLE = {"line": re.compile(rb"\n"), "paragraph": re.compile(rb"\n[ \t]*\n")}
CLAUSE = re.compile(rb"[.!?,;:]+\s+")

UNIT = np.dtype([("d1", "i8"), ("d2", "i8"), ("none", "i4"), ("id", "i8"), ("key", "i8"), ("n_bytes", "i8"), ("a", "i8"), ("b", "i8")])
NAMES = list(UNIT.names)
UNIT_SCHEMA = "d1 long, d2 long, none int, id long, key long, n_bytes long, a long, b long"
RANK = ("b", "a", "n_bytes", "key", "id", "none")      # last first, as lexsort takes them


def units(text: bytes, unit: str, clauses: bool, min_words: int) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, digest) of the units of a text; together they are all its lines (or paragraphs) with a word."""
    at = 0
    for end in [*(m.end() for m in WHOLE[unit].finditer(text)), len(text)]:
        start, at = at, end
        words = text[start:end].lower().split()
        if not words:
            continue
        whole = b" ".join(words)
        parts = []          # [start, end, words, or None for a run of short clauses]
        a = start
        for b in [*(m.end() for m in CLAUSE.finditer(text, start, end)), end] if clauses else [end]:
            clause = text[a:b].lower().split()
            if parts and (not clause or len(clause) < min_words and parts[-1][2] is None):
                parts[-1][1] = b
            elif a < b:
                parts.append([a, b, clause if len(clause) >= min_words else None])
            a = b
        for i, (a, b, clause) in enumerate(parts):
            # a line break cannot be in normalised words, so no clause has the digest of a run
            yield a, b, xxhash.xxh3_128_digest(b" ".join(clause) if clause is not None else b"%d\n%b" % (i, whole))


def _first_of_each(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that come first by rank in their digest, and the rest; one of wholly equal rows."""
    rows = rows[np.lexsort(tuple(rows[c] for c in (*RANK, "d2", "d1")))]
    if not len(rows):
        return rows, rows
    rows = rows[np.r_[True, rows[1:] != rows[:-1]]]
    head = np.r_[True, (rows["d1"][1:] != rows["d1"][:-1]) | (rows["d2"][1:] != rows["d2"][:-1])]
    return rows[head], rows[~head]


def _rows(rows: np.ndarray, removed: bool) -> pa.RecordBatch:
    cols = {n: pa.array(rows[n]) for n in NAMES}
    if removed:      # dealt by text, no digest
        cols["d1"], cols["d2"] = cols["key"], pa.nulls(len(rows), pa.int64())
    return pa.RecordBatch.from_arrays([cols[n] for n in NAMES], NAMES)


def _units(unit: str, clauses: bool, min_words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part in small_batches([batch], 512):
                for row in zip(*(c.to_pylist() for c in part.columns)):
                    id_, key, size, text = row
                    mine = list(units(text, unit, clauses, min_words))
                    rows = np.zeros(len(mine), UNIT)
                    digests = np.frombuffer(b"".join(d for _, _, d in mine), "<i8").reshape(-1, 2)
                    rows["d1"], rows["d2"] = digests[:, 0], digests[:, 1]
                    rows["none"], rows["id"], rows["key"], rows["n_bytes"] = id_ is None, id_ or 0, key, size
                    rows["a"], rows["b"] = [m[0] for m in mine], [m[1] for m in mine]
                    found.append(rows)
            first, rest = _first_of_each(np.concatenate(found) if found else np.empty(0, UNIT))
            yield _rows(first, False)
            yield _rows(rest, True)
    return run


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one task, all of each digest, to the units to remove."""
    held = np.empty(0, UNIT)
    waiting, size = [], 0

    def gone(rows):
        return pa.RecordBatch.from_arrays([pa.array(rows["key"]), pa.array(rows["n_bytes"].astype(np.int32)),
                                           pa.array(rows["a"]), pa.array(rows["b"])], ["key", "n_bytes", "a", "b"])

    def settle():
        nonlocal held, waiting, size
        held, rest = _first_of_each(np.concatenate([held, *waiting]))
        waiting, size = [], 0
        return gone(rest)

    for batch in batches:
        known = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        rows = np.empty(batch.num_rows, UNIT)
        for i, n in enumerate(NAMES):
            rows[n] = batch.column(i).fill_null(0).to_numpy()
        if known.any():
            yield gone(rows[known])
        waiting.append(rows[~known])
        size += int((~known).sum())
        if size > len(held) + (1 << 16):
            yield settle()
    yield settle()


def long_runs(text: bytes, spans: list[int], min_words: int, min_run: int) -> list[int]:
    """Of removed units (start, end, start, ..) those in runs of ``min_run`` words or more."""
    out, run, words = [], [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        between = len(text[run[-1]:a].split()) if run else 0
        if run and between >= min_words:
            out += run if words >= min_run else []
            run, words, between = [], 0, 0
        words += between + len(text[a:b].split())
        run += [a, b]
    return out + run if words >= min_run else out


def _remove(min_words: int, min_run: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 512):
            kept, removed = [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                spans = long_runs(text, spans, min_words, min_run) if spans else None
                if spans:
                    edges = [0, *spans, len(text)]
                    text = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                kept.append(text)
                removed.append(spans or None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), pa.array(removed, pa.list_(pa.int64()))],
                                             ["row", "kept", "removed"])
    return run


def dedup_units(docs: DataFrame, row, id_col: str = "doc_id", text_col: str = "text", unit: str = "line",
                clauses: bool = True, min_words: int = MIN_WORDS, min_run: int = 0) -> DataFrame:
    """(row, kept: the text's remaining bytes, removed: start and end of each removed unit, in
    order, null if there is none) of every document."""
    blob = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    id_ = F.col(f"`{id_col}`").cast("long")
    keyed = docs.select(F.xxhash64(id_, blob).alias("key"), F.octet_length(blob).alias("n_bytes"), row.alias("row"),
                        id_.alias("id"), blob.alias("text"))
    found = keyed.select("id", "key", "n_bytes", "text").mapInArrow(_units(unit, clauses, min_words), UNIT_SCHEMA)
    later = found.repartition("d1").mapInArrow(_later, FACT_SCHEMA)
    # units that touch stay apart: each keeps its own offsets
    spans = (later.repartition("key", "n_bytes").sortWithinPartitions("key", "n_bytes")
             .mapInArrow(_per_text(-1), TEXT_SCHEMA).select("key", "n_bytes", F.col("known").alias("removed")))
    joined = keyed.join(spans.hint("merge"), ["key", "n_bytes"], "left").select("row", "text", "removed")
    fields = [joined.schema["row"], StructField("kept", BinaryType()), StructField("removed", ArrayType(LongType()))]
    return joined.mapInArrow(_remove(min_words, min_run), StructType(fields))


def dedup_digest(docs: DataFrame, min_run: int = 0) -> DataFrame:
    found = dedup_units(docs, F.struct("doc_id"), min_run=min_run)
    spans = F.expr("transform(sequence(0, size(removed) div 2 - 1), i -> struct(removed[2 * i] AS start, removed[2 * i + 1] AS end))")
    return found.select("row.doc_id", F.coalesce(F.size("removed") / 2, F.lit(0)).cast("long").alias("n_removed"),
                        F.when(F.size("removed") > 0, spans).alias("removed"), F.octet_length("kept").cast("long").alias("kept_bytes"),
                        F.sha2("kept", 256).alias("kept_sha256"))
