"""Operator 5: quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements and
one long whose bit i says that rule i failed; policies are masks over those bits
with a version, so that applying another policy, or asking what each rule rejects
alone, reads the ledger only: bitwise tests and bitwise aggregation, no text.

Words are runs of characters other than the six ASCII white spaces.

Defined results: a null, empty or blank text has no words and fails the base
rules; texts of any length are measured whole; repeated rows give repeated rows;
an empty table gives an empty table; ids may be null; only the id and text columns
are read, so further columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_table_bars"]

# (name, failed when): shares are compared as products of integers, so nothing is rounded.
RULES: list[tuple[str, Callable[[], Column]]] = [
    ("too_few_words", lambda: F.col("n_words") < 50),
    ("repeated_word_windows", lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    ("symbol_share", lambda: 10 * F.col("n_symbols") > 2 * F.col("n_words")),
    ("duplicate_line_share", lambda: 10 * F.col("n_dup_lines") > 6 * F.col("n_lines")),
    ("mean_word_length", lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words"))),
    ("mostly_table_cells", lambda: 10 * F.col("n_table_bars") > 3 * F.col("n_words")),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["too_few_words"] | BIT["repeated_word_windows"]

# Versioned policies: a document is rejected if one of the policy's bits is set.
POLICIES = {"base-1": BASE, "standard-1": sum(BIT.values())}

_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_BARS = re.compile(rb"(?<![^\x20\x09-\x0d])\|(?![^\x20\x09-\x0d])")


def _repeat_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    key = ids[:n]
    for k in range(1, window):      # number the windows from the left, so keys stay below n * distinct words
        key = key * len(known) + ids[k:k + n]
        if k < window - 1:
            key = np.unique(key, return_inverse=True)[1]
    _, where, count = np.unique(key, return_inverse=True, return_counts=True)
    again = (count > 1)[where]
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k:k + n] |= again
    return int(covered.sum())


def measure(text: bytes) -> tuple:
    words = text.split()      # bytes: the six ASCII white spaces only
    lines = [line for line in text.split(b"\n") if line.strip()]
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace"))
    return (len(words), chars, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)),
            _repeat_words(words), len(lines), len(_BARS.findall(text)))


def _measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measure(t.as_py() or b"") for t in batch.column(batch.num_columns - 1)]
        cols = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[] for _ in MEASURES])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cols], [*batch.schema.names[:-1], *MEASURES])


def measured(docs: DataFrame, keep: list[Column], text_col: str = "text") -> DataFrame:
    rows = docs.select(*keep, F.col(f"`{text_col}`").cast("binary").alias("text"))
    return rows.mapInArrow(_measures, StructType([*rows.schema.fields[:-1], *(StructField(m, LongType()) for m in MEASURES)]))


def failed_bits() -> Column:
    return reduce(Column.bitwiseOR, [F.when(rule(), F.lit(BIT[name])).otherwise(F.lit(0)) for name, rule in RULES]).cast("long")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, the measurements, failed (bitmask)."""
    return measured(docs, [F.col(f"`{id_col}`").alias(id_col)], text_col).withColumn("failed", failed_bits())


def passes(policy: str) -> Column:
    return F.col("failed").bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablation(ledger_rows: DataFrame, policy: str) -> DataFrame:
    """What each rule of a policy does: documents that fail it, that fail nothing
    else (kept again without it), and the bits that ever occur with it."""
    mask = POLICIES[policy]
    hit = F.col("failed").bitwiseAND(F.lit(mask))
    names = [n for n, _ in RULES if BIT[n] & mask]
    per_rule = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(BIT[n]).cast("long").alias("bit")) for n in names]))
    counted = ledger_rows.select(hit.alias("hit")).groupBy("hit").agg(F.count(F.lit(1)).alias("n"))    # 2^rules rows at most
    return (counted.select("hit", "n", per_rule.alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("hit").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("hit") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only_this"),
        F.bit_or(F.when(F.col("hit").bitwiseAND(F.col("r.bit")) != 0, F.col("hit")).otherwise(F.lit(0))).alias("fails_with")))


def keep_passing(docs: DataFrame, policy: str = "standard-1", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that a policy rejects, in one pass over the text."""
    # The row rides along as one struct, so its columns cannot clash with the measurements.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    kept = measured(docs, [row], text_col).withColumn("failed", failed_bits()).where(passes(policy))
    return kept.select([F.col("__row").getField(c).alias(c) for c in docs.columns])


def ledger_digest(docs: DataFrame) -> DataFrame:
    base = F.col("failed").bitwiseAND(F.lit(BASE)) != 0
    return ledger(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                               base.alias("base_failed"), (~base & passes("standard-1")).alias("kept"), "failed")
