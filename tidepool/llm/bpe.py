"""Operator 1: byte-level BPE encoding and decoding.

Encoding is the distinct-word shuffle of ``pretokens``: every match of the
tokenizer's pattern is a word, each distinct word of the corpus is merged once,
and documents get their ids back by position.  Decoding joins each id with the
token-byte table; that table has one row per vocabulary entry, its size is
checked when the file is read, and it goes to the tasks as a map-side join.

Defined results: a null or empty text has no ids and decodes to no bytes; a
text of any length is encoded whole; equal rows give equal rows; an empty table
gives an empty table; only the id and text columns are read, so further columns
may have any name.  A null id stays null.
"""

from __future__ import annotations

import array
import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import tiktoken.registry
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import ragged
from tidepool.llm.pretokens import cut, reassemble, solve_words

MAX_VOCABULARY = 1_000_000
MAX_RANK_BYTES = 64 << 20


def read_ranks(path: str) -> bytes:
    """A rank file (base64 token, space, rank per line), refused above the bound
    up to which it is shipped to every task."""
    with open(path, "rb") as f:
        data = f.read(MAX_RANK_BYTES + 1)
    if len(data) > MAX_RANK_BYTES or data.count(b"\n") > MAX_VOCABULARY:
        raise ValueError(f"{path}: larger than the bound for a broadcast vocabulary")
    return data


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def _merger(ranks: bytes, pattern: str) -> Callable:
    def make():
        name = "ranks-" + hashlib.sha256(ranks + pattern.encode()).hexdigest()
        made = tiktoken.registry.ENCODINGS      # the library's own store: one encoder a worker process
        if name not in made:
            made[name] = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=parse_ranks(ranks), special_tokens={})
        merge = made[name]._core_bpe.encode_single_piece

        def solve(words):
            for w in words:
                ids = merge(w)
                yield len(ids), array.array("I", ids).tobytes()

        return solve

    return make


def encode(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, n_tokens, ids (little-endian uint32 bytes)."""
    blocks = cut(docs, pattern, id_col, text_col)
    solved = solve_words(blocks, _merger(ranks, pattern))
    return reassemble(blocks, solved, values=True).select(
        F.col("id").alias(id_col), F.col("n").alias("n_tokens"), F.col("vals").alias("ids"))


def token_table(ranks: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and bytes of every token id; unused ids have length -1."""
    by_id = {i: t for t, i in parse_ranks(ranks).items()}
    size = max(by_id, default=-1) + 1
    lens = np.array([len(by_id[i]) if i in by_id else -1 for i in range(size)], np.int64)
    flat = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(size)), np.uint8)
    real = np.maximum(lens, 0)
    return np.cumsum(real) - real, lens, flat


def _decoder(ranks: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, lens, flat = token_table(ranks)
        for batch in batches:
            names = batch.schema.names
            col = batch.column(names.index("ids"))
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [np.frombuffer(b, "<u4") if b is not None else np.empty(0, "<u4")
                       for b in col.slice(at, 256).to_pylist()]
                all_ids = np.concatenate(ids) if ids else np.empty(0, "<u4")
                if len(all_ids) and (all_ids.max() >= len(lens) or lens[all_ids].min() < 0):
                    raise ValueError("an id is not in the token-byte table")
                sizes = lens[all_ids]
                upto = np.r_[0, np.cumsum(sizes)]
                ends = np.cumsum([len(i) for i in ids])
                offs = np.r_[0, upto[ends]].astype(np.int64)
                text = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(ids), [None, pa.py_buffer(offs), pa.py_buffer(flat[ragged(starts[all_ids], sizes)].tobytes())])
                yield pa.RecordBatch.from_arrays(part.columns + [text.cast(pa.binary())], [*names, "decoded"])

    return run


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """``encoded`` with the bytes that its ids stand for, column ``decoded``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", decoded binary"
    return encoded.mapInArrow(_decoder(ranks), schema)


def encode_digest(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """Per document: n_tokens and the digests of its ids and of their decoding."""
    both = decode(encode(docs, ranks, pattern), ranks)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
