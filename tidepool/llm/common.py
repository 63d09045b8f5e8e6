"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

# Folders written by ``stage`` inside the caller's ``staging`` block; names only, a few per call.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.
    Only a local master may go without it; there a scratch folder is made."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back, so a lost
    executor costs at most the tasks it was running."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging() -> Iterator[list[str]]:
    """The folders staged inside the block by this thread, in order, as a list for
    ``release``.  Each block has its own, so jobs side by side do not meet; an inner
    block's folders are its own alone."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged folders, for a caller that holds no frame that still reads them."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash over all columns; maps and variants, which have no hash, as JSON."""
    def hashable(kind) -> bool:
        if isinstance(kind, (MapType, VariantType)):
            return False
        if isinstance(kind, StructType):
            return all(hashable(f.dataType) for f in kind)
        return not isinstance(kind, ArrayType) or hashable(kind.elementType)

    return F.xxhash64(*[F.col(f"`{f.name}`") if hashable(f.dataType) else F.to_json(F.struct(F.col(f"`{f.name}`").alias("v")))
                        for f in df.schema])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(batches, rows: int):
    """The same rows in smaller batches, so that few become Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def pack(a: np.ndarray) -> bytes:
    """An integer array as zstd bytes, one byte plane after another (the high
    planes are nearly constant, so they cost little)."""
    width = a.dtype.itemsize
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, width).T).tobytes()
    return len(a).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if len(a) else b"")


def unpack(b: bytes, dtype) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    if not n:
        return np.empty(0, dtype)
    width = np.dtype(dtype).itemsize
    planes = pa.decompress(b[8:], decompressed_size=n * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T).view(dtype).reshape(-1)


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Positions starts[0].., starts[1].., each run lens[i] long, one after another."""
    total = int(lens.sum())
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - (ends - lens), lens)
