"""File layout jobs over Parquet (I8-I11): compaction, multi-column
(Z-order) and range-clustered writes, and a per-file min/max report that
measures how many files a predicate must open.

All sizing information is computed by Spark jobs from the ``_metadata``
columns of the files (no driver-side listing of the data), and every
rewrite goes to a new path: a failed job leaves the input untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import input_bytes


def total_bytes(spark: SparkSession, path: str) -> int:
    """Sum of the Parquet file sizes under ``path`` (one metadata scan)."""
    df = spark.read.parquet(path)
    files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).distinct()
    return int(files.agg(F.coalesce(F.sum("s"), F.lit(0))).first()[0])


def n_files(df: DataFrame, target_bytes: int = 128 * 1024 * 1024) -> int:
    """Files of about ``target_bytes`` for a frame, by the bytes its plan
    reads, and at least one a core, so that a small table is written in
    parallel too."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-input_bytes(df) // target_bytes))


# I8 ---------------------------------------------------------------------------------------
def compact(spark: SparkSession, path_in: str, path_out: str, target_bytes: int = 128 * 1024 * 1024,
            sort_by=None) -> int:
    """Rewrite many small files as ~``target_bytes`` files.  Returns the
    number of output partitions.  ``sort_by`` keeps a clustering order
    inside each file."""
    n = max(1, math.ceil(total_bytes(spark, path_in) / target_bytes))
    df = spark.read.parquet(path_in)
    if sort_by:
        out = df.repartitionByRange(n, *sort_by).sortWithinPartitions(*sort_by)
    else:
        out = df.repartition(n)
    out.write.mode("errorifexists").parquet(path_out)
    return n


# I9 ---------------------------------------------------------------------------------------
def quantile_bounds(df: DataFrame, cols, buckets: int = 64, accuracy: int = 10_000) -> DataFrame:
    """One row with an array of ``buckets - 1`` quantiles per column
    (``_bounds_<column>``), from ONE approx_percentile aggregate.  The bounds
    stay a frame: no plan over the rows grows with their number."""
    probs = [i / buckets for i in range(1, buckets)]
    return df.agg(*[F.percentile_approx(F.col(c), probs, accuracy).alias(f"_bounds_{c}") for c in cols])


def bucket_of(col: str, bounds: Column, buckets: int) -> Column:
    """Index of the quantile bucket holding the value: how many of the sorted
    ``bounds`` (fewer than ``buckets``) lie below it, found by bisection, one
    step a bit.  NULL is in bucket 0."""
    steps = F.lit([2 ** j for j in reversed(range(max(1, math.ceil(math.log2(buckets)))))])

    def halve(below: Column, step: Column) -> Column:
        probe = F.try_element_at(bounds, below + step)        # NULL beyond the last bound
        return F.when(probe < F.col(col), below + step).otherwise(below)

    return F.aggregate(steps, F.lit(0), halve)


def z_value(bucket_cols: list[Column], bits: int) -> Column:
    """Interleave the low ``bits`` bits of each bucket column (Morton order)."""
    z = F.lit(0).cast("bigint")
    k = len(bucket_cols)
    for j in range(bits):
        for i, b in enumerate(bucket_cols):
            bit = F.shiftright(b.cast("bigint"), j).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, j * k + i))
    return z


def zorder(df: DataFrame, cols, n_files: int, buckets: int | None = None) -> DataFrame:
    """Multi-column clustering: columns are mapped to quantile buckets (so a
    narrow-range column gets as many bits as a wide one), their bits are
    interleaved, and rows are range-partitioned and sorted on that value,
    then on the columns themselves, so that a cell of equal values spreads
    over files.  ``buckets`` per column: by default enough for 16 cells a
    file, which is the square root of that for two columns (4,096 bounds a
    column for 800,000 files).  One column needs no buckets: its own order is
    the curve."""
    order = [*cols, "_tie"]            # the row's hash splits rows that tie on all of it
    out = df.withColumn("_tie", F.xxhash64(*[F.col(c) for c in df.columns]))
    if len(cols) > 1:
        if buckets is None:
            buckets = max(64, 2 ** math.ceil(math.log2(16 * n_files) / len(cols)))
        bits = max(1, math.ceil(math.log2(buckets)))
        if bits * len(cols) > 63:
            raise ValueError(f"{len(cols)} columns of {bits} bits do not fit the 63 bits of a z-value")
        bounds = quantile_bounds(df, cols, buckets, accuracy=max(10_000, 10 * buckets))
        out = out.crossJoin(F.broadcast(bounds))                          # one row of bounds
        out = out.withColumns({f"_bucket_{c}": bucket_of(c, F.col(f"_bounds_{c}"), buckets) for c in cols})
        out = out.withColumn("_z", z_value([F.col(f"_bucket_{c}") for c in cols], bits))
        order = ["_z", *order]
    return (out.repartitionByRange(n_files, *order).sortWithinPartitions(*order).select(*df.columns))


def zorder_write(df: DataFrame, cols, n_files: int, path: str, buckets: int | None = None) -> None:
    zorder(df, cols, n_files, buckets).write.mode("errorifexists").parquet(path)


# I10 --------------------------------------------------------------------------------------
def cluster_write(df: DataFrame, cols, n_files: int, path: str) -> None:
    """Range-cluster on ``cols`` (re-clusterable: rerun with other columns)."""
    order = [*cols, "_tie"]            # equal keys spread over files by the row's hash
    (df.withColumn("_tie", F.xxhash64(*[F.col(c) for c in df.columns])).repartitionByRange(n_files, *order)
       .sortWithinPartitions(*order).drop("_tie").write.mode("errorifexists").parquet(path))


# I11 --------------------------------------------------------------------------------------
def layout_report(spark: SparkSession, path: str, cols) -> DataFrame:
    """One row per file: path, size, rows, and min / max of each column."""
    df = spark.read.parquet(path)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.groupBy(F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("file_size")).agg(*aggs)


def files_hit(report: DataFrame, col: str, lo, hi=None) -> int:
    """Files whose [min, max] of ``col`` overlaps [lo, hi] (a point when hi
    is None) -- the files min/max skipping would still have to open."""
    hi = lo if hi is None else hi
    return report.filter((F.col(f"min_{col}") <= F.lit(hi)) & (F.col(f"max_{col}") >= F.lit(lo))).count()
