"""Table scans and sinks.

Everything here is a thin, declarative use of the DataFrameReader / Writer:
column pruning and filter pushdown into Parquet are left to Catalyst, so a
caller that selects two columns and filters on a third reads only those.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


# A1 ---------------------------------------------------------------------------
def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Parquet scan of ``<base_dir>/<name>.parquet`` (a file or a directory)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, base_dir: str, names=TABLES) -> None:
    """Expose the tables as temp views so SQL and DataFrame code mix."""
    for n in names:
        read_table(spark, base_dir, n).createOrReplaceTempView(n)


# A2 / A3 ----------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """CSV scan.  With ``schema`` given no inference pass is made; without it
    Spark samples the files to infer types (an extra full read -- avoid on
    large inputs)."""
    r = spark.read.option("header", header)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              corrupt_column: str = "_corrupt_record") -> DataFrame:
    """JSON-lines scan in PERMISSIVE mode: a malformed line keeps its text in
    ``corrupt_column`` (when the schema names it) and nulls elsewhere."""
    r = (spark.read.option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", corrupt_column))
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


# A4 ---------------------------------------------------------------------------
def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, properties: dict | None = None) -> DataFrame:
    """JDBC scan.  Given a numeric ``partition_column`` and its bounds the
    read is split into ``num_partitions`` range queries run in parallel;
    without them it is a single task (fine only for small tables)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", lower_bound).option("upperBound", upper_bound)
             .option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


# A7 / A8 / A9 / A10 / A11 / A12 ---------------------------------------------------
def write_table(df: DataFrame, name: str, mode: str = "append", partition_by=None) -> None:
    """Managed Parquet table in the session catalog (append or overwrite)."""
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*_as_list(partition_by))
    w.saveAsTable(name)


def spread_partitions(df: DataFrame, partition_by, files_per_partition: int) -> DataFrame:
    """Shuffle so each partition value is written by ``files_per_partition``
    tasks: without it every task writes a file for every value it holds
    (a small-file explosion), and ``repartition(col)`` alone puts a whole
    value -- a hot day -- into one task.  The bucket is a hash of the row,
    so a retried task rebuilds the same files."""
    cols = _as_list(partition_by)
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_partition))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *[F.col(c) for c in cols], bucket)


def write_path(df: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "parquet",
               partition_by=None, files_per_partition: int | None = None) -> None:
    """External table: files at ``path`` in ``fmt`` (parquet, json, csv).
    With ``partition_by`` and ``files_per_partition`` each partition value
    is written as that many files (see ``spread_partitions``)."""
    if partition_by and files_per_partition:
        df = spread_partitions(df, partition_by, files_per_partition)
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*_as_list(partition_by))
    w.save(path)


def create_table_as(spark: SparkSession, name: str, query: str) -> DataFrame:
    """CREATE TABLE ... USING parquet AS SELECT ..."""
    spark.sql(f"CREATE TABLE {name} USING parquet AS {query}")
    return spark.table(name)


def overwrite_partitions(df: DataFrame, path: str, partition_by, files_per_partition: int | None = None) -> None:
    """Replace only the partitions present in ``df`` (a backfill of one
    day rewrites that day and leaves every other partition in place)."""
    if files_per_partition:
        df = spread_partitions(df, partition_by, files_per_partition)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format("parquet")
     .partitionBy(*_as_list(partition_by)).save(path))


# A13 --------------------------------------------------------------------------
def range_between(spark: SparkSession, lo_hi: DataFrame, step: int = 1) -> DataFrame:
    """Integer range ``id`` from a one-row frame ``(lo, hi)`` (inclusive).

    The bounds come from data (e.g. min / max of a key), so the spine grows
    with the table; the row itself is produced by ``spark.range`` after a
    single-row aggregate, never by a driver loop over values.
    """
    lo, hi = lo_hi.first()
    n = max(0, int(hi) - int(lo) + 1)
    parts = max(1, min(spark.sparkContext.defaultParallelism, math.ceil(n / 1_000_000)))
    return spark.range(int(lo), int(hi) + 1, step, numPartitions=parts)


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)
