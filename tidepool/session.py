"""Spark session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings every job in this library assumes.  They are defaults only:
# a cluster launcher that already set a key keeps its own value.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Bigger than the 10 MB default is not needed: joins that want a broadcast
    # ask for it explicitly behind a size check (operators.joins).
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tidepool", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the library defaults.

    ``master`` and ``shuffle_partitions`` are only applied when given; on a
    cluster the launcher decides both.
    """
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    active = SparkSession.getActiveSession()
    if active is not None:
        # a launcher built the session: only fill in what it left unset
        for k, v in conf.items():
            if active.conf.get(k, None) is None:
                try:
                    active.conf.set(k, v)
                except Exception:  # static settings cannot change on a live session
                    pass
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage and stage intermediate tables.

    Read from ``spark.checkpoint.dir`` (a cluster names a shared, fault
    tolerant folder there).  Only a local master may leave it unset: a
    scratch folder is then made and given to the context, so every later
    call sees the same one.  Elsewhere that is an error, since executors do
    not see the driver's own disk.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tidepool-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared checkpoint folder for a staged table.
    Only named here: Spark makes it, on the file system the path belongs to."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def estimated_bytes(df: DataFrame) -> int:
    """The planner's estimate of a frame's size.  No job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def input_bytes(df: DataFrame) -> int:
    """Bytes that a frame's plan reads: the sum over its leaves, so joins do
    not multiply it.  A leaf of unknown size (rows handed over by the driver
    or an RDD) counts nothing.  No job runs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    unknown = int(df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes())
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(n for n in sizes if n < unknown)


_STAGED: list[tuple[SparkSession, str]] = []


def drop_staged() -> None:
    """Delete every table ``materialize`` wrote so far.  For callers that
    have written their results and hold no frame that still reads them."""
    done, _STAGED[:] = _STAGED[:], []
    for spark, path in done:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, name: str = "stage"):
    """Cut lineage by writing ``df`` as Parquet into a fresh folder under the
    shared checkpoint folder and reading it back.  Unlike
    ``Dataset.checkpoint`` this runs one write job (no second pass to save
    the rows) and stores them columnar and compressed.  Non-deterministic
    columns (``spark_partition_id()``, ...) are fixed at write time, so every
    later use and every retried task sees the same values."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _STAGED.append((spark, path))
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
