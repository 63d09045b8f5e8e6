"""Replacing partitions without a moment in which rows are gone.

A dynamic partition overwrite removes the old files of a partition and then
moves the new ones in; a crash in between loses the partition, and a replay
that reads the table first goes on without it.  A ``PartitionStore`` never
touches what is published: every write goes to a folder of its own, and a
state file names, for each partition, the write that holds it.  The next
state file appears by one rename; until then readers see the old state
whole, afterwards the new one whole.  A crash leaves at most a folder that no
state names, and the replayed batch starts from the published state.

Rows may also be appended: the partition is then held by several writes, each
with its own files, and small files gather.  ``compact`` packs the small files
of each partition into files of about a target size and leaves the others where
they are.

The state has one short entry per partition and write, and, where only part of
a write's files is still used, their names (as the file index Spark builds of
a partitioned table has); rows never pass through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class ConcurrentWrite(RuntimeError):
    """Another writer published first; nothing was changed."""


def _holders(entry) -> list[list]:
    """What holds a partition: ``[write, names of its files in use]`` pairs,
    None for all files.  A partition of a single whole write is just its name."""
    return [[entry, None]] if isinstance(entry, str) else entry


def _place() -> list[Column]:
    """Partition folder, write folder and name of the file that a row is in."""
    path = F.split(F.col("_metadata.file_path"), "/")
    return [F.url_decode(F.replace(F.element_at(path, at), F.lit("+"), F.lit("%2B"))).alias(name)
            for at, name in ((-2, "partition"), (-3, "write"), (-1, "name"))]


class PartitionStore:
    """A Parquet table partitioned by one column under ``path``."""

    def __init__(self, spark: SparkSession, path: str, partition_col: str):
        self.spark, self.path, self.partition_col = spark, path.rstrip("/"), partition_col

    # files ------------------------------------------------------------------
    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _names(self, folder: str) -> list[str]:
        fs, p = self._fs(f"{self.path}/{folder}")
        return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []

    def _publish(self, state: dict, version: int) -> None:
        fs, tmp = self._fs(f"{self.path}/state/.{uuid.uuid4().hex}")
        _, final = self._fs(f"{self.path}/state/{version:012d}.json")
        out = fs.create(tmp, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if fs.exists(final) or not fs.rename(tmp, final):
            fs.delete(tmp, False)
            raise ConcurrentWrite(f"version {version} of {self.path} was published meanwhile")

    # state ------------------------------------------------------------------
    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names("state") if n.endswith(".json") and n[0] != "."]

    def _state(self, version: int) -> dict:
        fs, p = self._fs(f"{self.path}/state/{version:012d}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    # rows -------------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame | None:
        """The table as of a published version (the last unless given), None if
        nothing was published.  Later writes do not change what a frame reads."""
        known = self.versions()
        if not known:
            return None
        state = self._state(known[-1] if version is None else version)
        schema, data = StructType.fromJson(state["schema"]), f"{self.path}/data"
        if not state["partitions"]:
            return self.spark.createDataFrame([], schema)
        paths = [f"{data}/_write={w}/{p}" + (f"/{name}" if name else "")
                 for p, entry in sorted(state["partitions"].items())
                 for w, names in _holders(entry) for name in (names or [None])]
        return self.spark.read.schema(schema).option("basePath", data).parquet(*paths).drop("_write")

    def read_touched(self, rows: DataFrame) -> DataFrame | None:
        """The table's rows in the partitions that ``rows`` fall in (NULL is a
        partition like any other)."""
        table, c = self.read(), self.partition_col
        if table is None:
            return None
        touched = rows.select(F.col(c).cast(table.schema[c].dataType).alias("_touched")).distinct()
        return table.join(touched, F.col(c).eqNullSafe(F.col("_touched")), "left_semi")

    def _folders_of(self, rows: DataFrame) -> list[str]:
        """Names of the partitions that ``rows`` of this table come from."""
        name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
        return [unquote(r[0]) for r in rows.select(name).distinct().collect()]      # partitions, not rows

    def replace(self, rows: DataFrame, touched: DataFrame | None = None) -> int:
        """Publish ``rows`` as the new contents of the partitions they fall in;
        the others stay as they are.  ``rows`` may read this table.  Partitions
        that ``touched`` rows fall in and ``rows`` do not are emptied.  Returns
        the version published."""
        last, version = self._last()
        old = self.read_touched(touched) if touched is not None else None
        emptied = self._folders_of(old) if old is not None else []
        write, found = self._write(rows, version)
        kept = {k: v for k, v in last["partitions"].items() if k not in emptied}
        self._publish({"schema": self._schema(rows), "partitions": kept | dict.fromkeys(found, write)}, version)
        return version

    def append(self, rows: DataFrame, after: int | None = None) -> int:
        """Publish ``rows`` beside the contents of the partitions they fall in.
        Returns the version published.  A replay would add them again: name the
        version that the rows go ``after`` (0 for none), and a second call
        raises ``ConcurrentWrite`` instead."""
        last, version = self._last()
        if after is not None and after != version - 1:
            raise ConcurrentWrite(f"version {after} of {self.path} is no longer the last")
        types = StructType.fromJson(self._schema(rows)).simpleString()
        if "schema" in last and types != StructType.fromJson(last["schema"]).simpleString():
            raise ValueError(f"{types} differs from the table at {self.path}")
        write, found = self._write(rows, version)
        held = {p: [*_holders(last["partitions"][p]), [write, None]] if p in last["partitions"] else write for p in found}
        self._publish({"schema": last.get("schema", self._schema(rows)), "partitions": last["partitions"] | held}, version)
        return version

    def _last(self) -> tuple[dict, int]:
        """The published state and the number of the next version."""
        known = self.versions()
        return (self._state(known[-1]), known[-1] + 1) if known else ({"partitions": {}}, 1)

    def _schema(self, rows: DataFrame) -> dict:
        columns = [c for c in rows.columns if c != self.partition_col] + [self.partition_col]
        return json.loads(rows.select(*columns).schema.json())

    def _write(self, rows: DataFrame, version: int) -> tuple[str, list[str]]:
        """Rows to a new folder: its name and the partitions in it."""
        write = f"{version:012d}-{uuid.uuid4().hex[:12]}"
        rows.write.partitionBy(self.partition_col).parquet(f"{self.path}/data/_write={write}")
        return write, [n for n in self._names(f"data/_write={write}") if "=" in n]

    # files in use -----------------------------------------------------------
    def files(self) -> DataFrame:
        """One row per file in use: partition (folder name), write, name, size.
        Files without rows are not listed."""
        return self.read().select(*_place(), F.col("_metadata.file_size").alias("size")).distinct()

    def compact(self, target_bytes: int = 128 * 1024 * 1024, small_bytes: int | None = None) -> int:
        """Pack the files below ``small_bytes`` (half the target by default) of
        each partition into files of about ``target_bytes``; returns how many
        files went into new ones.

        Small files of a partition, in order of write and name, are cut into
        packs where their sizes pass a multiple of the target, so a pack holds
        less than the target and one small file; a pack of a single file is
        left.  Only files of packs are read: each pack goes to one task of its
        own, which writes one file.  The new state names the packs and the
        files that stay, in one step; earlier versions still read the old
        files until ``vacuum``."""
        last, version = self._last()
        if not last["partitions"]:
            return 0
        small = self.files().where(F.col("size") < (small_bytes or target_bytes // 2))
        w = Window.partitionBy("partition").orderBy("write", "name")      # files of a partition, not rows
        packs = small.withColumn("pack", F.floor((F.sum("size").over(w) - F.col("size")) / F.lit(target_bytes)))
        size_of = Window.partitionBy("partition", "pack")
        packs = packs.withColumn("n", F.count("*").over(size_of)).where("n > 1").drop("n", "size").collect()
        if not packs:
            return 0
        numbers = {key: i for i, key in enumerate(sorted({(r.partition, r.pack) for r in packs}))}
        gone = defaultdict(set)
        for r in packs:
            gone[r.partition, r.write.removeprefix("_write=")].add(r.name)
        schema, data = StructType.fromJson(last["schema"]), f"{self.path}/data"
        paths = [f"{data}/{r.write}/{r.partition}/{r.name}" for r in packs]
        rows = self.spark.read.schema(schema).option("basePath", data).parquet(*paths).drop("_write")
        pack_of = self.spark.createDataFrame([(r.partition, r.name, numbers[r.partition, r.pack]) for r in packs],
                                             "_partition string, _name string, _pack int")
        partition, _, name = _place()
        rows = rows.select("*", partition.alias("_partition"), name.alias("_name")).join(pack_of, ["_partition", "_name"])
        write, _ = self._write(rows.repartitionById(len(numbers), F.col("_pack")).drop("_pack").select(*schema.names), version)
        partitions = dict(last["partitions"])
        for p in {p for p, _ in numbers}:
            held = [[w, self._left(p, w, names, gone.get((p, w), set()))] for w, names in _holders(partitions[p])]
            held = [h for h in held if h[1] != []] + [[write, None]]
            partitions[p] = write if len(held) == 1 else held
        self._publish(last | {"partitions": partitions}, version)
        return len(packs)

    def _left(self, partition: str, write: str, names: list[str] | None, gone: set[str]) -> list[str] | None:
        """Names of a write's files that stay in use; None while all do."""
        if not gone:
            return names
        every = names or [n for n in self._names(f"data/_write={write}/{partition}") if n.endswith(".parquet")]
        return [n for n in every if n not in gone]

    def vacuum(self, keep: int = 1) -> int:
        """Delete the write folders that none of the last ``keep`` versions
        names (leftovers of crashes too), files that were packed since, and the
        older state files.  No write may be under way.  Returns how many folders
        and files went."""
        known = self.versions()
        used = {w for v in known[-keep:] for entry in self._state(v)["partitions"].values() for w, _ in _holders(entry)}
        for v in known[:-keep]:
            fs, p = self._fs(f"{self.path}/state/{v:012d}.json")
            fs.delete(p, False)
        in_use = defaultdict(list)          # (write, partition) to the lists of names that versions use
        for v in known[-keep:]:
            for p, entry in self._state(v)["partitions"].items():
                for write, names in _holders(entry):
                    in_use[write, p].append(names)
        gone = [n for n in self._names("data") if n.removeprefix("_write=") not in used]
        gone += [f"_write={write}/{p}/{n}" for (write, p), lists in in_use.items() if None not in lists
                 for n in self._names(f"data/_write={write}/{p}") if n.endswith(".parquet") and n not in sum(lists, [])]
        for n in gone:
            fs, p = self._fs(f"{self.path}/data/{n}")
            fs.delete(p, True)
        return len(gone)


def upsert_store(store: PartitionStore, source: DataFrame, keys, update_cols=None) -> int:
    """MERGE into a partition store: the partitions that hold source rows are
    read, merged with ``merge_upsert`` and published together in one step.
    Keys must not move between partitions.  Rerunning the same source, after
    a crash or not, gives the same table."""
    from tidepool.operators.changes import merge_upsert
    from tidepool.session import materialize
    source = materialize(source, "upsert-source")      # read for the touched partitions, the check and the merge
    target = store.read_touched(source)
    return store.replace(source if target is None else
                         merge_upsert(target.select(*source.columns), source, keys, update_cols=update_cols))
