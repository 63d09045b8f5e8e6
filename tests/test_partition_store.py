"""Partitions are replaced in one step, whatever moment a job stops at."""

import os

import pytest
from pyspark.sql import functions as F

from tidepool.sources.partitions import ConcurrentWrite, PartitionStore, upsert_store
from tidepool.streaming import jobs as S


def frame(spark, *rows):
    return spark.createDataFrame(rows, "id long, v int, day string")


def held(df):
    return sorted(map(tuple, df.select("id", "v", "day").collect()), key=str)


BASE = [(1, 1, "2024-01-01"), (2, 2, "2024-01-02"), (3, 3, None), (4, 4, "a/b=c d%")]


def test_replaces_only_the_partitions_of_the_rows(spark, tmp_out):
    store = PartitionStore(spark, os.path.join(tmp_out, "t"), "day")
    assert store.read() is None and store.versions() == []
    store.replace(frame(spark, *BASE))
    old = store.read()
    store.replace(frame(spark, (3, 30, None), (5, 5, "2024-01-03"), (4, 40, "a/b=c d%")))
    now = [(1, 1, "2024-01-01"), (2, 2, "2024-01-02"), (3, 30, None), (4, 40, "a/b=c d%"), (5, 5, "2024-01-03")]
    assert held(store.read()) == sorted(now, key=str)
    assert held(old) == held(store.read(1)) == sorted(BASE, key=str)          # a frame keeps the version it was read at
    assert held(store.read_touched(frame(spark, (9, 9, None)))) == [(3, 30, None)]
    store.replace(store.read_touched(frame(spark, (9, 9, None))).withColumn("v", F.col("v") + 1))      # reads what it replaces
    assert (3, 31, None) in held(store.read())
    assert store.vacuum() == 0 and store.versions() == [3]      # each write still holds a partition
    assert held(store.read()) == sorted([r if r[0] != 3 else (3, 31, None) for r in now], key=str)
    store.replace(frame(spark, *BASE))
    assert store.vacuum() == 2 and held(store.read()) == sorted([*BASE, (5, 5, "2024-01-03")], key=str)


@pytest.mark.parametrize("moment", ["while writing", "before publishing"])
def test_a_crash_loses_no_row(spark, tmp_out, monkeypatch, moment):
    path = os.path.join(tmp_out, "t")
    PartitionStore(spark, path, "day").replace(frame(spark, *BASE))
    batch = frame(spark, (1, 10, "2024-01-01"), (7, 7, "2024-01-01"))

    def upsert():
        upsert_store(PartitionStore(spark, path, "day"), batch, "id")

    with monkeypatch.context() as m:
        if moment == "while writing":
            batch = batch.withColumn("v", F.when(F.col("id") == 7, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("v")))
        else:
            m.setattr(PartitionStore, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("stop")))
        with pytest.raises(Exception, match="stop"):
            upsert()
    assert held(PartitionStore(spark, path, "day").read()) == sorted(BASE, key=str)
    batch = frame(spark, (1, 10, "2024-01-01"), (7, 7, "2024-01-01"))
    for _ in range(2):                                          # the replay, and once more
        upsert()
        got = held(PartitionStore(spark, path, "day").read())
        assert got == sorted([(1, 10, "2024-01-01"), (7, 7, "2024-01-01"), *BASE[1:]], key=str)


def test_two_writers_do_not_overwrite_each_other(spark, tmp_out, monkeypatch):
    path = os.path.join(tmp_out, "t")
    PartitionStore(spark, path, "day").replace(frame(spark, *BASE))
    slow = PartitionStore(spark, path, "day")
    plain = slow._publish

    def late(state, version):
        PartitionStore(spark, path, "day").replace(frame(spark, (1, 11, "2024-01-01")))
        plain(state, version)

    monkeypatch.setattr(slow, "_publish", late)
    with pytest.raises(ConcurrentWrite):
        slow.replace(frame(spark, (2, 22, "2024-01-02")))
    assert held(slow.read()) == sorted([(1, 11, "2024-01-01"), *BASE[1:]], key=str)


def test_a_sink_that_stops_between_its_tables_goes_on_whole(spark, tmp_out, monkeypatch):
    """The events are published, the aggregate is not: the replayed batch gives both."""
    def sink():
        events = S.PartitionedTableSink(os.path.join(tmp_out, "events"), S.keep_each_id("id"), "day", lambda b: b)
        return S.RecomputeSink(events, os.path.join(tmp_out, "gold"), lambda e: e.groupBy("day").agg(F.sum("v").alias("v")))

    sink()(frame(spark, *BASE), 0)
    batch = frame(spark, (5, 5, "2024-01-01"), (6, 6, None))
    with monkeypatch.context() as m:
        plain = PartitionStore._publish
        m.setattr(PartitionStore, "_publish", lambda self, *a: plain(self, *a) if self.path.endswith("events") else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sink()(batch, 1)
    gold = lambda: sorted(map(tuple, sink().latest(spark).select("day", "v").collect()), key=str)
    assert ("2024-01-01", 1) in gold() and (None, 3) in gold()
    sink()(batch, 1)
    assert ("2024-01-01", 6) in gold() and (None, 9) in gold() and len(gold()) == 4


def sized(store):
    """(partition, write, name) to size of the files in use."""
    return {(r.partition, r.write, r.name): r.size for r in store.files().collect()}


@pytest.fixture()
def fragmented(spark, tmp_out):
    """A large file in one partition, then many small files in three, names
    that need escaping included."""
    store = PartitionStore(spark, os.path.join(tmp_out, "t"), "day")
    wide = spark.range(20_000).select(F.col("id"), F.hash("id").alias("v"), F.lit("2024-01-01").alias("day")).coalesce(1)
    store.replace(wide)
    for i in range(5):
        rows = spark.range(600).select((F.col("id") + 100_000 * (i + 1)).alias("id"), F.hash("id").alias("v"),
                                       F.when(F.col("id") % 3 == 0, "2024-01-01").when(F.col("id") % 3 == 1, "a/b=c d%+").alias("day"))
        store.append(rows.repartition(3), after=i + 1)
    return store


def test_compaction_packs_the_small_files_only(spark, fragmented):
    before, rows = sized(fragmented), held(fragmented.read())
    large = {k for k, size in before.items() if size > 50_000}
    target = 3 * max(size for k, size in before.items() if k not in large)
    packed = fragmented.compact(target, small_bytes=50_000)
    after = sized(fragmented)
    assert len(large) == 1 and large < set(after)                        # the large file is where it was
    assert packed == len(set(before) - set(after)) and len(after) < len(before) / 2
    per_partition = {}
    for (p, w, _), size in sorted(after.items()):
        if (p, w) not in {(p, w) for p, w, _ in before}:
            per_partition.setdefault(p, []).append(size)
    assert len(per_partition) == 3 and all(len(sizes) > 1 for sizes in per_partition.values())
    assert held(fragmented.read()) == rows and held(fragmented.read(6)) == rows
    assert fragmented.vacuum() > 0 and held(fragmented.read()) == rows and sized(fragmented) == after
    assert fragmented.compact(10, small_bytes=5) == 0 and fragmented.versions() == [7]      # nothing is small


def test_compaction_that_stops_changes_nothing(spark, fragmented, monkeypatch):
    before, rows = sized(fragmented), held(fragmented.read())
    with monkeypatch.context() as m:
        m.setattr(PartitionStore, "_publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            fragmented.compact(50_000)
    assert sized(fragmented) == before and held(fragmented.read()) == rows
    assert fragmented.vacuum(keep=6) == 1                       # the packs that nothing names
    fragmented.compact(10**9, small_bytes=50_000)
    assert held(fragmented.read()) == rows
    fragmented.replace(frame(spark, (1, 1, "2024-01-01")))      # a partition of several writes is replaced whole
    assert held(fragmented.read().where("day = '2024-01-01'")) == [(1, 1, "2024-01-01")]
    assert held(fragmented.read().where("day IS NULL")) == [r for r in rows if r[2] is None]


def test_append_is_not_repeated_and_keeps_the_schema(spark, fragmented):
    rows = frame(spark, (1, 1, "2024-01-01")).select("id", "v", "day")
    with pytest.raises(ConcurrentWrite):
        fragmented.append(rows, after=5)
    with pytest.raises(ValueError):
        fragmented.append(rows.withColumn("more", F.lit(1)))
    assert PartitionStore(spark, fragmented.path + "-none", "day").compact() == 0
