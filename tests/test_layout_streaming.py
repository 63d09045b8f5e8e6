"""Layout jobs (I8-I11) and Structured Streaming (O1-O3)."""

import os

from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL
from tidepool.operators import layout as L
from tidepool.plans import medallion as M
from tidepool.plans.common import t
from tidepool.streaming import jobs as S


def _orders_with_day(spark):
    return t(spark, SF_MID, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).alias("day"))


def test_compaction_fewer_files_same_rows(spark, tmp_out):
    o = _orders_with_day(spark)
    small = os.path.join(tmp_out, "small")
    o.repartition(40).write.parquet(small)
    before = L.layout_report(spark, small, ["o_custkey"]).count()
    out = os.path.join(tmp_out, "compacted")
    n = L.compact(spark, small, out, target_bytes=max(1, L.total_bytes(spark, small) // 3))
    after = L.layout_report(spark, out, ["o_custkey"]).count()
    assert before == 40 and after <= n < before
    assert spark.read.parquet(out).exceptAll(o).count() == 0
    assert spark.read.parquet(out).count() == o.count()


def test_zorder_and_cluster_reduce_files_hit(spark, tmp_out):
    o = _orders_with_day(spark)
    rnd = os.path.join(tmp_out, "random")
    o.repartition(16, F.xxhash64("o_orderkey")).write.parquet(rnd)
    z = os.path.join(tmp_out, "z")
    L.zorder_write(o, ["o_custkey", "day"], 16, z)
    cl = os.path.join(tmp_out, "cl")
    L.cluster_write(o, ["o_custkey"], 16, cl)
    key = o.select("o_custkey").first()[0]
    day = o.select("day").first()[0]
    hits = {}
    for name, path in (("random", rnd), ("z", z), ("cl", cl)):
        rep = L.layout_report(spark, path, ["o_custkey", "day"])
        hits[name] = (L.files_hit(rep, "o_custkey", key), L.files_hit(rep, "day", day))
        assert spark.read.parquet(path).count() == o.count()
    assert hits["random"][0] == 16
    assert hits["z"][0] < hits["random"][0] and hits["z"][1] < hits["random"][1]
    assert hits["cl"][0] <= 2


def test_buckets_by_bisection(spark):
    """Ties, NULL, values at and beyond the bounds, fewer bounds than
    buckets; the plan over the rows grows with the bits of a bucket only
    (11 against 6), not with the bounds (2,047 against 63)."""
    df = spark.sql("SELECT IF(id % 11 = 0, NULL, id - 20) AS v FROM range(60)")
    for given in ([-5, -5, 0, 3, 3, 3, 17], [4], [], None):
        bounds = spark.createDataFrame([(given,)], "b array<bigint>")
        got = df.crossJoin(bounds).select("v", L.bucket_of("v", F.col("b"), 8).alias("bucket")).collect()
        assert [r.bucket for r in got] == [0 if r.v is None else sum(b < r.v for b in given or []) for r in got]
    o = _orders_with_day(spark)

    def plan(buckets):
        z = L.zorder(o, ["o_custkey", "day"], 4, buckets)
        return z._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[0]

    assert len(plan(2048)) < 2 * len(plan(64))
    assert L.zorder(o, ["o_custkey"], 4).exceptAll(o).count() == 0


def _land_events(spark, base, splits, dup_from_previous=True):
    """Write the events table as several files by day ranges (time order)."""
    ev = t(spark, SF_SMALL, "events")
    day = F.dayofmonth("ts")
    prev = None
    for i, (lo, hi) in enumerate(splits):
        part = ev.filter((day >= lo) & (day < hi))
        if dup_from_previous and prev is not None:
            part = part.unionByName(prev.limit(20))      # re-delivered rows, same ids
        part.coalesce(1).write.parquet(os.path.join(base, f"part{i}"))
        prev = part
    return ev


def test_stream_dedup_across_files_matches_batch(spark, tmp_out):
    landed = os.path.join(tmp_out, "landed")
    ev = _land_events(spark, landed, [(1, 11), (11, 21), (21, 32)])
    stream = S.read_landed(spark, landed + "/*", ev.schema, max_files_per_trigger=1)
    out, q = S.stream_to_snapshot(spark, S.stream_bronze(stream, "event_id", "ts", "40 days"), "t-o1")
    assert out.count() == ev.count()
    assert out.select(ev.columns).exceptAll(ev).count() == 0
    assert S.dropped_by_watermark(q) == 0


def test_stream_watermark_too_short_drops_late_rows(spark, tmp_out):
    """Files landing in reverse time order with a 1-day delay: rows older
    than the watermark are dropped silently.  Late rows are judged against
    the watermark of the PREVIOUS batch, so the second file still passes
    and the third is dropped (measured on 4.1.2)."""
    landed = os.path.join(tmp_out, "landed_late")
    ev = t(spark, SF_SMALL, "events")
    day = F.dayofmonth("ts")
    ev.filter(day >= 20).coalesce(1).write.parquet(os.path.join(landed, "a"))
    ev.filter((day >= 10) & (day < 20)).coalesce(1).write.parquet(os.path.join(landed, "b"))
    ev.filter(day < 10).coalesce(1).write.parquet(os.path.join(landed, "c"))
    stream = S.read_landed(spark, landed + "/*", ev.schema, max_files_per_trigger=1)
    out, q = S.stream_to_snapshot(spark, S.stream_bronze(stream, "event_id", "ts", "1 day"), "t-late")
    assert out.count() == ev.filter(day >= 10).count()
    assert S.dropped_by_watermark(q) == ev.filter(day < 10).count()
    late = S.late_rows(ev, out, "event_id")          # none is lost: they are the reject side
    assert late.exceptAll(ev.filter(day < 10)).count() == 0 and late.count() == ev.filter(day < 10).count()
    stream2 = S.read_landed(spark, landed + "/*", ev.schema, max_files_per_trigger=1)
    gold = S.windowed_gold(stream2, "ts", "1 day", ["event_type"], "value")
    out2, q2 = S.stream_to_snapshot(spark, gold, "t-late-gold", merge=S.window_upsert_merge(["event_type"]),
                                    mode="update")
    assert S.dropped_by_watermark(q2) > 0          # counted after the partial aggregate
    assert out2.filter(F.dayofmonth("window_start") < 10).count() == 0


def test_stream_silver_upsert_equals_batch(spark, tmp_out):
    landed = os.path.join(tmp_out, "landed_silver")
    ev = _land_events(spark, landed, [(1, 11), (11, 21), (21, 32)], dup_from_previous=False)
    dims = [t(spark, SF_SMALL, n) for n in ("customer", "nation", "region")]
    stream = S.read_landed(spark, landed + "/*", ev.schema, max_files_per_trigger=1)
    raw = M.raw_order_events(spark, stream, *dims, duplicate_every=None)
    out, _ = S.stream_to_snapshot(spark, raw, "t-o2", merge=S.silver_upsert_merge("2024-02-02 00:00:00"))
    batch = M.to_silver(M.to_bronze(M.raw_order_events(spark, ev, *dims), "2024-02-02 00:00:00"),
                        "2024-02-02 00:00:00")
    assert out.count() == batch.count()
    assert out.exceptAll(batch).count() == 0


def test_stream_windowed_gold_update_mode_equals_batch(spark, tmp_out):
    landed = os.path.join(tmp_out, "landed_gold")
    ev = _land_events(spark, landed, [(1, 11), (11, 21), (21, 32)], dup_from_previous=False)
    stream = S.read_landed(spark, landed + "/*", ev.schema, max_files_per_trigger=1)
    gold = S.windowed_gold(stream, "ts", "2 days", ["event_type"], "value")
    out, _ = S.stream_to_snapshot(spark, gold, "t-o3", merge=S.window_upsert_merge(["event_type"]), mode="update")
    batch = ev.groupBy(F.to_date("ts").alias("d"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value"))
    got = out.select(F.to_date("window_start").alias("d"), "event_type", "n", "total_value")
    assert got.count() == batch.count()
    assert got.exceptAll(batch).count() == 0


def test_stream_latest_event_snapshot_equals_batch_for_any_file_order(spark, tmp_out):
    """Files in reverse time order, one order's events split over files and
    a re-delivered file: the latest-event snapshot still gives the batch
    Silver exactly."""
    landed = os.path.join(tmp_out, "landed_rev")
    ev = t(spark, SF_SMALL, "events")
    hour = F.hour("ts")
    ev.filter(hour >= 12).coalesce(1).write.parquet(os.path.join(landed, "a"))     # later events first
    ev.filter(hour < 12).coalesce(1).write.parquet(os.path.join(landed, "b"))
    ev.filter(hour >= 18).coalesce(1).write.parquet(os.path.join(landed, "c"))     # re-delivered slice
    dims = [t(spark, SF_SMALL, n) for n in ("customer", "nation", "region")]
    stream = S.read_landed(spark, landed + "/*", ev.schema, max_files_per_trigger=1)
    raw = M.raw_order_events(spark, stream, *dims, duplicate_every=None)
    ts = "2024-02-02 00:00:00"
    latest, q = S.stream_to_snapshot(spark, raw, "t-o2-latest", merge=S.latest_event_merge(ts))
    assert len(q.recentProgress) == 3
    out = S.silver_from_snapshot(latest, ts)
    batch = M.to_silver(M.to_bronze(M.raw_order_events(spark, ev, *dims), ts), ts)
    assert out.count() == batch.count()
    assert out.exceptAll(batch).count() == 0


def test_partitioned_latest_table_rewrites_only_touched_days(spark, tmp_out):
    landed = os.path.join(tmp_out, "landed_part")
    ev = t(spark, SF_SMALL, "events")
    hour, day = F.hour("ts"), F.dayofmonth("ts")
    ev.filter(hour >= 12).coalesce(1).write.parquet(os.path.join(landed, "a"))
    ev.filter(hour < 12).coalesce(1).write.parquet(os.path.join(landed, "b"))
    ev.filter(day == 3).coalesce(1).write.parquet(os.path.join(landed, "c"))        # one day re-delivered
    dims = [t(spark, SF_SMALL, n) for n in ("customer", "nation", "region")]
    stream = S.read_landed(spark, landed + "/*", ev.schema, max_files_per_trigger=1)
    raw = M.raw_order_events(spark, stream, *dims, duplicate_every=None)
    ts = "2024-02-02 00:00:00"
    table, q = S.stream_to_partitioned_table(spark, raw, "t-part", S.latest_event_merge(ts), "event_day", S.order_day)
    assert len(q.recentProgress) == 3
    out = S.silver_from_snapshot(table.drop("event_day"), ts)
    batch = M.to_silver(M.to_bronze(M.raw_order_events(spark, ev, *dims), ts), ts)
    assert out.count() == batch.count() and out.exceptAll(batch).count() == 0


def _mixed_order(spark, landed):
    ev = t(spark, SF_SMALL, "events")
    day, hour = F.dayofmonth("ts"), F.hour("ts")
    for name, part in (("a", ev.filter(day >= 20)), ("b", ev.filter((day < 20) & (hour >= 12))),
                       ("c", ev.filter((day < 20) & (hour < 12))), ("d", ev.filter(day % 7 == 0))):     # d comes again
        part.coalesce(1).write.parquet(os.path.join(landed, name))
    return ev


def test_bronze_and_gold_by_day_equal_batch_for_files_in_mixed_order(spark, tmp_out):
    landed = os.path.join(tmp_out, "landed")
    ev = _mixed_order(spark, landed)
    sink = S.RecomputeSink(S.events_by_day(os.path.join(tmp_out, "events"), "event_id", "ts"), os.path.join(tmp_out, "gold"),
                           lambda rows: S.daily_gold(rows, "ts", ["event_type"], "value"))
    stream = S.read_landed(spark, landed + "/*", ev.schema, max_files_per_trigger=1)
    q = S.run_available_now(stream, sink, os.path.join(tmp_out, "ckpt"))
    assert len(q.recentProgress) == 4
    bronze = sink.source.latest(spark).select(ev.columns)
    assert bronze.count() == ev.count() and bronze.exceptAll(ev).count() == 0
    gold = sink.latest(spark).select("event_day", "event_type", "n", "total_value")
    batch = S.daily_gold(ev.withColumn("event_day", F.to_date("ts")), "ts", ["event_type"], "value")
    assert gold.count() == batch.count() and gold.exceptAll(batch).count() == 0


def test_sinks_go_on_after_a_restart_and_keep_the_null_partition(spark, tmp_out):
    def rows(*r):
        return spark.createDataFrame(r, "id long, day string, v int")

    def new_process():
        return (S.PartitionedTableSink(os.path.join(tmp_out, "part"), S.keep_each_id("id"), "day", lambda b: b),
                S.SnapshotSink(os.path.join(tmp_out, "snap"), lambda prev, b: b if prev is None else prev.unionByName(b).distinct()),
                S.AppendSink(os.path.join(tmp_out, "app")))

    batches = [rows((1, "2024-01-01", 1), (2, None, 2)), rows((3, "2024-01-01", 3), (4, None, 4), (None, None, 5)),
               rows((5, "2024-01-02", 6), (None, None, 5))]
    for i, b in enumerate(batches):
        for sink in new_process():          # nothing is remembered but what is stored
            sink(b, i)
            sink(b, i)                      # replayed
    expected = {(1, "2024-01-01", 1), (2, None, 2), (3, "2024-01-01", 3), (4, None, 4), (None, None, 5), (5, "2024-01-02", 6)}
    for sink in new_process():
        got = sink.latest(spark).select("id", F.col("day").cast("string"), "v").collect()
        assert {tuple(r) for r in got} == expected, type(sink)
        assert len(got) == (7 if isinstance(sink, S.AppendSink) else 6)
