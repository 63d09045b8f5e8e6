"""Registered queries: streaming ingest, micro-batch upsert and windowed
gold (O1-O3), each run with ``availableNow`` over the events file and read
back from its snapshot sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.plans import medallion as M
from tidepool.plans.cat_medallion import RAW_SQL, T2, silver_sql
from tidepool.plans.common import t
from tidepool.plans.registry import register
from tidepool.session import scratch_path
from tidepool.streaming import jobs as S

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def events_stream(spark, d):
    schema = t(spark, d, "events").schema
    return S.read_landed(spark, d, schema, glob="events.parquet")


@register("O1_stream_bronze_dedup", oracle="SELECT event_id, ts, user_id, event_type, value, props FROM events")
def o1(spark, d):
    # a table by event day, each id once: no row is too late for it
    sink = S.events_by_day(scratch_path(spark, "o1-bronze"), "event_id", "ts")
    S.run_available_now(events_stream(spark, d), sink, scratch_path(spark, "o1-ckpt"))
    return sink.latest(spark).select(*EVENT_COLS)


def landed_by_days(spark, d, bounds, name):
    """All events landed as one file per range of days of the month, in the
    order of ``bounds``, read one file a batch."""
    ev, base = t(spark, d, "events").select(*EVENT_COLS), scratch_path(spark, name)
    for i, (lo, hi) in enumerate(bounds):
        day = F.dayofmonth("ts")
        ev.where((day >= lo) & (day < hi)).coalesce(1).write.parquet(f"{base}/part{i}")
    return S.read_landed(spark, base + "/*", ev.schema, max_files_per_trigger=1)


@register("O1w_stream_bronze_watermark", oracle="""
SELECT event_id, ts, user_id, event_type, value, props, day(ts) < 10 AS late FROM events
""")
def o1w(spark, d):
    """Bounded state: files land newest first with a delay of a day, so the
    third is behind the watermark; its rows come out on the late side."""
    stream = landed_by_days(spark, d, [(20, 32), (10, 20), (1, 10)], "o1w-landed")
    bronze, _ = S.stream_to_snapshot(spark, S.stream_bronze(stream, "event_id", "ts", "1 day"), "o1w")
    late = S.late_rows(t(spark, d, "events").select(*EVENT_COLS), bronze, "event_id")
    return bronze.select(*EVENT_COLS, F.lit(False).alias("late")).unionByName(late.withColumn("late", F.lit(True)))


@register("O2_stream_upsert_silver", oracle=f"SELECT * FROM {silver_sql(RAW_SQL, T2)} s")
def o2(spark, d):
    raw = M.raw_order_events(spark, events_stream(spark, d), t(spark, d, "customer"), t(spark, d, "nation"),
                             t(spark, d, "region"), duplicate_every=None)
    # latest event per order, kept in a table partitioned by event day:
    # each micro-batch rewrites only the days it touched
    latest, _ = S.stream_to_partitioned_table(spark, raw, "o2-latest", S.latest_event_merge(T2),
                                              "event_day", S.order_day)
    return S.silver_from_snapshot(latest.drop("event_day"), T2)


O3_SQL = """
SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS window_start, event_type, COUNT(*) AS n,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events GROUP BY 1, 2
"""


@register("O3_stream_windowed_gold", oracle=O3_SQL)
def o3(spark, d):
    # each batch rebuilds the aggregate of the days it touched from the events by day
    sink = S.RecomputeSink(S.events_by_day(scratch_path(spark, "o3-events"), "event_id", "ts"), scratch_path(spark, "o3-gold"),
                           lambda events: S.daily_gold(events, "ts", ["event_type"], "value"))
    S.run_available_now(events_stream(spark, d), sink, scratch_path(spark, "o3-ckpt"))
    return sink.latest(spark).select(F.col("event_day").cast("timestamp").alias("window_start"), "event_type", "n",
                                     F.col("total_value").cast("double").alias("total_value"))


@register("O3w_stream_windowed_gold_watermark", oracle=O3_SQL)
def o3w(spark, d):
    """Bounded state: windows are kept for the delay and written in update
    mode; with days landed out of order by less than the delay none is lost."""
    stream = landed_by_days(spark, d, [(8, 16), (1, 8), (16, 32)], "o3w-landed")
    gold = S.windowed_gold(stream, "ts", "20 days", ["event_type"], "value")
    out, _ = S.stream_to_snapshot(spark, gold, "o3w", merge=S.window_upsert_merge(["event_type"]), mode="update")
    return out.select("window_start", "event_type", "n", F.col("total_value").cast("double").alias("total_value"))
