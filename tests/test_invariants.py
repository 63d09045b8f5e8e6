"""Invariants: salted join = plain join on an 80% hot key, change feed
replays to the new snapshot, distributed ranking = window ranking, exact
averages, approximate distinct within its error, stable hash buckets."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL
from tidepool.functions import nested as N
from tidepool.functions.scalar import exact_avg, hash_bucket
from tidepool.operators import changes as CH
from tidepool.operators import joins as J
from tidepool.operators import windows as W
from tidepool.plans import cat_changes as SNAP
from tidepool.plans.common import t


def _skewed(spark, n=50_000):
    # 80% of rows carry key C001 (reference skew example), the rest spread out
    big = spark.range(n).select(
        F.when(F.col("id") % 5 != 0, F.lit("C001"))
         .otherwise(F.concat(F.lit("C"), (F.col("id") % 997).cast("string"))).alias("k"),
        F.col("id").alias("v"))
    small = spark.range(997).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("k"),
                                    (F.col("id") * 10).alias("w"))
    small = small.unionByName(spark.range(1).select(F.lit("C001").alias("k"), F.lit(-1).cast("bigint").alias("w")))
    return big, small


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_salted_join_equals_plain_join_on_hot_key(spark, aqe):
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        big, small = _skewed(spark)
        plain = big.join(small, "k")
        hot = J.hot_keys(big, "k", min_rows=1000)
        assert [(r.k, r._n) for r in hot.collect()] == [("C001", big.filter("k = 'C001'").count())]
        salted = J.salted_join(big, small, "k", 16, hot=hot)
        assert salted.count() == plain.count()
        assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
        # hot rows really spread over the salts
        spread = (big.filter("k = 'C001'").select(hash_bucket(16, "k", "v").alias("b")).distinct().count())
        assert spread == 16
        left = J.salted_join(big, small.filter("k <> 'C5'"), "k", 8, hot=hot, how="left")
        assert left.count() == big.count()
        sized = J.salted_join(big, small, "k", 64, hot=hot, rows_per_salt=5_000)   # 40k rows -> 8 salts
        assert sized.exceptAll(plain).count() == 0 and sized.count() == plain.count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_change_feed_replays_to_new_snapshot(spark):
    old, new = SNAP.old_snapshot(spark, SF_MID), SNAP.new_snapshot(spark, SF_MID)
    feed = CH.change_feed(old, new, "c_custkey").withColumn("_commit_version", F.lit(2))
    kinds = {r["_change_type"]: r["count"] for r in feed.groupBy("_change_type").count().collect()}
    assert kinds["update_preimage"] == kinds["update_postimage"] > 0 and kinds["insert"] > 0 and kinds["delete"] > 0
    replay = CH.apply_changes(old, feed, "c_custkey")
    assert replay.exceptAll(new).count() == 0 and new.exceptAll(replay).count() == 0
    assert CH.change_feed(new, new, "c_custkey").count() == 0


def test_merge_cdc_clause_order(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    src = spark.createDataFrame([(1, "A", False), (2, "B", True), (4, "D", False), (5, "E", True)],
                                "id int, v string, is_deleted boolean")
    out = {r.id: r.v for r in CH.merge_cdc(tgt, src, "id", F.col("is_deleted")).collect()}
    assert out == {1: "A", 3: "c", 4: "D", 5: "E"}       # 2 deleted; unmatched rows inserted as in the SQL
    out2 = {r.id: r.v for r in CH.merge_cdc(tgt, src, "id", F.col("is_deleted"), insert_deleted=False).collect()}
    assert out2 == {1: "A", 3: "c", 4: "D"}


def test_scd2_drops_unchanged_versions(spark):
    ch = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", 3), (2, "x", 1)], "k int, v string, ts int")
    rows = sorted((r.k, r.v, r.valid_from, r.valid_to, r.is_current) for r in CH.scd2(ch, "k", "ts").collect())
    assert rows == [(1, "a", 1, 3, False), (1, "b", 3, None, True), (2, "x", 1, None, True)]


def test_global_row_number_and_ntile_match_windows(spark):
    c = t(spark, SF_MID, "customer").select("c_custkey", "c_acctbal").repartition(7)
    order = ["c_acctbal", "c_custkey"]
    got = W.global_row_number(c, order, "rn")
    exp = c.withColumn("rn", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert got.exceptAll(exp).count() == 0 and got.count() == c.count()
    for n in (3, 5, 7):
        g = W.global_ntile(c, order, n, "tile")
        e = c.withColumn("tile", F.ntile(n).over(Window.orderBy(*order)).cast("bigint"))
        assert g.exceptAll(e).count() == 0


def test_exact_avg_half_up(spark):
    rng = random.Random(3)
    rows = [(k, Decimal(rng.randint(-5000, 50000)) / 100) for k in range(40) for _ in range(rng.randint(1, 9))]
    df = spark.createDataFrame(rows, "k int, a decimal(10,2)")
    got = {r.k: r.m for r in df.groupBy("k").agg(exact_avg("a", 2).alias("m")).collect()}
    for k in got:
        vals = [a for kk, a in rows if kk == k]
        exact = sum(vals) / len(vals)
        q = abs(exact).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert got[k] == (q if exact >= 0 else -q)


def test_approx_count_distinct_within_error(spark):
    li = t(spark, SF_MID, "lineitem")
    exact = li.select(F.count_distinct("l_partkey")).first()[0]
    approx = li.select(F.approx_count_distinct("l_partkey", 0.02)).first()[0]
    assert abs(approx - exact) <= 0.06 * exact


def test_hash_bucket_is_stable_and_in_range(spark):
    o = t(spark, SF_SMALL, "orders").select("o_orderkey")
    a = o.select("o_orderkey", hash_bucket(16, "o_orderkey").alias("b"))
    b = o.repartition(5).select("o_orderkey", hash_bucket(16, "o_orderkey").alias("b"))
    assert a.exceptAll(b).count() == 0
    lo, hi = a.agg(F.min("b"), F.max("b")).first()
    assert 0 <= lo and hi < 16


def test_json_schema_inference_over_all_rows(spark):
    rows = [('{"a": 1}',)] * 50 + [('{"a": 2, "b": "late key"}',)]
    df = spark.createDataFrame(rows, "j string")
    schema = N.infer_json_schema(df, "j")
    assert set(schema.fieldNames()) == {"a", "b"}       # the one row with b is not sampled away
    parsed = df.select(N.parse_json("j", schema).alias("p")).select("p.*")
    assert parsed.filter("b IS NOT NULL").count() == 1


def test_to_json_round_trip(spark):
    ev = t(spark, SF_SMALL, "events").select("event_id", "event_type", "value")
    back = ev.select(F.from_json(F.to_json(F.struct(*ev.columns)), ev.schema).alias("r")).select("r.*")
    assert back.exceptAll(ev).count() == 0


def test_write_results_and_log_metrics(spark, tmp_out):
    from tidepool.operators import quality as Q
    from tidepool.plans.cat_quality import CHECKS, dq_input
    df = dq_input(spark, SF_SMALL)
    flagged = Q.flag(df, CHECKS)
    counts = Q.write_results(flagged, CHECKS, f"{tmp_out}/clean", f"{tmp_out}/quarantine", "2024-02-01 00:00:00")
    clean = spark.read.parquet(f"{tmp_out}/clean")
    quar = spark.read.parquet(f"{tmp_out}/quarantine")
    assert counts == {"passed": clean.count(), "quarantined": quar.count()}
    assert clean.count() + quar.count() == df.count()
    assert quar.filter("fail_reason = ''").count() == 0
    assert set(clean.columns) == set(df.columns)
    Q.log_metrics(Q.metrics(flagged, CHECKS, "orders_dq", run_ts="2024-02-01 00:00:00"), f"{tmp_out}/mon")
    Q.log_metrics(Q.metrics(flagged, CHECKS, "orders_dq", run_ts="2024-02-02 00:00:00"), f"{tmp_out}/mon")
    mon = spark.read.parquet(f"{tmp_out}/mon")
    assert mon.schema == Q.MONITORING_SCHEMA or [f.name for f in mon.schema] == Q.MONITORING_SCHEMA.fieldNames()
    assert mon.count() == 2 * len(CHECKS)


def test_pipeline_rerun_for_one_date_is_idempotent(spark, tmp_out):
    from tidepool.plans import medallion as M
    from tidepool.plans.cat_medallion import raw_all
    from tidepool.sources.io import overwrite_partitions
    raw = raw_all(spark, SF_SMALL)
    day = "2024-01-15"
    gold_path = f"{tmp_out}/gold"
    full = M.to_gold(M.to_silver(M.to_bronze(raw, "2024-02-01 00:00:00"), "2024-02-01 00:00:00"))
    full.write.partitionBy("order_date").parquet(gold_path)
    before = spark.read.parquet(gold_path)
    n_before = before.count()
    one_day = M.to_gold(M.to_silver(M.to_bronze(raw.filter(F.substring("event_ts", 1, 10) == day),
                                                "2024-02-01 00:00:00"), "2024-02-01 00:00:00"))
    for _ in range(2):                                   # the rerun gives the same table
        overwrite_partitions(one_day, gold_path, "order_date")
        after = spark.read.parquet(gold_path)
        assert after.count() == n_before
        assert after.exceptAll(spark.read.parquet(gold_path)).count() == 0
    assert after.filter(F.col("order_date") == day).count() == full.filter(F.col("order_date") == day).count()


def test_skew_safe_windows_split_a_hot_key_and_match_plain_windows(spark):
    from tidepool.operators import skew as SK
    big, _ = _skewed(spark, 40_000)
    df = big.withColumn("amt", (F.col("v") % 97).cast("decimal(18,2)"))
    chunks = SK.chunked(df, ["k"], ["v"], 8)
    assert chunks.filter("k = 'C001'").select("_chunk").distinct().count() >= 6
    w = Window.partitionBy("k").orderBy("v")
    plain = df.select("k", "v", F.row_number().over(w).alias("row_number"), F.rank().over(w).alias("rank"),
                      F.dense_rank().over(w).alias("dense_rank"), F.ntile(3).over(w).alias("ntile"),
                      F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs"))
    r = SK.ranked(df, ["k"], ["v"], n_tiles=3, n_chunks=8).select("k", "v", "row_number", "rank", "dense_rank", "ntile")
    assert r.exceptAll(plain.drop("rs")).count() == 0
    s = SK.running_sum(df, ["k"], ["v"], "amt", out="rs", n_chunks=8).select("k", "v", "rs")
    assert s.exceptAll(plain.select("k", "v", "rs")).count() == 0
    # ties: dense_rank over a coarse order value that repeats across many rows
    coarse = df.withColumn("g", F.col("v") % 10)
    wr = Window.partitionBy("k").orderBy("g")
    exp = coarse.select("k", "v", F.rank().over(wr).alias("rank"), F.dense_rank().over(wr).alias("dense_rank"))
    got = SK.ranked(coarse, ["k"], ["g"], n_chunks=8).select("k", "v", "rank", "dense_rank")
    assert got.exceptAll(exp).count() == 0


def test_bounded_frames_with_halo_rows_match_plain_windows(spark):
    from tidepool.operators import skew as SK
    big, _ = _skewed(spark, 30_000)
    df = big.withColumn("x", F.col("v") % 13)
    w = Window.partitionBy("k").orderBy("v")

    def build(w):
        return {"lag2": F.lag("x", 2, -1).over(w), "lead1": F.lead("x", 1).over(w),
                "r7": F.sum("x").over(w.rowsBetween(-6, 0)), "c5": F.sum("x").over(w.rowsBetween(-2, 2))}
    exp = df.select("k", "v", "x", *[c.alias(n) for n, c in build(w).items()])
    got = SK.bounded_frame(df, ["k"], ["v"], 6, 2, build, n_chunks=16).select(exp.columns)
    assert got.count() == exp.count() and got.exceptAll(exp).count() == 0
    # chunks smaller than the frame: neighbours come from several chunks back
    small = df.filter("v < 600")
    exp2 = small.select("k", "v", "x", *[c.alias(n) for n, c in build(w).items()])
    got2 = SK.bounded_frame(small, ["k"], ["v"], 6, 2, build, n_chunks=200).select(exp2.columns)
    assert got2.exceptAll(exp2).count() == 0 and exp2.exceptAll(got2).count() == 0


def test_chunked_percentiles_match_percentile_aggregate(spark):
    from tidepool.operators import skew as SK
    o = t(spark, SF_MID, "orders")
    got = {r.o_orderpriority: (r.p50, r.p90) for r in
           SK.percentiles_cont(o, ["o_orderpriority"], "o_totalprice", {"p50": 0.5, "p90": 0.9}).collect()}
    exp = {r.o_orderpriority: (r.p50, r.p90) for r in o.groupBy("o_orderpriority").agg(
        F.percentile("o_totalprice", F.lit(0.5)).alias("p50"), F.percentile("o_totalprice", F.lit(0.9)).alias("p90"))
        .collect()}
    assert got.keys() == exp.keys()
    for k in got:
        assert got[k][0] == pytest.approx(exp[k][0], rel=1e-12) and got[k][1] == pytest.approx(exp[k][1], rel=1e-12)


def test_last_before_carries_over_chunks_without_values(spark):
    from tidepool.operators import skew as SK
    big, _ = _skewed(spark, 4_000)
    df = big.withColumn("x", F.when(F.col("v") % 37 == 0, F.col("v")))     # sparse non-null values
    w = Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.select("k", "v", F.last("x", ignorenulls=True).over(w).alias("lb"))
    got = SK.last_before(df, ["k"], ["v"], "x", "lb", n_chunks=300).select("k", "v", "lb")
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_upsert_partitions_rewrites_only_touched_partitions(spark, tmp_out):
    from tidepool.operators.changes import upsert_partitions
    o = t(spark, SF_SMALL, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    path = f"{tmp_out}/by_year"
    o.write.partitionBy("y").parquet(path)

    def files(cond):
        return sorted(r.f for r in spark.read.parquet(path).filter(cond)
                      .select(F.col("_metadata.file_path").alias("f")).distinct().collect())
    others_before = files("y <> 1996")
    src = o.filter("y = 1996").limit(5).withColumn("o_totalprice", F.lit(-1.0)) \
        .unionByName(spark.createDataFrame([(10**9, 1.0, 1996)], "o_orderkey bigint, o_totalprice double, y int"))
    upsert_partitions(spark, path, src, "o_orderkey", "y")
    after = spark.read.parquet(path)
    assert files("y <> 1996") == others_before                       # untouched partitions kept their files
    assert after.count() == o.count() + 1
    assert after.filter("o_totalprice = -1.0").count() == 5
    assert after.filter("y <> 1996").exceptAll(o.filter("y <> 1996").select(after.columns)).count() == 0


def test_item_parts_split_a_hot_order_and_keep_every_line(spark):
    from tidepool.functions import nested as N
    li = t(spark, SF_SMALL, "lineitem")
    hot = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") > 1, F.lit(7)).otherwise(F.col("l_orderkey")))
    assert N.order_items(hot).count() == hot.select("l_orderkey").distinct().count()      # one row an order, at any size
    oi = N.item_parts(hot, rows_per_part=500)
    sizes = oi.filter("l_orderkey = 7").select("part", F.size("items").alias("n")).collect()
    assert len(sizes) > 1 and max(r.n for r in sizes) < 1000 and len({r.part for r in sizes}) == len(sizes)
    flat = oi.select("l_orderkey", F.inline("items"))
    exp = hot.select("l_orderkey", F.col("l_partkey").alias("partkey"), F.col("l_quantity").alias("qty"),
                     F.col("l_extendedprice").alias("price"))
    assert flat.count() == exp.count() and flat.exceptAll(exp).count() == 0


def test_window_helpers_skew_safe_flag_gives_same_rows(spark):
    o = t(spark, SF_SMALL, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    order = ["o_orderdate", "o_orderkey"]
    for plain, chunked in [
        (W.with_rankings(o, "o_custkey", order), W.with_rankings(o, "o_custkey", order, skew_safe=True)),
        (W.with_lag_lead(o, "o_totalprice", "o_custkey", order, 2, 0.0),
         W.with_lag_lead(o, "o_totalprice", "o_custkey", order, 2, 0.0, skew_safe=True)),
        (W.rolling_rows(o, "o_totalprice", "o_custkey", order, 3, 1),
         W.rolling_rows(o, "o_totalprice", "o_custkey", order, 3, 1, skew_safe=True)),
    ]:
        cols = plain.columns
        assert chunked.select(cols).exceptAll(plain).count() == 0 and chunked.count() == plain.count()


def test_silver_rejects_overflow_and_rows_without_id_stay_apart(spark):
    from tidepool.plans import medallion as M
    row = ["o1", "c1", "p1", "3", "10.00", "completed", "EU", "2024-01-01 10:00:00"]
    rows = [("1", *row), ("1", *row), (None, *row), (None, "o2", *row[1:]), (None, "o2", *row[1:]),
            ("9", "o3", "c1", "p1", "2000000000", "99999999.99", "completed", "EU", None)]
    raw = spark.createDataFrame(rows, M.BRONZE_SCHEMA)
    bronze = M.to_bronze(raw, "2024-02-01 00:00:00")
    assert bronze.count() == 4                       # id 1 once, each distinct row without an id once
    again = M.to_bronze(raw, "2024-02-02 00:00:00", existing=bronze, partition_of=M.event_day())
    assert again.count() == 0                        # a NULL event time is a partition like any other
    late = raw.where("event_id = '9'").withColumn("event_ts", F.lit("2024-01-03 00:00:00"))
    silver, rejects = M.silver_split(M.to_bronze(late, "2024-02-01 00:00:00"), "2024-02-01 00:00:00")
    assert silver.count() == 0 and [r.reject_reason for r in rejects.collect()] == ["amount:out_of_range"]


def test_salted_join_has_no_cap_on_hot_keys(spark):
    big = spark.range(30_000).select((F.col("id") % 3000).alias("k"), F.col("id").alias("v"))
    small = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    hot = J.hot_keys(big, "k", min_rows=10)
    assert hot.count() == 3000
    got = J.salted_join(big, small, "k", 1, hot=hot, rows_per_salt=4)
    assert got.count() == 30_000 and got.where("w <> 2 * k").count() == 0


def test_json_schema_of_documents_with_line_breaks(spark):
    from tidepool.functions import nested as N
    df = spark.createDataFrame([('{\n  "a": 1,\n  "b": {"c": "x"}\n}',), ('{"a": 2.5}',), (None,)], "j string")
    assert N.infer_json_schema(df, "j").simpleString() == "struct<a:double,b:struct<c:string>>"


def test_pivot_refuses_values_outside_its_columns(spark):
    from tidepool.plans import analytics as A
    lines = spark.createDataFrame([("2024-01-01", "x", 1.0), ("2024-01-01", "y", 2.0)], "month string, category string, amount double")
    with pytest.raises(Exception, match="outside the pivot"):
        A.q_category_pivot(lines, ["x"]).collect()
