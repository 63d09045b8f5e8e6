"""Histories, net changes and Gold kept from batches equal one run over everything."""

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators import changes as CH
from tidepool.plans import medallion as M
from tidepool.sources.partitions import PartitionStore

RECORDS = "k string, a int, note string, ts int"


def same(got, expected):
    assert sorted(map(str, got.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))


def records(seed, n=60):
    rnd = random.Random(seed)
    return [(k, rnd.choice([1, 2, None]), rnd.choice("xy"), ts) for k in ("a", "b", None) for ts in rnd.sample(range(100), n // 3)]


def plain_history(rows, tracked):
    out = []
    for k in {r[0] for r in rows}:
        versions = []
        for r in sorted((r for r in rows if r[0] == k), key=lambda r: r[3]):
            if not versions or tracked(versions[-1][1]) != tracked(r):
                versions.append((r, r))
            else:
                versions[-1] = (versions[-1][0], r)
        for (v, _), nxt in itertools.zip_longest(versions, [v for v, _ in versions[1:]]):
            out.append((*v[:3], v[3], nxt[3] if nxt else None, nxt is None))
    return sorted(out, key=str)


@pytest.mark.parametrize("tracked", [None, ["a"]])
def test_history_from_batches_in_any_order(spark, tracked):
    rows = records(1)
    want = plain_history(rows, (lambda r: r[1]) if tracked else (lambda r: r[1:3]))
    random.Random(2).shuffle(rows)
    history = None
    for i in range(0, len(rows), 25):
        batch = spark.createDataFrame(rows[max(0, i - 5):i + 25], RECORDS)           # some records come twice
        history = CH.scd2_apply(history, batch, "k", "ts", tracked)
        history = spark.createDataFrame(history.collect(), history.schema)           # written and read
    got = CH.scd2_versions(history).select("k", "a", "note", "valid_from", "valid_to", "is_current")
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_a_late_record_splits_an_interval_and_a_repeat_comes_back(spark):
    first = spark.createDataFrame([("a", 1, "x", 1), ("a", 1, "x", 5)], RECORDS)
    history = CH.scd2_apply(None, first, "k", "ts")
    assert [(r.valid_from, r.valid_to) for r in CH.scd2_versions(history).collect()] == [(1, None)]
    late = spark.createDataFrame([("a", 2, "x", 3)], RECORDS)
    got = CH.scd2_versions(CH.scd2_apply(history, late, "k", "ts", skew_safe=True)).collect()
    assert sorted((r.valid_from, r.valid_to, r.a, r.is_current) for r in got) == [(1, 3, 1, False), (3, 5, 2, False), (5, None, 1, True)]


def test_history_store_reads_only_the_buckets_of_the_batch(spark, tmp_out):
    rows = [(f"k{i}", i, "x", 1) for i in range(40)]
    df = spark.createDataFrame(rows, RECORDS).withColumn("bucket", CH.key_bucket("k", 8))
    store = PartitionStore(spark, os.path.join(tmp_out, "h"), "bucket")
    CH.scd2_store(store, df, "k", "ts")
    before = store._state(1)["partitions"]
    CH.scd2_store(store, df.where("k = 'k7'").withColumn("ts", F.lit(9)).withColumn("a", F.lit(-1)), "k", "ts")
    after = store._state(2)["partitions"]
    assert sum(before[p] != after[p] for p in before) == 1
    got = CH.scd2_versions(store.read()).where("k = 'k7'").orderBy("valid_from").collect()
    assert [(r.a, r.valid_from, r.valid_to) for r in got] == [(7, 1, 9), (-1, 9, None)] and store.read().count() == 41


def snapshots(spark, seed, n=4):
    rnd = random.Random(seed)
    for _ in range(n):
        yield spark.createDataFrame([(i, rnd.choice([1, 2, None])) for i in range(30) if rnd.random() < 0.7], "id long, v int")


@pytest.mark.parametrize("seed", [1, 2])
def test_composed_feeds_equal_the_direct_comparison(spark, seed):
    states = list(snapshots(spark, seed))
    feeds = None
    for i, (a, b) in enumerate(zip(states, states[1:])):
        step = CH.change_feed(a, b, "id").withColumn("_commit_version", F.lit(i + 2))
        feeds = step if feeds is None else feeds.unionByName(step)
    same(CH.compose_feeds(feeds, "id"), CH.change_feed(states[0], states[-1], "id"))


def silver(spark, seed):
    rnd = random.Random(seed)
    rows = [(f"o{i}", rnd.choice(["2024-01-01", "2024-01-02"]), rnd.choice(["p", None]), rnd.choice("rs"),
             str(rnd.randint(1, 9999) / 100), rnd.choice(["completed", "shipped", "pending"]))
            for i in range(60) if rnd.random() < 0.6]
    df = spark.createDataFrame(rows, "order_id string, order_date string, product_id string, region string, amount string, status string")
    return df.withColumn("order_date", F.to_date("order_date")).withColumn("amount", F.col("amount").cast("decimal(10,2)"))


def test_gold_kept_from_feeds_equals_gold_built_anew(spark, tmp_out):
    states = [silver(spark, s) for s in (1, 2, 3)] + [silver(spark, 3).where("order_date = '2024-01-02'"), silver(spark, 3).where("1 = 0")]
    store = PartitionStore(spark, os.path.join(tmp_out, "gold"), "order_date")
    store.replace(M.to_gold(states[0]))
    gold = M.to_gold(states[0])
    for before, after in zip(states, states[1:]):
        feed = CH.change_feed(before, after, "order_id")
        gold = spark.createDataFrame(M.apply_to_gold(gold, feed).collect(), M.GOLD_SCHEMA)
        M.apply_to_gold_store(store, feed)
        same(gold, M.to_gold(after))
        same(store.read(), M.to_gold(after))
    assert store.read().count() == 0
