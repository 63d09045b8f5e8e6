"""Heavy hitters by sketch equal the exact count of all keys."""

import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators import joins as J


@pytest.fixture(scope="module")
def keys(spark):
    rnd = random.Random(6)
    rows = [rnd.choice(["hot"] * 8 + [None, f"k{int(rnd.paretovariate(0.8))}"]) for _ in range(20_000)]
    rows += [f"once{i}" for i in range(20_000)]           # a long tail that crowds a small summary
    rnd.shuffle(rows)
    return spark.createDataFrame([(k, i) for i, k in enumerate(rows)], "k string, v int").repartition(6).cache()


@pytest.mark.parametrize("share", [0.5, 0.3, 0.05, 0.004, 0.0005])
def test_heavy_hitters_equal_the_exact_count(keys, share):
    total = keys.where("k IS NOT NULL").count()
    expected = keys.where("k IS NOT NULL").groupBy("k").count().where(F.col("count") >= share * total)
    got = J.heavy_hitters(keys, "k", share)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_small_shares_and_empty_tables(keys, monkeypatch):
    monkeypatch.setattr(J, "SKETCH_ITEMS", 10)            # beyond the sketch: over all keys
    test_heavy_hitters_equal_the_exact_count(keys, 0.05)
    assert J.heavy_hitters(keys.where("1 = 0"), "k", 0.5).collect() == []
    with pytest.raises(ValueError):
        J.heavy_hitters(keys, "k", 0)


def test_a_salted_join_takes_them_as_hot_keys(spark, keys):
    dim = keys.select("k").distinct().where("k IS NOT NULL").withColumn("d", F.length("k"))
    got = J.salted_join(keys, dim, "k", 4, hot=J.heavy_hitters(keys, "k", 0.1), rows_per_salt=1000)
    expected = keys.join(dim, "k")
    assert got.count() == expected.count() and got.select(expected.columns).exceptAll(expected).count() == 0
