"""RANGE frames as differences of running sums, against the plain window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.operators.range_frames import range_sums
from tidepool.operators.windows import rolling_days


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds 80% of the rows, 30% of those at one position; some
    positions, values and keys are NULL, some values are negative."""
    rnd = random.Random(11)
    rows = []
    for i in range(4000):
        k = "hot" if rnd.random() < 0.8 else rnd.choice(["a", "b", None])
        x = 50 if rnd.random() < 0.3 else rnd.choice([None, *range(-40, 200)])
        rows.append((i, k, x, rnd.choice([None, rnd.randint(-10**6, 10**6)]), rnd.randint(-9, 9)))
    rows += [(10_000, "empty", 1, None, 1), (10_001, "alone", None, 5, 1)]
    frame = spark.createDataFrame(rows, "id long, k string, x int, cents long, small int").repartition(5)
    return frame.withColumn("amt", (F.col("cents") / 100).cast("decimal(12,2)")).cache()


def plain(df, keys, before, after):
    w = Window.partitionBy(*keys).orderBy("x").rangeBetween(-before, after)
    return df.select("id", F.sum("amt").over(w).alias("s"), F.sum("small").over(w).alias("i"),
                     F.count(F.lit(1)).over(w).alias("n"), F.count("amt").over(w).alias("c"))


@pytest.mark.parametrize("before, after, n_chunks", [(6, 0, 6), (0, 0, 6), (3, 5, 1), (3, 5, 6), (3, 5, 30), (1000, 1000, 6),
                                                     (9, -2, 6), (-2, 9, 6)])
def test_equals_the_plain_range_frame(skewed, before, after, n_chunks):
    got = range_sums(skewed, "k", "x", before, after, {"s": "amt", "i": "small"}, "n", {"c": "amt"}, n_chunks=n_chunks)
    got, expected = got.select("id", "s", "i", "n", "c"), plain(skewed, ["k"], before, after)
    assert dict(got.dtypes) == dict(expected.dtypes)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_no_keys_and_no_rows(spark, skewed):
    got = range_sums(skewed, None, "x", 2, 2, {"s": "amt"}, n_chunks=6).select("id", "s")
    w = Window.partitionBy(F.lit(1)).orderBy("x").rangeBetween(-2, 2)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, skewed.select("id", F.sum("amt").over(w)).collect()))
    empty = range_sums(skewed.limit(0), "k", "x", 2, 2, {"s": "amt"}, "n")
    assert empty.columns == [*skewed.columns, "s", "n"] and empty.count() == 0


def test_the_hot_key_is_cut_into_chunks(skewed, monkeypatch):
    from tidepool.operators import skew as SK
    seen, cut = [], SK.chunked
    monkeypatch.setattr(SK, "chunked", lambda *a: seen.append(cut(*a)) or seen[-1])
    range_sums(skewed, "k", "x", 6, 0, {"s": "amt"}, n_chunks=12)
    sizes = [r[0] for r in seen[0].groupBy(SK.CHUNK).count().select("count").collect()]
    assert len(sizes) >= 10 and max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]


def test_refuses_what_it_cannot_answer(skewed):
    with pytest.raises(TypeError):
        range_sums(skewed.withColumn("f", F.lit(1.5)), "k", "x", 1, 0, {"s": "f"})
    with pytest.raises(ValueError):
        range_sums(skewed, "k", "x", 1, -2, {"s": "amt"})


def test_rolling_days_split_equals_the_window(spark):
    rows = spark.sql("SELECT id, id % 2 AS k, date_add(DATE '2024-02-20', int(id * 7 % 31)) AS day, "
                     "CAST(id AS DECIMAL(10,2)) AS v FROM range(300)")
    for agg in ("sum", "count"):
        a = rolling_days(rows, "v", "k", "day", 7, out="r", agg=agg).select("id", "r")
        b = rolling_days(rows, "v", "k", "day", 7, out="r", agg=agg, skew_safe=True).select("id", "r")
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
