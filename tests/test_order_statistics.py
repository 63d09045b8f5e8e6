"""Ranks and percentiles when one value makes up most of a group, and beyond 2^31 rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.operators import skew as SK


@pytest.fixture(scope="module")
def tied(spark):
    """Two groups; in the large one 90% of the rows have the value 7; some values are NULL."""
    rnd = random.Random(4)
    rows = [(i, "a", 7 if rnd.random() < 0.9 else rnd.choice([None, *range(20)])) for i in range(20_000)]
    rows += [(100_000 + i, None if i % 2 else "b", rnd.choice([1, 2, 2, 3, None])) for i in range(50)]
    return spark.createDataFrame(rows, "id long, k string, v int").repartition(5).cache()


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("n_chunks", [1, 7, 40])
@pytest.mark.parametrize("down", [False, True])
def test_ranks_of_tied_rows_equal_the_plain_window(tied, down, n_chunks):
    order = [F.col("v").desc() if down else F.col("v")]
    w = Window.partitionBy("k").orderBy(*order)
    expected = tied.select("id", F.rank().over(w).cast("bigint").alias("rank"), F.dense_rank().over(w).cast("bigint").alias("dense_rank"))
    got = SK.ranked(tied, ["k"], order, n_tiles=4, n_chunks=n_chunks).cache()
    assert rows_of(got.select("id", "rank", "dense_rank")) == rows_of(expected)
    # row numbers are a permutation in value order, tiles follow from them
    n = got.where("k = 'a'").count()
    assert sorted(r[0] for r in got.where("k = 'a'").select("row_number").collect()) == list(range(1, n + 1))
    back = got.withColumn("_r", F.rank().over(Window.partitionBy("k").orderBy("row_number")))
    assert back.where("row_number < rank OR _r <> row_number").count() == 0
    sizes = [r[0] for r in got.where("k = 'a'").groupBy("ntile").count().select("count").collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1


def test_tied_rows_are_dealt_over_the_chunks(tied):
    staged = SK.chunked(tied.where("k = 'a'").withColumn("_tie", F.xxhash64("id")), ["k"], ["v", "_tie"], 10)
    sizes = sorted(r["count"] for r in staged.groupBy(SK.CHUNK).count().collect())
    assert len(sizes) == 10 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


@pytest.mark.parametrize("n_chunks", [1, 6, 30])
def test_percentiles_equal_the_aggregate(tied, n_chunks):
    probs = {"p0": 0.0, "p07": 0.07, "p50": 0.5, "p93": 0.93, "p100": 1.0}
    expected = tied.groupBy("k").agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in probs.items()])
    got = SK.percentiles_cont(tied, ["k"], "v", probs, n_chunks=n_chunks)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.select(*got.columns).collect()))
    assert SK.percentile_cont(tied, [], "v", 0.5, n_chunks=n_chunks).first()[0] == 7.0


def test_equal_values_are_one_row_of_the_percentile(tied, monkeypatch):
    staged = []
    plain = SK.chunked
    monkeypatch.setattr(SK, "chunked", lambda *a, **b: staged.append(plain(*a, **b)) or staged[-1])
    SK.percentiles_cont(tied, ["k"], "v", {"m": 0.5}, n_chunks=5).collect()
    sizes = sorted(r["count"] for r in staged[0].groupBy(SK.CHUNK).count().collect())
    assert sum(sizes) == tied.where("v IS NOT NULL").select("k", "v").distinct().count()
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_positions_beyond_31_bits(tied, monkeypatch):
    """Earlier chunks that hold more than 2^31 rows, by a stub of the table of prefix sums."""
    more, plain = 1 << 33, SK._prefix

    def shifted(totals, keys, cols):
        return plain(totals, keys, cols).withColumns({f"_before_{c}": F.col(f"_before_{c}") + more for c in cols})

    few = tied.where("k = 'a'").limit(500).cache()
    here = {r["id"]: r for r in SK.ranked(few, ["k"], ["v", "id"], n_tiles=3, n_chunks=6).collect()}
    monkeypatch.setattr(SK, "_prefix", shifted)
    for r in SK.ranked(few, ["k"], ["v", "id"], n_chunks=6).collect():
        assert r["row_number"] == here[r["id"]]["row_number"] + more
        assert r["rank"] == here[r["id"]]["rank"] + more and r["dense_rank"] == here[r["id"]]["dense_rank"] + more


def test_percentile_of_more_than_31_bits_of_rows(spark, monkeypatch):
    """A count of 2^32 per value, by a stub of the counted table."""
    plain = SK.chunked
    monkeypatch.setattr(SK, "chunked", lambda df, *a, **b: plain(df.withColumn("_n", F.col("_n") * (1 << 32)), *a, **b))
    rows = spark.createDataFrame([("a", v) for v in (1, 2, 3, 10)], "k string, v long")
    got = SK.percentiles_cont(rows, ["k"], "v", {"lo": 0.25, "mid": 0.5, "hi": 0.9}, n_chunks=3).first()
    assert (got["lo"], got["mid"], got["hi"]) == (1.75, 2.5, 10.0)
