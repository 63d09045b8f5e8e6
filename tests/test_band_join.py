"""Band joins by bins against the nested loop."""

import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators import joins as J
from tidepool.plans import common as C


@pytest.fixture(scope="module")
def sides(spark):
    rnd = random.Random(8)
    values = [rnd.choice([rnd.uniform(-500, 500), 17.0]) for _ in range(3000)] + [None, float("nan"), 0.0, -500.0, 500.0]
    points = spark.createDataFrame(list(enumerate(values)), "id long, x double").repartition(4)
    bands = [(i, a := rnd.uniform(-500, 500), a + rnd.choice([0.0, 1e-9, 0.5, 3, 40, 900])) for i in range(150)]
    bands += [(900, None, -400.0), (901, 450.0, None), (902, None, None), (903, 10.0, 5.0), (904, 17.0, 17.0), (905, -1e9, 1e9), (906, 600.0, 700.0)]
    return points, spark.createDataFrame(bands, "band long, lo double, hi double")


def exact(closed):
    below = F.col("x") <= F.col("hi") if closed else F.col("x") < F.col("hi")
    return F.col("x").isNotNull() & ~F.isnan("x") & (F.col("lo").isNull() | (F.col("lo") <= F.col("x"))) & (F.col("hi").isNull() | below)


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("rows_per_salt", [50, 1_000_000])
def test_band_join_equals_the_nested_loop(sides, closed, rows_per_salt):
    points, bands = sides
    reversed_ = F.coalesce(F.col("lo") <= F.col("hi"), F.lit(True))
    expected = points.join(bands.where(reversed_), exact(closed)).select("id", "band")
    got = J.band_join(points, bands, "x", "lo", "hi", closed, rows_per_salt).select("id", "band")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_band_join_has_no_nested_loop(sides):
    points, bands = sides
    plan = J.band_join(points, bands, "x", "lo", "hi")._jdf.queryExecution().explainString(
        points.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_band_join_of_dates_and_empty_sides(spark, sides):
    days = spark.sql("SELECT id, date_add(DATE '2024-01-01', CAST(id % 60 AS INT)) AS d FROM range(300)").select("id", F.unix_date("d").alias("x"))
    weeks = spark.sql("SELECT id AS band, CAST(19723 + id * 7 AS INT) AS lo, CAST(19730 + id * 7 AS INT) AS hi FROM range(9)")
    got = J.band_join(days, weeks, "x", "lo", "hi").groupBy("band").count().collect()
    assert sum(r["count"] for r in got) == 300 and len(got) == 9
    points, bands = sides
    assert J.band_join(points.where("1 = 0"), bands, "x", "lo", "hi").collect() == []
    assert J.band_join(points, bands.where("1 = 0"), "x", "lo", "hi").collect() == []
    with pytest.raises(ValueError):
        J.band_join(points, points, "x", "x", "x")


def test_pairs_of_a_bin_are_dealt_over_many_tasks(spark, monkeypatch):
    """Few rows, many pairs: neither the bins nor the bytes alone spread them."""
    points = spark.range(2000).select(F.col("id"), (F.col("id") % 7).cast("double").alias("x"))
    bands = spark.range(300).select(F.col("id").alias("band"), F.lit(-1.0).alias("lo"), F.lit(8.0).alias("hi"))
    monkeypatch.setattr(J, "PAIRS_PER_SALT", 10_000, raising=False)
    joined = J.band_join(points, bands, "x", "lo", "hi").withColumn("task", F.spark_partition_id())
    assert joined.select("id", "band").distinct().count() == joined.count() == 600_000
    sizes = [r["count"] for r in joined.groupBy("task").count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 600_000 / 8


def test_bounds_closer_than_doubles_tell_apart(spark):
    big = 2 ** 60
    points = spark.createDataFrame([(big + i,) for i in range(6)], "x long")
    bands = spark.createDataFrame([(0, big + 1, big + 4), (1, big + 3, None), (2, None, big + 1)], "band int, lo long, hi long")
    got = J.band_join(points, bands, "x", "lo", "hi").select((F.col("x") - big).alias("x"), "band").collect()
    assert sorted(map(tuple, got)) == [(0, 2), (1, 0), (2, 0), (3, 0), (3, 1), (4, 1), (5, 1)]


def test_each_point_is_in_one_block_whatever_the_widths(spark, monkeypatch):
    """Bands of twelve widths: a point used to have a row for each of them."""
    points = spark.range(5000).select("id", (F.col("id") * 0.37 % 1000).alias("x"))
    bands = spark.range(240).select(F.col("id").alias("band"), (F.col("id") * 4.1).alias("lo"), (F.col("id") * 4.1 + F.pow(F.lit(2.0), F.col("id") % 12 - 3)).alias("hi"))
    dealt, join = [], J.salted_join
    monkeypatch.setattr(J, "salted_join", lambda big, small, *a, **b: dealt.extend([big, small]) or join(big, small, *a, **b))
    got = J.band_join(points, bands, "x", "lo", "hi").select("id", "band").collect()
    blocks = dealt[1].select(F.size("_points").alias("n")).collect()
    assert sum(r["n"] for r in blocks) == 5000 and max(r["n"] for r in blocks) <= J.BLOCK_POINTS[1]
    looked_at = dealt[0].join(dealt[1], "_block").agg(F.sum(F.size("_points"))).first()[0]
    assert looked_at <= 1.25 * len(got) + 2 * 240 * J.BLOCK_POINTS[0]
    assert sorted(map(tuple, got)) == sorted(map(tuple, points.join(bands, exact(False)).select("id", "band").collect()))


def test_a_value_that_most_points_have_fills_many_blocks(spark, monkeypatch):
    points = spark.range(3000).select("id", F.when(F.col("id") % 10 == 0, F.col("id").cast("double")).otherwise(17.0).alias("x"))
    bands = spark.createDataFrame([(0, 17.0, 17.5), (1, 16.0, 17.0), (2, 17.1, 19.0), (3, None, None), (4, -5.0, 17.0), (5, float("nan"), None), (6, 18.0, float("nan"))], "band int, lo double, hi double")
    monkeypatch.setattr(J, "MOST_CUTS", 20, raising=False)
    for closed in (False, True):
        got = J.band_join(points, bands, "x", "lo", "hi", closed).select("id", "band").collect()
        expected = points.join(bands.where("band <> 5"), exact(closed)).select("id", "band").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, expected))


def test_band_join_takes_maps_on_both_sides(spark):
    points = spark.range(50).select("id", F.col("id").cast("double").alias("x"), F.create_map(F.lit("p"), "id").alias("of_point"))
    bands = spark.range(5).select(F.create_map(F.lit("b"), "id").alias("of_band"), (F.col("id") * 10.0).alias("lo"), (F.col("id") * 10.0 + 4).alias("hi"))
    got = J.band_join(points, bands, "x", "lo", "hi").select("of_point.p", "of_band.b").collect()
    assert sorted(map(tuple, got)) == [(i, i // 10) for i in range(50) if i % 10 < 4]


def test_sums_of_money_words_are_exact(spark):
    rows = [(1, "9999999999999999.99")] * 300 + [(2, "-0.01"), (2, "-9999999999999999.99"), (2, "42949672.96"), (3, None), (4, "0.00")]
    money = spark.createDataFrame(rows, "k int, m string").select("k", F.col("m").cast("decimal(18,2)").alias("m"))
    words = money.select("k", "m", *C.money_words("m", "high", "low")).groupBy("k").agg(F.sum("m").alias("m"), C.sum_of_words("high", "low").alias("w"))
    assert {r["k"]: r["w"] for r in words.collect()} == {r["k"]: r["m"] for r in words.collect()}
    assert words.schema["w"].dataType == words.schema["m"].dataType
