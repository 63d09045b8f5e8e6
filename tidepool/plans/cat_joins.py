"""Registered queries: joins.

Join results are summarised per group so the checker compares every joined
row's contribution without shipping the whole join back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators import joins as J
from tidepool.plans.common import dbl, money, money_words, sum_of_words, t
from tidepool.plans.registry import register

# The same summary of lineitem x orders for C1-C4 and C8: they must agree.
JOIN_SUMMARY_SQL = """
SELECT o.o_orderstatus, l.l_returnflag, COUNT(*) AS n_lines,
       CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       COUNT(DISTINCT o.o_custkey) AS n_customers
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderstatus, l.l_returnflag
"""


def _summary(joined):
    return joined.groupBy("o_orderstatus", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n_lines"),
        dbl(F.sum(money("l_extendedprice"))).alias("revenue"),
        F.count_distinct("o_custkey").alias("n_customers"))


def _li(spark, d):
    return t(spark, d, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_extendedprice", "l_returnflag")


def _ord(spark, d):
    return t(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus", "o_custkey")


@register("C1_inner_equi_join", oracle=JOIN_SUMMARY_SQL)
def c1(spark, d):
    return _summary(J.equi_join(_li(spark, d), _ord(spark, d), "orderkey"))


@register("C2_broadcast_hash_join", oracle="""
SELECT p.p_type, COUNT(*) AS n_lines, SUM(l.l_quantity) AS qty
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_type
""")
def c2(spark, d):
    li = t(spark, d, "lineitem").select("l_partkey", "l_quantity")
    part = t(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    # part is a dimension: broadcast only after its size is proven
    joined = J.join_dim(li, part, "l_partkey")
    return joined.groupBy("p_type").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty"))


@register("C3_sort_merge_join", oracle=JOIN_SUMMARY_SQL)
def c3(spark, d):
    return _summary(J.hinted_join(_li(spark, d), _ord(spark, d), "orderkey", "merge"))


@register("C4_shuffle_hash_join", oracle=JOIN_SUMMARY_SQL)
def c4(spark, d):
    return _summary(J.hinted_join(_li(spark, d), _ord(spark, d), "orderkey", "shuffle_hash"))


@register("C5_shuffle_replicate_nl", oracle="""
SELECT r.r_name, COUNT(*) AS n_suppliers
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey <= r.r_regionkey AND n.n_regionkey >= r.r_regionkey
GROUP BY r.r_name
""")
def c5(spark, d):
    # nested-loop join on a non-equi condition between two bounded tables
    # (nations x regions), then an ordinary join to the supplier table.
    n = t(spark, d, "nation")
    r = t(spark, d, "region")
    nr = n.hint("shuffle_replicate_nl").join(
        r, (n.n_regionkey <= r.r_regionkey) & (n.n_regionkey >= r.r_regionkey))
    s = t(spark, d, "supplier")
    return (s.join(J.maybe_broadcast(nr), s.s_nationkey == nr.n_nationkey)
            .groupBy("r_name").agg(F.count(F.lit(1)).alias("n_suppliers")))


@register("C6_cross_join_report_grid", oracle="""
WITH months AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
rev AS (
  SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month, r.r_name,
         SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS rev
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY 1, 2)
SELECT m.month, g.r_name, CAST(COALESCE(rev.rev, 0) AS DOUBLE) AS revenue
FROM months m CROSS JOIN region g LEFT JOIN rev ON rev.month = m.month AND rev.r_name = g.r_name
""")
def c6(spark, d):
    o = t(spark, d, "orders").select("o_custkey", "o_totalprice",
                                     F.trunc(F.to_date("o_orderdate"), "month").alias("month"))
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = t(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    r = t(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    rev = (J.join_dim(J.join_dim(J.join_dim(o, c, "o_custkey"), n, "c_nationkey"), r, "n_regionkey")
           .groupBy("month", "r_name").agg(F.sum(money("o_totalprice")).alias("rev")))
    months = o.select("month").distinct()
    # dense month x region grid; the region side is size-checked before the product
    grid = J.cross_small(months, r.select("r_name"))
    return (grid.join(rev, ["month", "r_name"], "left")
            .select("month", "r_name", dbl(F.coalesce("rev", F.lit(0))).alias("revenue")))


@register("C7_theta_join_price_bands", oracle="""
WITH b AS (SELECT MIN(p_retailprice) AS lo, MAX(p_retailprice) AS hi FROM part),
bands AS (
  SELECT i AS band, lo + (hi - lo) * i / 10.0 AS band_lo, lo + (hi - lo) * (i + 1) / 10.0 AS band_hi
  FROM b, range(10) r(i))
SELECT bands.band, COUNT(*) AS n_parts
FROM part p JOIN bands ON p.p_retailprice >= bands.band_lo
  AND (p.p_retailprice < bands.band_hi OR (bands.band = 9 AND p.p_retailprice <= bands.band_hi))
GROUP BY bands.band
""")
def c7(spark, d):
    part = t(spark, d, "part")
    b = part.agg(F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi"))
    bands = (spark.range(10).withColumnRenamed("id", "band").crossJoin(b)
             .select("band", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("band") / 10.0).alias("band_lo"),
                     (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("band") + 1) / 10.0).alias("band_hi")))
    cond = ((part.p_retailprice >= bands.band_lo)
            & ((part.p_retailprice < bands.band_hi) | ((bands.band == 9) & (part.p_retailprice <= bands.band_hi))))
    return J.theta_join_small(part, bands, cond).groupBy("band").agg(F.count(F.lit(1)).alias("n_parts"))


# price bands of every part, a few of them very wide
BANDS_SQL = """(SELECT p_partkey, CAST(p_retailprice AS DECIMAL(18,2)) * 20 AS band_lo,
  CAST(p_retailprice AS DECIMAL(18,2)) * 20 + p_size * CASE WHEN p_partkey % 97 = 0 THEN 1000 ELSE 5 END AS band_hi FROM part)"""


@register("C7b_band_join_two_large_sides", oracle=f"""
SELECT p_partkey, COUNT(*) AS n_lines, CAST(SUM(price) AS DOUBLE) AS total_price
FROM (SELECT CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem) l
JOIN {BANDS_SQL} b ON l.price >= b.band_lo AND l.price < b.band_hi
GROUP BY p_partkey
""")
def c7b(spark, d):
    part, price = t(spark, d, "part"), money("p_retailprice") * 20
    wide = F.when(F.col("p_partkey") % 97 == 0, F.lit(1000)).otherwise(F.lit(5))
    bands = part.select("p_partkey", price.alias("band_lo"), (price + F.col("p_size") * wide).alias("band_hi"))
    lines = t(spark, d, "lineitem").select(money("l_extendedprice").alias("price"), F.col("l_orderkey"), F.col("l_linenumber"))
    lines = lines.select("*", *money_words("price", "price_high", "price_low"))
    return (J.band_join(lines, bands, "price", "band_lo", "band_hi").groupBy("p_partkey")
            .agg(F.count(F.lit(1)).alias("n_lines"), dbl(sum_of_words("price_high", "price_low")).alias("total_price")))


@register("C8k_heavy_hitters_by_sketch", oracle="""
WITH n AS (SELECT COUNT(*) AS total FROM lineitem)
SELECT l_suppkey, COUNT(*) AS n_lines FROM lineitem, n GROUP BY l_suppkey, total HAVING COUNT(*) >= ceil(0.0102 * total)
""")
def c8k(spark, d):
    return J.heavy_hitters(t(spark, d, "lineitem"), "l_suppkey", 0.0102).select("l_suppkey", F.col("_n").alias("n_lines"))


@register("C8_salted_join", oracle=JOIN_SUMMARY_SQL)
def c8(spark, d):
    li, o = _li(spark, d), _ord(spark, d)
    # keys of 50k lines or more get a salt per 50k lines; the others join plain
    hot = J.hot_keys(li, "orderkey", min_rows=50_000)
    return _summary(J.salted_join(li, o, "orderkey", 1, hot=hot, rows_per_salt=50_000))


@register("C8b_salted_join_all_keys", oracle=JOIN_SUMMARY_SQL)
def c8b(spark, d):
    return _summary(J.salted_join(_li(spark, d), _ord(spark, d), "orderkey", 8))


@register("C9_anti_join_new_keys", oracle="""
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def c9(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey")
    seen = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.anti_join(o, seen, "o_orderkey")


@register("C10_star_join", oracle="""
SELECT n.n_name, p.p_type, COUNT(*) AS n_lines,
       CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE l.l_shipdate >= TIMESTAMP '1997-01-01' AND l.l_shipdate < TIMESTAMP '1999-01-01'
  AND o.o_orderpriority IN ('1-URGENT', '2-HIGH')
GROUP BY n.n_name, p.p_type
""")
def c10(spark, d):
    from tidepool.operators.shape import date_range_filter
    li = date_range_filter(t(spark, d, "lineitem"), "l_shipdate", "1997-01-01", "1999-01-01").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_discount")
    # filter first: both filters reach the parquet scans
    o = (t(spark, d, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
         .select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"))
    p = t(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = t(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    fact = li.join(o, "l_orderkey")                       # fact x fact: shuffle join
    star = J.join_dim(J.join_dim(J.join_dim(fact, p, "l_partkey"), c, "o_custkey"), n, "c_nationkey")
    return star.groupBy("n_name", "p_type").agg(
        F.count(F.lit(1)).alias("n_lines"),
        dbl(F.sum(money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)")))).alias("revenue"))


@register("C11_in_list_as_semi_join", oracle="""
SELECT l_returnflag, COUNT(*) AS n_lines FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') OR p_size > 45)
GROUP BY l_returnflag
""")
def c11(spark, d):
    keys = (t(spark, d, "part").filter(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3") | (F.col("p_size") > 45))
            .select(F.col("p_partkey").alias("l_partkey")))
    li = J.filter_in(t(spark, d, "lineitem"), keys, "l_partkey")
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_lines"))


@register("C12_above_group_average", oracle="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
WHERE o_totalprice > (SELECT AVG(o2.o_totalprice) FROM orders o2 WHERE o2.o_custkey = o.o_custkey)
""")
def c12(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return J.above_group_average(o, "o_custkey", "o_totalprice")


# 80% hot key, derived from lineitem: rows with (orderkey * 7 + linenumber) % 5 <> 0
# are re-keyed to order 0 (the skew case of the reference's join chapter).
HOT_SQL = """
SELECT o.o_orderstatus, l.l_returnflag, COUNT(*) AS n_lines,
       CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       COUNT(DISTINCT o.o_custkey) AS n_customers
FROM (SELECT CASE WHEN (l_orderkey * 7 + l_linenumber) % 5 <> 0 THEN 0 ELSE l_orderkey END AS orderkey,
             l_extendedprice, l_returnflag FROM lineitem) l
JOIN orders o ON l.orderkey = o.o_orderkey
GROUP BY o.o_orderstatus, l.l_returnflag
"""


def _li_hot(spark, d):
    li = t(spark, d, "lineitem")
    hot = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 5 != 0
    return li.select(F.when(hot, F.lit(0).cast("bigint")).otherwise(F.col("l_orderkey")).alias("orderkey"),
                     "l_extendedprice", "l_returnflag")


@register("C1h_plain_join_hot_key", oracle=HOT_SQL)
def c1h(spark, d):
    # plain shuffle join: the hot key's rows meet in one task (AQE may split it)
    return _summary(J.equi_join(_li_hot(spark, d), _ord(spark, d), "orderkey"))


@register("C8h_salted_join_hot_key", oracle=HOT_SQL)
def c8h(spark, d):
    li = _li_hot(spark, d)
    hot = J.hot_keys(li, "orderkey", min_rows=1000)      # exact counts; here: order 0
    # one salt per 50k rows of a hot key, however many that takes
    return _summary(J.salted_join(li, _ord(spark, d), "orderkey", 1, hot=hot, rows_per_salt=50_000))
