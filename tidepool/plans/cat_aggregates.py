"""Registered queries: aggregation, dedup, pivot."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.operators import aggregates as AG
from tidepool.operators.joins import join_dim
from tidepool.plans.common import dbl, money, t
from tidepool.plans.registry import register


@register("D1_group_aggregate", oracle="""
SELECT l_returnflag, l_linestatus,
       SUM(l_quantity) AS sum_qty,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_base_price,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS sum_disc_price,
       SUM(l_quantity) / COUNT(*) AS avg_qty,
       MIN(l_discount) AS min_disc, MAX(l_discount) AS max_disc,
       COUNT(*) AS count_order
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def d1(spark, d):
    li = t(spark, d, "lineitem")
    return (li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"),
        dbl(F.sum(money("l_extendedprice"))).alias("sum_base_price"),
        dbl(F.sum(money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)")))).alias("sum_disc_price"),
        (F.sum("l_quantity") / F.count(F.lit(1))).alias("avg_qty"),
        F.min("l_discount").alias("min_disc"), F.max("l_discount").alias("max_disc"),
        F.count(F.lit(1)).alias("count_order")))


@register("D2_global_aggregate", oracle="""
SELECT COUNT(*) AS n_rows, SUM(l_quantity) AS total_qty,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
       MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship
FROM lineitem
""")
def d2(spark, d):
    li = t(spark, d, "lineitem")
    return li.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("total_qty"),
                  dbl(F.sum(money("l_extendedprice"))).alias("total_price"),
                  F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))


@register("D3_count_distinct", oracle="""
SELECT o_orderstatus, COUNT(DISTINCT o_custkey) AS n_customers, COUNT(*) AS n_orders
FROM orders GROUP BY o_orderstatus
""")
def d3(spark, d):
    o = t(spark, d, "orders")
    return o.groupBy("o_orderstatus").agg(F.count_distinct("o_custkey").alias("n_customers"),
                                          F.count(F.lit(1)).alias("n_orders"))


@register("D4_approx_count_distinct", oracle="""
SELECT l_returnflag, COUNT(DISTINCT l_partkey) AS n_parts, true AS parts_within, COUNT(DISTINCT l_orderkey) AS n_orders,
       true AS orders_within
FROM lineitem GROUP BY l_returnflag
""")
def d4(spark, d):
    # the estimates beside the exact counts, as whether they lie within four standard errors
    li = t(spark, d, "lineitem")

    def within(approx, exact):
        return F.abs(F.col(approx) - F.col(exact)) <= 4 * 0.02 * F.col(exact)

    approx = li.groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("a_parts"),
                                            F.approx_count_distinct("l_orderkey", 0.02).alias("a_orders"))
    exact = li.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("n_parts"),
                                           F.count_distinct("l_orderkey").alias("n_orders"))
    return approx.join(exact, "l_returnflag").select(
        "l_returnflag", "n_parts", within("a_parts", "n_parts").alias("parts_within"),
        "n_orders", within("a_orders", "n_orders").alias("orders_within"))


@register("D5_several_distinct_counts", oracle="""
SELECT l_returnflag, COUNT(DISTINCT l_partkey) AS n_distinct_l_partkey,
       COUNT(DISTINCT l_suppkey) AS n_distinct_l_suppkey,
       COUNT(DISTINCT l_orderkey) AS n_distinct_l_orderkey
FROM lineitem GROUP BY l_returnflag
""")
def d5(spark, d):
    return AG.distinct_counts(t(spark, d, "lineitem"), ["l_partkey", "l_suppkey", "l_orderkey"],
                              keys=["l_returnflag"])


@register("D6_conditional_counts", oracle="""
SELECT l_shipmode_year,
       SUM(CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END)::BIGINT AS discounted,
       SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::BIGINT AS returned,
       SUM(CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END)::BIGINT AS bulk,
       COUNT(*) AS total_rows
FROM (SELECT *, year(l_shipdate) AS l_shipmode_year FROM lineitem) GROUP BY l_shipmode_year
""")
def d6(spark, d):
    li = t(spark, d, "lineitem").withColumn("l_shipmode_year", F.year("l_shipdate"))
    return AG.conditional_counts(li, {"discounted": F.col("l_discount") >= 0.05,
                                      "returned": F.col("l_returnflag") == "R",
                                      "bulk": F.col("l_quantity") > 40},
                                 keys=["l_shipmode_year"]).withColumn(
        "l_shipmode_year", F.col("l_shipmode_year").cast("bigint"))


@register("D7_top_key_counts", oracle="""
SELECT l_suppkey, COUNT(*) AS cnt FROM lineitem GROUP BY l_suppkey
ORDER BY cnt DESC, l_suppkey LIMIT 10
""")
def d7(spark, d):
    return AG.top_key_counts(t(spark, d, "lineitem"), "l_suppkey", 10)


@register("D8_dedup_keys", oracle="""
SELECT DISTINCT o_custkey, o_orderstatus FROM orders
""")
def d8(spark, d):
    return AG.dedup(t(spark, d, "orders").select("o_custkey", "o_orderstatus"))


@register("D8b_drop_duplicates_on_key", oracle="""
SELECT DISTINCT l_orderkey FROM lineitem
""")
def d8b(spark, d):
    return AG.dedup(t(spark, d, "lineitem"), keys=["l_orderkey"]).select("l_orderkey")


@register("D9_static_pivot", oracle="""
SELECT l_returnflag,
       SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS "F",
       SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS "O"
FROM lineitem GROUP BY l_returnflag
""")
def d9(spark, d):
    return AG.pivot(t(spark, d, "lineitem"), "l_returnflag", "l_linestatus",
                    [F.sum("l_quantity")], values=["F", "O"])


@register("D10_pivot_multi_aggregate", oracle="""
SELECT l_returnflag,
       SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS F_qty,
       COUNT(CASE WHEN l_linestatus = 'F' THEN 1 END) AS F_n,
       SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS O_qty,
       COUNT(CASE WHEN l_linestatus = 'O' THEN 1 END) AS O_n
FROM lineitem GROUP BY l_returnflag
""")
def d10(spark, d):
    return AG.pivot(t(spark, d, "lineitem"), "l_returnflag", "l_linestatus",
                    [F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n")], values=["F", "O"])


@register("D11_dynamic_pivot", oracle="""
SELECT o_orderpriority, NULLIF(COUNT(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS "F",
       NULLIF(COUNT(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS "O", NULLIF(COUNT(*) FILTER (WHERE o_orderstatus = 'P'), 0) AS "P"
FROM orders GROUP BY o_orderpriority
""")
def d11(spark, d):
    return AG.pivot(t(spark, d, "orders"), "o_orderpriority", "o_orderstatus", [F.count(F.lit(1))])


@register("D12_percentile_cont", oracle="""
SELECT o_orderpriority,
       CAST(CAST(quantile_cont(o_totalprice, 0.5) AS DECIMAL(18,4)) AS DOUBLE) AS median_price,
       CAST(CAST(quantile_cont(o_totalprice, 0.9) AS DECIMAL(18,4)) AS DOUBLE) AS p90_price
FROM orders GROUP BY o_orderpriority
""")
def d12(spark, d):
    # 5 priorities: the percentile aggregate would hold a fifth of all prices
    # per task; the chunked exact percentile keeps every task bounded.
    from tidepool.operators.skew import percentiles_cont
    o = t(spark, d, "orders").select("o_orderpriority", money("o_totalprice").alias("price"))
    pc = percentiles_cont(o, ["o_orderpriority"], "price", {"_p50": 0.5, "_p90": 0.9})
    # interpolated values of 2-decimal prices have at most 4 decimals:
    # rounding there removes float noise of the interpolation
    return pc.select("o_orderpriority", dbl(F.col("_p50").cast("decimal(18,4)")).alias("median_price"),
                     dbl(F.col("_p90").cast("decimal(18,4)")).alias("p90_price"))


@register("D12b_percentile_aggregate", oracle="""
SELECT o_orderpriority,
       CAST(CAST(quantile_cont(o_totalprice, 0.5) AS DECIMAL(18,4)) AS DOUBLE) AS median_price,
       CAST(CAST(quantile_cont(o_totalprice, 0.9) AS DECIMAL(18,4)) AS DOUBLE) AS p90_price
FROM orders GROUP BY o_orderpriority
""")
def d12b(spark, d):
    # the same percentiles over the raw DOUBLE prices (D12 ranks exact
    # decimals); also chunked -- the one-buffer-per-group ``percentile``
    # aggregate would hold a fifth of all prices in one task
    from tidepool.operators.skew import percentiles_cont
    o = t(spark, d, "orders").select("o_orderpriority", "o_totalprice")
    pc = percentiles_cont(o, ["o_orderpriority"], "o_totalprice", {"_p50": 0.5, "_p90": 0.9})
    return pc.select("o_orderpriority", dbl(F.col("_p50").cast("decimal(18,4)")).alias("median_price"),
                     dbl(F.col("_p90").cast("decimal(18,4)")).alias("p90_price"))


@register("D13_explode_reaggregate", oracle="""
SELECT l_partkey AS partkey, SUM(l_quantity) AS qty, COUNT(DISTINCT l_orderkey) AS n_orders
FROM lineitem GROUP BY l_partkey
""")
def d13(spark, d):
    from tidepool.functions.nested import order_items
    nested = order_items(t(spark, d, "lineitem"))
    flat = nested.select("l_orderkey", F.explode("items").alias("it"))
    return flat.groupBy(F.col("it.partkey").alias("partkey")).agg(
        F.sum("it.qty").alias("qty"), F.count_distinct("l_orderkey").alias("n_orders"))


@register("D14_aggregate_then_rank", oracle="""
SELECT n.n_name, CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       DENSE_RANK() OVER (ORDER BY SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) DESC) AS revenue_rank
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name
""")
def d14(spark, d):
    o = t(spark, d, "orders")
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = t(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    per_nation = (join_dim(o.join(c, "o_custkey"), n, "c_nationkey").groupBy("n_name")
                  .agg(F.sum(money("o_totalprice")).alias("_rev")))
    # one row per nation: a global window over 25 rows is fine
    w = Window.orderBy(F.col("_rev").desc())
    return per_nation.select("n_name", dbl("_rev").alias("revenue"),
                             F.dense_rank().over(w).cast("bigint").alias("revenue_rank"))


@register("D4d_distinct_and_median_from_kept_days", oracle="""
SELECT COUNT(*) AS n, true AS users_within, true AS both_within, true AS median_within FROM events
""")
def d4d(spark, d):
    """Sketches kept by day: half of the days first, then the others, then one
    of them again; the estimates as whether they lie within four standard
    errors of the exact answers."""
    from tidepool.operators import sketches as SK
    from tidepool.session import scratch_path
    from tidepool.sources.partitions import PartitionStore
    ev = t(spark, d, "events").select(F.to_date("ts").alias("day"), "user_id", "value")
    store = PartitionStore(spark, scratch_path(spark, "d4d-days"), "day")
    first = F.dayofmonth("day") <= 15
    for days in (first, ~first, F.dayofmonth("day") == 20):
        SK.keep_days(store, ev.where(days), ["user_id"], ["value"])
    states = store.read()
    est = (SK.distinct_over(states, "user_id").join(SK.overlap(states, "user_id", first, ~first))
           .join(SK.quantiles_over(states, "value", {"median": 0.5})))            # a row each
    per_user = ev.groupBy("user_id").agg(F.max(first).alias("a"), F.max(~first).alias("b")).where("user_id IS NOT NULL")
    exact = per_user.agg(F.count(F.lit(1)).alias("users"), F.count_if(F.col("a") & F.col("b")).alias("both"))
    below = (F.col("value") <= F.col("median")).cast("int")
    rank = ev.where("value IS NOT NULL").join(est.select("median")).agg((F.sum(below) / F.count(F.lit(1))).alias("rank"))
    close = lambda got, want: F.abs(F.col(got) - F.col(want)) <= 4 * 0.0163 * F.col("users")
    return est.join(exact).join(rank).select("n", close("n_distinct", "users").alias("users_within"), close("in_both", "both").alias("both_within"),
                                             (F.abs(F.col("rank") - 0.5) <= 4 * 0.0133).alias("median_within"))
