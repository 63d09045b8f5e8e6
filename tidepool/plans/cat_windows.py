"""Registered queries: window functions.

Orders are windowed per customer in (order date, order key) order, which is
total, so ROW_NUMBER / LAG / LEAD results are fully determined.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators import range_frames as RF
from tidepool.operators import skew as SK
from tidepool.operators import windows as W
from tidepool.plans.common import dbl, money, t
from tidepool.plans.registry import register
from tidepool.sources.io import register_views

CUST_W_SQL = "PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey"


def _orders(spark, d):
    return t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
                                        "o_orderpriority")


def _cust_w():
    return W.spec("o_custkey", ["o_orderdate", "o_orderkey"])


@register("E1_row_number", oracle=f"""
SELECT o_orderkey, o_custkey, ROW_NUMBER() OVER ({CUST_W_SQL}) AS order_seq FROM orders
""")
def e1(spark, d):
    return _orders(spark, d).select("o_orderkey", "o_custkey",
                                    F.row_number().over(_cust_w()).cast("bigint").alias("order_seq"))


@register("E2_rank", oracle="""
SELECT c_custkey, c_nationkey, RANK() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS balance_rank
FROM customer
""")
def e2(spark, d):
    # 25 nations = 25 window tasks at any scale: rank in chunks instead
    c = t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    r = SK.ranked(c, ["c_nationkey"], [F.col("c_acctbal").desc()])
    return r.select("c_custkey", "c_nationkey", F.col("rank").cast("bigint").alias("balance_rank"))


@register("E3_dense_rank", oracle="""
SELECT o_orderkey, DENSE_RANK() OVER (PARTITION BY o_orderpriority ORDER BY CAST(o_orderdate AS DATE)) AS day_rank
FROM orders
""")
def e3(spark, d):
    # 5 priorities would mean 5 window tasks: dense_rank in chunks instead
    o = t(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"))
    r = SK.ranked(o, ["o_orderpriority"], ["day"])
    return r.select("o_orderkey", F.col("dense_rank").cast("bigint").alias("day_rank"))


@register("E4_ntile", oracle="""
SELECT c_custkey, c_mktsegment, NTILE(4) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS quartile
FROM customer
""")
def e4(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    r = SK.ranked(c, ["c_mktsegment"], ["c_acctbal", "c_custkey"], n_tiles=4)
    return r.select("c_custkey", "c_mktsegment", F.col("ntile").cast("bigint").alias("quartile"))


@register("E5_lag_offset_default", oracle=f"""
SELECT o_orderkey, LAG(o_totalprice, 2, 0) OVER ({CUST_W_SQL}) AS price_2_before FROM orders
""")
def e5(spark, d):
    return _orders(spark, d).select("o_orderkey",
                                    F.lag("o_totalprice", 2, 0.0).over(_cust_w()).alias("price_2_before"))


@register("E6_lead_offset_default", oracle=f"""
SELECT o_orderkey, LEAD(o_totalprice, 1, -1) OVER ({CUST_W_SQL}) AS next_price FROM orders
""")
def e6(spark, d):
    return _orders(spark, d).select("o_orderkey",
                                    F.lead("o_totalprice", 1, -1.0).over(_cust_w()).alias("next_price"))


@register("E7_first_value", oracle=f"""
SELECT o_orderkey, FIRST_VALUE(o_orderkey) OVER ({CUST_W_SQL}) AS first_order FROM orders
""")
def e7(spark, d):
    # aggregates joined back, not a sort of each customer: a hot customer is combined before the shuffle
    return SK.first_last(_orders(spark, d), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey",
                         first_out="first_order").select("o_orderkey", "first_order")


@register("E8_last_value_full_frame", oracle=f"""
SELECT o_orderkey, LAST_VALUE(o_orderkey) OVER ({CUST_W_SQL}
       ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_order FROM orders
""")
def e8(spark, d):
    return SK.first_last(_orders(spark, d), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey",
                         last_out="last_order").select("o_orderkey", "last_order")


@register("E9_running_sum_count_avg", oracle=f"""
SELECT o_orderkey,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER ({CUST_W_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_sum,
  COUNT(*) OVER ({CUST_W_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER ({CUST_W_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
    / COUNT(*) OVER ({CUST_W_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_avg
FROM orders
""")
def e9(spark, d):
    w = _cust_w().rowsBetween(W.UNBOUNDED_PRECEDING, W.CURRENT_ROW)
    s = dbl(F.sum(money("o_totalprice")).over(w))
    n = F.count(F.lit(1)).over(w)
    return _orders(spark, d).select("o_orderkey", s.alias("running_sum"), n.alias("running_count"),
                                    (s / n).alias("running_avg"))


@register("E10_rolling_7_rows", oracle=f"""
SELECT o_orderkey,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER ({CUST_W_SQL} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE)
    / COUNT(*) OVER ({CUST_W_SQL} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS avg_last_7_orders
FROM orders
""")
def e10(spark, d):
    w = _cust_w().rowsBetween(-6, 0)
    return _orders(spark, d).select(
        "o_orderkey", (dbl(F.sum(money("o_totalprice")).over(w)) / F.count(F.lit(1)).over(w))
        .alias("avg_last_7_orders"))


@register("E11_centred_frame", oracle=f"""
SELECT o_orderkey,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER ({CUST_W_SQL} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS DOUBLE) AS centred_sum
FROM orders
""")
def e11(spark, d):
    w = _cust_w().rowsBetween(-2, 2)
    return _orders(spark, d).select("o_orderkey", dbl(F.sum(money("o_totalprice")).over(w)).alias("centred_sum"))


@register("E12_range_7_days", oracle="""
WITH daily AS (
  SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS rev
  FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, day, CAST(rev AS DOUBLE) AS revenue,
  CAST(SUM(rev) OVER (PARTITION BY o_orderpriority ORDER BY day
       RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS DOUBLE) AS revenue_7d
FROM daily
""")
def e12(spark, d):
    daily = (t(spark, d, "orders").groupBy("o_orderpriority", F.to_date("o_orderdate").alias("day"))
             .agg(F.sum(money("o_totalprice")).alias("rev")))
    out = W.rolling_days(daily, "rev", "o_orderpriority", "day", 7, out="_r7")
    return out.select("o_orderpriority", "day", dbl("rev").alias("revenue"), dbl("_r7").alias("revenue_7d"))


@register("E12s_range_days_of_orders_split", oracle="""
WITH o AS (
  SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS amt
  FROM orders)
SELECT o_orderkey,
  CAST(SUM(amt) OVER back AS DOUBLE) AS revenue_7d, COUNT(*) OVER back AS orders_7d,
  CAST(SUM(amt) OVER around AS DOUBLE) AS revenue_around, COUNT(*) OVER around AS orders_around
FROM o
WINDOW back AS (PARTITION BY o_orderpriority ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW),
       around AS (PARTITION BY o_orderpriority ORDER BY day RANGE BETWEEN INTERVAL 3 DAYS PRECEDING AND INTERVAL 3 DAYS FOLLOWING)
""")
def e12s(spark, d):
    # five priorities hold all orders: frames as differences of running sums over chunks
    o = t(spark, d, "orders").select("o_orderkey", "o_orderpriority", money("o_totalprice").alias("amt"),
                                     F.unix_date(F.to_date("o_orderdate")).alias("day"))
    back = RF.range_sums(o, "o_orderpriority", "day", 6, 0, {"_back": "amt"}, rows_out="orders_7d")
    both = RF.range_sums(back, "o_orderpriority", "day", 3, 3, {"_around": "amt"}, rows_out="orders_around")
    return both.select("o_orderkey", dbl("_back").alias("revenue_7d"), "orders_7d",
                       dbl("_around").alias("revenue_around"), "orders_around")


@register("E12h_range_hours_of_events_split", oracle="""
SELECT event_id, COUNT(*) OVER w AS events_1h, COUNT(CAST(value AS DECIMAL(18,2))) OVER w AS valued_1h,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS value_1h
FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)
""")
def e12h(spark, d):
    # positions in microseconds: nearly every event has its own
    ev = t(spark, d, "events").select("event_id", "event_type", money("value").alias("amt"),
                                      F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    out = RF.range_sums(ev, "event_type", "us", 3_600_000_000, 0, {"_sum": "amt"}, rows_out="events_1h",
                        counts={"valued_1h": "amt"})
    return out.select("event_id", "events_1h", "valued_1h", dbl("_sum").alias("value_1h"))


@register("E13_keep_latest_per_key", oracle="""
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def e13(spark, d):
    latest = W.keep_latest(_orders(spark, d), "o_custkey", ["o_orderdate", "o_orderkey"])
    return latest.select("o_custkey", "o_orderkey", "o_totalprice")


@register("E14_percent_of_partition", oracle="""
WITH nr AS (
  SELECT n.n_regionkey, n.n_name, SUM(CAST(c.c_acctbal AS DECIMAL(18,2))) AS bal
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2)
SELECT n_regionkey, n_name, CAST(bal AS DOUBLE) AS balance,
       CAST(bal AS DOUBLE) / CAST(SUM(bal) OVER (PARTITION BY n_regionkey) AS DOUBLE) * 100 AS pct_of_region
FROM nr
""")
def e14(spark, d):
    c = t(spark, d, "customer")
    from tidepool.operators.joins import maybe_broadcast
    n = maybe_broadcast(t(spark, d, "nation"))
    nr = (c.join(n, c.c_nationkey == n.n_nationkey).groupBy("n_regionkey", "n_name")
          .agg(F.sum(money("c_acctbal")).alias("bal")))
    w = W.spec("n_regionkey")
    return nr.select("n_regionkey", "n_name", dbl("bal").alias("balance"),
                     (dbl("bal") / dbl(F.sum("bal").over(w)) * 100).alias("pct_of_region"))


NAMED_SQL = f"""
SELECT o_orderkey,
       ROW_NUMBER() OVER w AS seq,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS cum_spend,
       LAG(o_orderkey) OVER w AS prev_order
FROM orders WINDOW w AS ({CUST_W_SQL})
"""
EXTENDED_SQL = """
SELECT o_orderkey,
       COUNT(*) OVER (PARTITION BY o_custkey) AS cust_orders,
       ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS price_rank
FROM orders
"""


@register("E15_named_window_sql", oracle=NAMED_SQL)
def e15(spark, d):
    register_views(spark, d, ["orders"])
    return spark.sql(f"""
        SELECT o_orderkey, CAST(ROW_NUMBER() OVER w AS BIGINT) AS seq,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS cum_spend,
               LAG(o_orderkey) OVER w AS prev_order
        FROM orders WINDOW w AS ({CUST_W_SQL})""")


@register("E16_named_window_extended", oracle=EXTENDED_SQL)
def e16(spark, d):
    base = W.spec("o_custkey")                                   # WINDOW base AS (PARTITION BY ...)
    by_price = base.orderBy(F.col("o_totalprice").desc(), "o_orderkey")   # OVER (base ORDER BY ...)
    return _orders(spark, d).select("o_orderkey", F.count(F.lit(1)).over(base).alias("cust_orders"),
                                    F.row_number().over(by_price).cast("bigint").alias("price_rank"))


@register("E15s_named_window_split", oracle=NAMED_SQL)
def e15s(spark, d):
    # the window's three uses in chunks: a running sum with its count, then a halo of one row
    order = ["o_orderdate", "o_orderkey"]
    o = _orders(spark, d).withColumn("amt", money("o_totalprice"))
    r = SK.running_sum(o, ["o_custkey"], order, "amt", out="_s", count_out="_n")
    r = SK.bounded_frame(r, ["o_custkey"], order, 1, 0, lambda w: {"prev_order": F.lag("o_orderkey").over(w)})
    return r.select("o_orderkey", F.col("_n").cast("bigint").alias("seq"), dbl("_s").alias("cum_spend"), "prev_order")


@register("E16s_named_window_extended_split", oracle=EXTENDED_SQL)
def e16s(spark, d):
    # whole-partition count as an aggregate joined back, ranks in chunks
    o = _orders(spark, d).select("o_orderkey", "o_custkey", "o_totalprice")
    r = SK.ranked(o, ["o_custkey"], [F.col("o_totalprice").desc(), "o_orderkey"])
    sizes = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("cust_orders"))
    return SK.null_safe_join(r, sizes, ["o_custkey"]).select("o_orderkey", "cust_orders", F.col("row_number").alias("price_rank"))


@register("E17_running_total_reset_monthly", oracle="""
SELECT o_orderkey,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (
       PARTITION BY o_orderpriority, date_trunc('month', o_orderdate)
       ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS month_to_date
FROM orders
""")
def e17(spark, d):
    # (priority, month) groups hold a month of orders each: chunk them
    o = _orders(spark, d).withColumn("month", F.trunc(F.to_date("o_orderdate"), "month")) \
        .withColumn("amt", money("o_totalprice"))
    r = SK.running_sum(o, ["o_orderpriority", "month"], ["o_orderdate", "o_orderkey"], "amt", out="_s")
    return r.select("o_orderkey", dbl("_s").alias("month_to_date"))


@register("E18_last_value_before_row", oracle="""
SELECT event_id,
  LAST_VALUE(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (
     PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_purchase_value
FROM events
""")
def e18(spark, d):
    ev = t(spark, d, "events").withColumn(
        "pv", F.when(F.col("event_type") == "purchase", F.col("value")))
    out = W.with_last_before(ev, "pv", "user_id", ["ts", "event_id"], out="last_purchase_value")
    return out.select("event_id", "last_purchase_value")


@register("E19_sessionize_30min", oracle="""
WITH g AS (
  SELECT event_id, user_id, ts,
         CASE WHEN LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                OR epoch_us(ts) - epoch_us(LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 1800000000
              THEN 1 ELSE 0 END AS new_session
  FROM events)
SELECT event_id, user_id,
       SUM(new_session) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS session_id
FROM g
""")
def e19(spark, d):
    ev = t(spark, d, "events").select("event_id", "user_id", "ts")
    out = W.sessionize(ev, "user_id", "ts", 30 * 60)
    return out.select("event_id", "user_id", F.col("session_id").cast("bigint").alias("session_id"))


@register("E20_top3_per_group_ties", oracle="""
WITH pr AS (
  SELECT p.p_type, l.l_partkey, SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS rev
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2)
SELECT p_type, l_partkey, CAST(rev AS DOUBLE) AS revenue,
       RANK() OVER (PARTITION BY p_type ORDER BY rev DESC) AS rnk
FROM pr QUALIFY rnk <= 3
""")
def e20(spark, d):
    li = t(spark, d, "lineitem")
    p = t(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    pr = li.join(p, "l_partkey").groupBy("p_type", "l_partkey").agg(F.sum(money("l_extendedprice")).alias("rev"))
    top = W.top_n_per_group(pr, "p_type", F.col("rev").desc(), 3)
    return top.select("p_type", "l_partkey", dbl("rev").alias("revenue"), F.col("rnk").cast("bigint").alias("rnk"))


# Skew-safe variants of the per-customer / per-user windows (same oracles).
@register("E1s_row_number_skew_safe", oracle=f"""
SELECT o_orderkey, o_custkey, ROW_NUMBER() OVER ({CUST_W_SQL}) AS order_seq FROM orders
""")
def e1s(spark, d):
    r = SK.ranked(_orders(spark, d), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return r.select("o_orderkey", "o_custkey", F.col("row_number").cast("bigint").alias("order_seq"))


@register("E9s_running_sum_skew_safe", oracle=f"""
SELECT o_orderkey,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER ({CUST_W_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_sum,
  COUNT(*) OVER ({CUST_W_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count
FROM orders
""")
def e9s(spark, d):
    o = _orders(spark, d).withColumn("amt", money("o_totalprice"))
    r = SK.running_sum(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "amt", out="_s", count_out="running_count")
    return r.select("o_orderkey", dbl("_s").alias("running_sum"), "running_count")


@register("E9g_global_running_sum_skew_safe", oracle="""
SELECT o_orderkey,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (ORDER BY o_orderdate, o_orderkey
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_revenue
FROM orders
""")
def e9g(spark, d):
    # no partition at all: the plain window would run in ONE task
    o = _orders(spark, d).withColumn("amt", money("o_totalprice"))
    r = SK.running_sum(o, [], ["o_orderdate", "o_orderkey"], "amt", out="_s")
    return r.select("o_orderkey", dbl("_s").alias("cumulative_revenue"))


@register("E19s_sessionize_skew_safe", oracle="""
WITH g AS (
  SELECT event_id, user_id, ts,
         CASE WHEN LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                OR epoch_us(ts) - epoch_us(LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 1800000000
              THEN 1 ELSE 0 END AS new_session
  FROM events)
SELECT event_id, user_id,
       SUM(new_session) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS session_id
FROM g
""")
def e19s(spark, d):
    ev = t(spark, d, "events").select("event_id", "user_id", "ts")
    out = SK.sessionize(ev, "user_id", "ts", 30 * 60, tie_cols=["event_id"])
    return out.select("event_id", "user_id", "session_id")


def _bounded(spark, d, before, after, build):
    return SK.bounded_frame(_orders(spark, d).withColumn("amt", money("o_totalprice")), ["o_custkey"],
                            ["o_orderdate", "o_orderkey"], before, after, build)


@register("E5s_lag_skew_safe", oracle=f"""
SELECT o_orderkey, LAG(o_totalprice, 2, 0) OVER ({CUST_W_SQL}) AS price_2_before FROM orders
""")
def e5s(spark, d):
    out = _bounded(spark, d, 2, 0, lambda w: {"price_2_before": F.lag("o_totalprice", 2, 0.0).over(w)})
    return out.select("o_orderkey", "price_2_before")


@register("E6s_lead_skew_safe", oracle=f"""
SELECT o_orderkey, LEAD(o_totalprice, 1, -1) OVER ({CUST_W_SQL}) AS next_price FROM orders
""")
def e6s(spark, d):
    out = _bounded(spark, d, 0, 1, lambda w: {"next_price": F.lead("o_totalprice", 1, -1.0).over(w)})
    return out.select("o_orderkey", "next_price")


@register("E10s_rolling_7_rows_skew_safe", oracle=f"""
SELECT o_orderkey,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER ({CUST_W_SQL} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE)
    / COUNT(*) OVER ({CUST_W_SQL} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS avg_last_7_orders
FROM orders
""")
def e10s(spark, d):
    def build(w):
        f = w.rowsBetween(-6, 0)
        return {"avg_last_7_orders": dbl(F.sum("amt").over(f)) / F.count(F.lit(1)).over(f)}
    return _bounded(spark, d, 6, 0, build).select("o_orderkey", "avg_last_7_orders")


@register("E11s_centred_frame_skew_safe", oracle=f"""
SELECT o_orderkey,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER ({CUST_W_SQL} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS DOUBLE) AS centred_sum
FROM orders
""")
def e11s(spark, d):
    out = _bounded(spark, d, 2, 2, lambda w: {"centred_sum": dbl(F.sum("amt").over(w.rowsBetween(-2, 2)))})
    return out.select("o_orderkey", "centred_sum")


@register("E7s_first_value_by_aggregate", oracle=f"""
SELECT o_orderkey, FIRST_VALUE(o_orderkey) OVER ({CUST_W_SQL}) AS first_order,
       LAST_VALUE(o_orderkey) OVER ({CUST_W_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_order
FROM orders
""")
def e7s(spark, d):
    out = SK.first_last(_orders(spark, d), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey",
                        "first_order", "last_order")
    return out.select("o_orderkey", "first_order", "last_order")


@register("E18s_last_value_before_row_skew_safe", oracle="""
SELECT event_id,
  LAST_VALUE(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (
     PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_purchase_value
FROM events
""")
def e18s(spark, d):
    ev = t(spark, d, "events").withColumn("pv", F.when(F.col("event_type") == "purchase", F.col("value")))
    out = SK.last_before(ev, ["user_id"], ["ts", "event_id"], "pv", "last_purchase_value")
    return out.select("event_id", "last_purchase_value")


# The same windows over NULL keys and values: every 10th customer or user has no key, every 7th row no value.
ORDERS_N_SQL = """(SELECT o_orderkey, o_orderdate, CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS k,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS v FROM orders)"""
EVENTS_N_SQL = """(SELECT event_id, ts, CASE WHEN user_id % 10 <> 0 THEN user_id END AS k,
  CASE WHEN event_type = 'purchase' THEN value END AS v FROM events)"""


def _orders_n(spark, d):
    return t(spark, d, "orders").select(
        "o_orderkey", "o_orderdate", F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("k"),
        F.when(F.col("o_orderkey") % 7 != 0, money("o_totalprice")).alias("v"))


def _events_n(spark, d):
    return t(spark, d, "events").select(
        "event_id", "ts", F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("k"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("v"))


@register("E2n_ranks_null_keys_skew_safe", oracle=f"""
SELECT o_orderkey, RANK() OVER (PARTITION BY k ORDER BY CAST(o_orderdate AS DATE)) AS rnk,
       ROW_NUMBER() OVER (PARTITION BY k ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS seq
FROM {ORDERS_N_SQL} o
""")
def e2n(spark, d):
    o = _orders_n(spark, d).withColumn("day", F.to_date("o_orderdate"))
    ranks = SK.ranked(o, ["k"], ["day"]).select("o_orderkey", F.col("rank").cast("bigint").alias("rnk"))
    seq = SK.ranked(o, ["k"], ["day", "o_orderkey"]).select("o_orderkey", F.col("row_number").cast("bigint").alias("seq"))
    return ranks.join(seq, "o_orderkey")


@register("E9n_running_sum_nulls_skew_safe", oracle=f"""
SELECT o_orderkey, CAST(SUM(v) OVER w AS DOUBLE) AS running_sum, COUNT(*) OVER w AS running_count
FROM {ORDERS_N_SQL} o WINDOW w AS (PARTITION BY k ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def e9n(spark, d):
    r = SK.running_sum(_orders_n(spark, d), ["k"], ["o_orderdate", "o_orderkey"], "v", out="_s", count_out="running_count")
    return r.select("o_orderkey", dbl("_s").alias("running_sum"), "running_count")


@register("E10n_rolling_7_rows_nulls_skew_safe", oracle=f"""
SELECT o_orderkey, CAST(SUM(v) OVER w AS DOUBLE) AS sum_7, COUNT(v) OVER w AS n_7, LAG(v, 2) OVER (PARTITION BY k ORDER BY o_orderdate, o_orderkey)::DOUBLE AS lag_2
FROM {ORDERS_N_SQL} o WINDOW w AS (PARTITION BY k ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
""")
def e10n(spark, d):
    def build(w):
        f = w.rowsBetween(-6, 0)
        return {"sum_7": dbl(F.sum("v").over(f)), "n_7": F.count("v").over(f), "lag_2": dbl(F.lag("v", 2).over(w))}
    r = SK.bounded_frame(_orders_n(spark, d), ["k"], ["o_orderdate", "o_orderkey"], 6, 0, build)
    return r.select("o_orderkey", "sum_7", "n_7", "lag_2")


@register("E18n_last_value_before_row_null_keys_skew_safe", oracle=f"""
SELECT event_id, LAST_VALUE(v IGNORE NULLS) OVER (PARTITION BY k ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_value
FROM {EVENTS_N_SQL} e
""")
def e18n(spark, d):
    return SK.last_before(_events_n(spark, d), ["k"], ["ts", "event_id"], "v", "last_value").select("event_id", "last_value")


@register("E19n_sessionize_null_keys_skew_safe", oracle=f"""
WITH g AS (
  SELECT event_id, k, ts, LAG(ts) OVER (PARTITION BY k ORDER BY ts, event_id) AS p FROM {EVENTS_N_SQL} e)
SELECT event_id, SUM(CASE WHEN p IS NULL OR epoch_us(ts) - epoch_us(p) > 1800000000 THEN 1 ELSE 0 END) OVER (
       PARTITION BY k ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS session_id
FROM g
""")
def e19n(spark, d):
    return SK.sessionize(_events_n(spark, d), "k", "ts", 30 * 60, tie_cols=["event_id"]).select("event_id", "session_id")


@register("D12n_percentiles_nulls_skew_safe", oracle=f"""
SELECT k % 3 AS g, CAST(CAST(quantile_cont(v, 0.5) AS DECIMAL(18,4)) AS DOUBLE) AS median_v
FROM {ORDERS_N_SQL} o GROUP BY 1
""")
def d12n(spark, d):
    o = _orders_n(spark, d).select((F.col("k") % 3).alias("g"), "v")
    return SK.percentile_cont(o, ["g"], "v", 0.5, out="_m").select("g", dbl(F.col("_m").cast("decimal(18,4)")).alias("median_v"))
