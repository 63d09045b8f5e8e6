"""Registered queries: scans (A), query shape (B), sort / limit (F), set
operations (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators import aggregates as AG
from tidepool.operators import shape as S
from tidepool.operators import windows as W
from tidepool.operators.joins import join_dim
from tidepool.plans.common import dbl, money, t
from tidepool.plans.registry import register
from tidepool.sources.io import range_between, register_views


# A1 ----------------------------------------------------------------------------------------
@register("A1_parquet_scan_pruned", oracle="""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 45
""")
def a1(spark, d):
    # two columns + one filter: ReadSchema has 3 fields, PushedFilters has the bound
    return (t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
            .filter(F.col("l_quantity") >= 45))


# A6 ----------------------------------------------------------------------------------------
@register("A6_temp_view_sql", oracle="""
SELECT n.n_name AS nation, COUNT(*) AS customers,
       CAST(SUM(CAST(c.c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total_balance
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name HAVING COUNT(*) > 10
""")
def a6(spark, d):
    register_views(spark, d, ["customer", "nation"])
    agg = spark.sql("""
        SELECT n.n_name AS nation, COUNT(*) AS customers,
               SUM(CAST(c.c_acctbal AS DECIMAL(18,2))) AS bal
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
        GROUP BY n.n_name""")
    # back to the DataFrame API on the SQL result
    return agg.filter(F.col("customers") > 10).select("nation", "customers",
                                                      dbl("bal").alias("total_balance"))


# A13 ---------------------------------------------------------------------------------------
@register("A13_range_day_spine", oracle="""
WITH b AS (SELECT MIN(CAST(o_orderdate AS DATE)) lo, MAX(CAST(o_orderdate AS DATE)) hi FROM orders),
spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b),
daily AS (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT spine.day, COALESCE(daily.n, 0) AS orders FROM spine LEFT JOIN daily ON spine.day = daily.day
""")
def a13(spark, d):
    o = t(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"))
    epoch = F.lit("1970-01-01").cast("date")
    bounds = o.agg(F.datediff(F.min("day"), epoch), F.datediff(F.max("day"), epoch))
    spine = range_between(spark, bounds).select(F.date_add(epoch, F.col("id").cast("int")).alias("day"))
    daily = o.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return (spine.join(daily, "day", "left")
            .select("day", F.coalesce("n", F.lit(0)).cast("bigint").alias("orders")))


# B1 ---------------------------------------------------------------------------------------
@register("B1_project_derive_rename", oracle="""
SELECT l_orderkey, l_linenumber,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS net_price,
       CAST(l_shipdate AS DATE) AS ship_date, l_returnflag AS return_flag
FROM lineitem
""")
def b1(spark, d):
    li = t(spark, d, "lineitem")
    out = S.derive(li,
                   net_price=(money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("double"),
                   ship_date=F.to_date("l_shipdate"),
                   rename={"l_returnflag": "return_flag"})
    return out.select("l_orderkey", "l_linenumber", "net_price", "ship_date", "return_flag")


# B2 ---------------------------------------------------------------------------------------
@register("B2_boolean_filter", oracle="""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag FROM lineitem
WHERE l_quantity > 30 AND l_discount < 0.05 AND NOT (l_returnflag = 'R')
""")
def b2(spark, d):
    li = t(spark, d, "lineitem")
    return (li.filter((F.col("l_quantity") > 30) & (F.col("l_discount") < 0.05) & ~(F.col("l_returnflag") == "R"))
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag"))


# B3 ---------------------------------------------------------------------------------------
@register("B3_in_list", oracle="""
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'P')
""")
def b3(spark, d):
    o = t(spark, d, "orders")
    return (o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_orderstatus").isin("F", "P"))
            .select("o_orderkey", "o_orderpriority", "o_orderstatus"))


# B4 ---------------------------------------------------------------------------------------
@register("B4_between", oracle="""
SELECT p_partkey, p_size, p_retailprice FROM part
WHERE p_size BETWEEN 10 AND 20 AND p_retailprice BETWEEN 920.5 AND 960
""")
def b4(spark, d):
    p = t(spark, d, "part")
    return (p.filter(F.col("p_size").between(10, 20) & F.col("p_retailprice").between(920.5, 960))
            .select("p_partkey", "p_size", "p_retailprice"))


# B5 ---------------------------------------------------------------------------------------
@register("B5_null_predicates", oracle="""
WITH x AS (
  SELECT o.o_orderkey, li.n_lines FROM orders o
  LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n_lines FROM lineitem GROUP BY l_orderkey) li
    ON o.o_orderkey = li.l_orderkey)
SELECT SUM(CASE WHEN n_lines IS NULL THEN 1 ELSE 0 END)::BIGINT AS orders_without_lines,
       SUM(CASE WHEN n_lines IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS orders_with_lines
FROM x
""")
def b5(spark, d):
    o = t(spark, d, "orders").select("o_orderkey")
    lines = (t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
             .withColumnRenamed("l_orderkey", "o_orderkey"))
    x = o.join(lines, "o_orderkey", "left")
    return AG.conditional_counts(x, {"orders_without_lines": F.col("n_lines").isNull(),
                                     "orders_with_lines": F.col("n_lines").isNotNull()}).drop("total_rows")


# B6 ---------------------------------------------------------------------------------------
@register("B6_case_segments", oracle="""
SELECT CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 3000 THEN 'low'
            WHEN c_acctbal < 7000 THEN 'mid' ELSE 'high' END AS balance_segment,
       COUNT(*) AS customers
FROM customer GROUP BY 1
""")
def b6(spark, d):
    c = t(spark, d, "customer")
    seg = S.segment(F.col("c_acctbal"), [(0, "negative"), (3000, "low"), (7000, "mid")], "high")
    return c.groupBy(seg.alias("balance_segment")).agg(F.count(F.lit(1)).alias("customers"))


# B7 ---------------------------------------------------------------------------------------
@register("B7_having", oracle="""
SELECT o_custkey, COUNT(*) AS n_orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders GROUP BY o_custkey HAVING COUNT(*) >= 15
""")
def b7(spark, d):
    o = t(spark, d, "orders")
    return S.group_having(o, "o_custkey",
                          [F.count(F.lit(1)).alias("n_orders"),
                           dbl(F.sum(money("o_totalprice"))).alias("revenue")],
                          F.col("n_orders") >= 15)


# B8 ---------------------------------------------------------------------------------------
@register("B8_qualify_first_order_kept_if_large", oracle="""
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS first_order_date, o_totalprice
FROM orders
QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
        AND o_totalprice >= 100000
""")
def b8(spark, d):
    # filter AFTER the window: the first purchase, dropped when under 100k
    o = t(spark, d, "orders")
    w = W.spec("o_custkey", ["o_orderdate", "o_orderkey"])
    first = W.qualify(o, "_rn", F.row_number().over(w), F.col("_rn") == 1)
    return (first.filter(F.col("o_totalprice") >= 100000)
            .select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("first_order_date"),
                    "o_totalprice"))


# B9 ---------------------------------------------------------------------------------------
@register("B9_cte_chain", oracle="""
WITH cust_rev AS (
  SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS rev FROM orders GROUP BY o_custkey),
nation_rev AS (
  SELECT c.c_nationkey, SUM(r.rev) AS nation_rev, COUNT(*) AS n_cust
  FROM cust_rev r JOIN customer c ON r.o_custkey = c.c_custkey GROUP BY c.c_nationkey)
SELECT n.n_name, nr.n_cust, CAST(nr.nation_rev AS DOUBLE) AS nation_revenue
FROM nation_rev nr JOIN nation n ON nr.c_nationkey = n.n_nationkey
""")
def b9(spark, d):
    cust_rev = t(spark, d, "orders").groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("rev"))
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation_rev = (cust_rev.join(c, "o_custkey").groupBy("c_nationkey")
                  .agg(F.sum("rev").alias("nation_rev"), F.count(F.lit(1)).alias("n_cust")))
    n = t(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return join_dim(nation_rev, n, "c_nationkey").select("n_name", "n_cust", dbl("nation_rev").alias("nation_revenue"))


# B10 --------------------------------------------------------------------------------------
@register("B10_param_query_allowlist", oracle="""
SELECT o_orderpriority, COUNT(*) AS n FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_totalprice > 200000 GROUP BY o_orderpriority
""")
def b10(spark, d):
    register_views(spark, d, ["orders"])
    return S.run_param(
        spark,
        "SELECT o_orderpriority, COUNT(*) AS n FROM IDENTIFIER(:table) "
        "WHERE o_orderdate >= CAST(:since AS TIMESTAMP_NTZ) AND o_totalprice > :min_price "
        "GROUP BY o_orderpriority",
        {"since": "1998-01-01", "min_price": 200000}, table="orders",
        allowed_tables=["orders", "lineitem"])


# B11 --------------------------------------------------------------------------------------
@register("B11_sargable_date_range", oracle="""
SELECT l_returnflag, COUNT(*) AS n_lines, SUM(l_quantity) AS qty FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'
GROUP BY l_returnflag
""")
def b11(spark, d):
    lo, hi = S.year_bounds(1996)
    li = S.date_range_filter(t(spark, d, "lineitem"), "l_shipdate", lo, hi)
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty"))


# B12 --------------------------------------------------------------------------------------
@register("B12_predicate_as_text", oracle="""
SELECT l_linestatus, COUNT(*) AS n FROM lineitem
WHERE l_quantity > 45 AND l_returnflag = 'R' GROUP BY l_linestatus
""")
def b12(spark, d):
    li = S.filter_expr(t(spark, d, "lineitem"), "l_quantity > 45 AND l_returnflag = 'R'")
    return li.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"))


# F1 ---------------------------------------------------------------------------------------
@register("B13_execute_immediate", oracle="""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'
""")
def b13(spark, d):
    from tidepool.operators.shape import execute_immediate
    register_views(spark, d, ["orders"])
    return execute_immediate(spark, "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > :least AND o_orderstatus = :status",
                             {"least": 100000, "status": "F"})


@register("F1_sort_mixed_directions", oracle="""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice FROM orders
ORDER BY order_date ASC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey
""")
def f1(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_date"), "o_totalprice")
    return S.sort_by(o, F.col("order_date").asc_nulls_last(), F.col("o_totalprice").desc_nulls_last(),
                     F.col("o_orderkey").asc())


# F2 ---------------------------------------------------------------------------------------
@register("F2_top_k_limit", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 25
""")
def f2(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return S.top_k(li, 25, F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey")


# G1-G4 ------------------------------------------------------------------------------------
@register("G1_union_all", oracle="""
SELECT 'customer' AS kind, c_nationkey AS nationkey FROM customer
UNION ALL SELECT 'supplier' AS kind, s_nationkey AS nationkey FROM supplier
""")
def g1(spark, d):
    c = t(spark, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nationkey"))
    s = t(spark, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nationkey"))
    return AG.union_all(c, s)


@register("G2_union_distinct", oracle="""
SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier
""")
def g2(spark, d):
    c = t(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = t(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return AG.union_distinct(c, s)


@register("G3_intersect", oracle="""
SELECT o_orderkey AS orderkey FROM orders INTERSECT SELECT l_orderkey FROM lineitem
""")
def g3(spark, d):
    return AG.intersect(t(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey")),
                        t(spark, d, "lineitem").select(F.col("l_orderkey").alias("orderkey")))


@register("G4_except", oracle="""
SELECT o_orderkey AS orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem
""")
def g4(spark, d):
    return AG.except_(t(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey")),
                      t(spark, d, "lineitem").select(F.col("l_orderkey").alias("orderkey")))
