"""Registered queries: scalar, array, struct, map, JSON functions and
generators (H1-H24), SQL functions (P1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.functions import nested as N
from tidepool.functions import scalar as SC
from tidepool.plans.common import dbl, t
from tidepool.plans.registry import register
from tidepool.sources.io import register_views

ITEMS_SQL = """(SELECT l_orderkey, list({'partkey': l_partkey, 'qty': l_quantity, 'price': l_extendedprice}) AS items,
        list(l_returnflag) AS flags FROM lineitem GROUP BY l_orderkey)"""


@register("H1_string_functions", oracle="""
SELECT c_custkey, CONCAT(LOWER(LEFT(c_name, 8)), '-', c_mktsegment) AS tag, UPPER(c_name) AS name_upper,
       LENGTH(c_name) AS name_len
FROM customer
""")
def h1(spark, d):
    c = t(spark, d, "customer")
    return c.select("c_custkey",
                    F.concat(F.lower(F.left("c_name", F.lit(8))), F.lit("-"), "c_mktsegment").alias("tag"),
                    F.upper("c_name").alias("name_upper"), F.length("c_name").cast("bigint").alias("name_len"))


@register("H2_split_to_array", oracle="""
SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, len(string_split(p_name, ' ')) AS n_words
FROM part
""")
def h2(spark, d):
    p = t(spark, d, "part").withColumn("w", SC.csv_to_array("p_name", " "))
    return p.select("p_partkey", F.element_at("w", 1).alias("first_word"),
                    F.size("w").cast("bigint").alias("n_words"))


@register("H3_month_trunc", oracle="""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS n_orders FROM orders GROUP BY 1
""")
def h3(spark, d):
    return (t(spark, d, "orders").groupBy(SC.month_start("o_orderdate").alias("month"))
            .agg(F.count(F.lit(1)).alias("n_orders")))


@register("H4_whole_months_between", oracle="""
SELECT o_orderkey,
       CAST(datediff('month', MIN(CAST(date_trunc('month', o_orderdate) AS DATE)) OVER (PARTITION BY o_custkey),
                     CAST(date_trunc('month', o_orderdate) AS DATE)) AS INTEGER) AS months_since_first
FROM orders
""")
def h4(spark, d):
    o = t(spark, d, "orders")
    # an aggregate joined back: a customer of any size is combined before the shuffle
    first = o.groupBy(F.col("o_custkey").alias("_cust")).agg(F.min(SC.month_start("o_orderdate")).alias("_first"))
    return o.join(first, F.col("o_custkey").eqNullSafe(F.col("_cust"))).select(
        "o_orderkey", SC.whole_months_between("o_orderdate", F.col("_first")).alias("months_since_first"))


@register("H5_text_to_timestamp_to_date", oracle="""
SELECT o_orderkey, CAST(CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP) AS DATE) AS order_date FROM orders
""")
def h5(spark, d):
    o = t(spark, d, "orders")
    return o.select("o_orderkey", SC.text_to_date(F.col("o_orderdate").cast("string")).alias("order_date"))


@register("H6_date_arithmetic_as_of", oracle="""
SELECT year(o_orderdate) AS order_year, COUNT(*) AS n_orders FROM orders
WHERE CAST(o_orderdate AS DATE) > DATE '1999-06-30' - INTERVAL 365 DAY
  AND CAST(o_orderdate AS DATE) <= DATE '1999-06-30'
GROUP BY 1
""")
def h6(spark, d):
    o = t(spark, d, "orders").filter(SC.within_days_before("o_orderdate", "1999-06-30", 365))
    return o.groupBy(F.year("o_orderdate").cast("bigint").alias("order_year")).agg(
        F.count(F.lit(1)).alias("n_orders"))


@register("H7_math_null_helpers", oracle="""
SELECT c_custkey, ROUND(c_acctbal) AS bal_round, CAST(FLOOR(c_acctbal) AS BIGINT) AS bal_floor,
       COALESCE(NULLIF(c_mktsegment, 'AUTOMOBILE'), 'n/a') AS segment,
       IF(c_acctbal > 0, 'credit', 'debit') AS kind,
       c_acctbal / NULLIF(c_nationkey, 0) AS bal_per_nationkey
FROM customer
""")
def h7(spark, d):
    c = t(spark, d, "customer")
    return c.select("c_custkey", F.round("c_acctbal").alias("bal_round"),
                    F.floor("c_acctbal").cast("bigint").alias("bal_floor"),
                    F.coalesce(F.nullif("c_mktsegment", F.lit("AUTOMOBILE")), F.lit("n/a")).alias("segment"),
                    F.when(F.col("c_acctbal") > 0, "credit").otherwise("debit").alias("kind"),
                    SC.safe_ratio("c_acctbal", "c_nationkey").alias("bal_per_nationkey"))


@register("H8_try_cast_decimal", oracle="""
WITH s AS (SELECT event_id, CASE WHEN event_id % 20 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value_text
           FROM events)
SELECT event_id, value_text, CAST(TRY_CAST(value_text AS DECIMAL(10,2)) AS DOUBLE) AS amount FROM s
""")
def h8(spark, d):
    ev = t(spark, d, "events")
    s = ev.select("event_id", F.when(F.col("event_id") % 20 == 0, F.lit("n/a"))
                  .otherwise(F.col("value").cast("string")).alias("value_text"))
    return s.select("event_id", "value_text", dbl(SC.to_decimal("value_text")).alias("amount"))


@register("H9_hash_bucket", oracle="""
SELECT COUNT(*) AS n_rows, 16 AS n_buckets, true AS near_even, true AS stable FROM orders
""")
def h9(spark, d):
    # engines hash differently, so what holds for any good hash: every bucket is used, none holds
    # twice its share, and a key keeps its bucket
    o = t(spark, d, "orders")
    per_key = o.groupBy("o_orderkey").agg(F.min(SC.hash_bucket(16, "o_orderkey")).alias("bucket"),
                                          F.max(SC.hash_bucket(16, "o_orderkey")).alias("last"), F.count(F.lit(1)).alias("n"))
    buckets = per_key.groupBy("bucket").agg(F.sum("n").alias("n"), F.bool_and(F.col("bucket") == F.col("last")).alias("same"))
    return buckets.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).cast("int").alias("n_buckets"),
                       (F.max("n") * 16 < 2 * F.sum("n")).alias("near_even"), F.bool_and("same").alias("stable"))


@register("H10_array_size_contains", oracle=f"""
SELECT l_orderkey, len(items) AS n_items, list_contains(flags, 'R') AS has_return FROM {ITEMS_SQL}
""")
def h10(spark, d):
    oi = N.order_items(t(spark, d, "lineitem"))
    return oi.select("l_orderkey", F.size("items").cast("bigint").alias("n_items"),
                     F.array_contains("flags", "R").alias("has_return"))


@register("H11_array_transform", oracle="""
SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 2) AS doubled FROM embeddings
""")
def h11(spark, d):
    e = t(spark, d, "embeddings")
    return e.select("vec_id", N.scaled("embedding", 2.0).alias("doubled"))


@register("H12_array_filter", oracle="""
SELECT vec_id, len(list_filter(embedding, lambda x: x > 0)) AS n_positive,
       list_filter(embedding, lambda x: x > 0.5) AS large FROM embeddings
""")
def h12(spark, d):
    e = t(spark, d, "embeddings")
    return e.select("vec_id", F.size(N.positives("embedding")).cast("bigint").alias("n_positive"),
                    F.filter("embedding", lambda x: x > 0.5).alias("large"))


@register("H13_array_aggregate_fold", oracle="""
SELECT vec_id,
       list_reduce(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), lambda a, b: a + b, 0.0::DOUBLE) AS total,
       list_reduce(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)), lambda a, b: a + b, 0.0::DOUBLE) AS sum_sq
FROM embeddings
""")
def h13(spark, d):
    e = t(spark, d, "embeddings")
    return e.select("vec_id", N.fold_sum("embedding").alias("total"),
                    N.fold_sum_squares("embedding").alias("sum_sq"))


@register("H14_array_build_join_compact", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey,
       concat_ws(', ', CASE WHEN l_discount >= 0.09 THEN 'high_discount' END,
                       CASE WHEN l_returnflag = 'R' THEN 'returned' END,
                       CASE WHEN l_quantity > 45 THEN 'bulk' END) AS tags
FROM lineitem
""")
def h14(spark, d):
    li = t(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     N.tag_list({"high_discount": F.col("l_discount") >= 0.09,
                                 "returned": F.col("l_returnflag") == "R",
                                 "bulk": F.col("l_quantity") > 45}).alias("tags"))


@register("H15_struct_build_access", oracle="""
WITH s AS (SELECT {'key': o_orderkey, 'money': {'price': o_totalprice, 'status': o_orderstatus}} AS o FROM orders)
SELECT o.key AS order_key, o.money.price AS price, o.money.status AS status FROM s
""")
def h15(spark, d):
    o = t(spark, d, "orders").select(
        F.named_struct(F.lit("key"), F.col("o_orderkey"),
                       F.lit("money"), F.struct(F.col("o_totalprice").alias("price"),
                                                F.col("o_orderstatus").alias("status"))).alias("o"))
    return o.select(F.col("o.key").alias("order_key"), F.col("o.money").getField("price").alias("price"),
                    F.col("o.money.status").alias("status"))


@register("H16_json_path_extract", oracle="""
SELECT event_type, SUM(CAST(json_extract_string(props, '$.k') AS INTEGER))::BIGINT AS k_sum, COUNT(*) AS n
FROM events GROUP BY event_type
""")
def h16(spark, d):
    ev = t(spark, d, "events")
    return ev.groupBy("event_type").agg(F.sum(N.json_field("props", "$.k").cast("int")).cast("bigint").alias("k_sum"),
                                        F.count(F.lit(1)).alias("n"))


@register("H17_json_to_struct", oracle="""
SELECT event_id, json_transform(props, '{"k": "INTEGER"}').k AS k FROM events
""")
def h17(spark, d):
    ev = t(spark, d, "events")
    return ev.select("event_id", N.parse_json("props", "k INT").getField("k").alias("k"))


@register("H18_struct_to_json_round_trip", oracle="""
SELECT event_id, event_type, CAST(value AS DOUBLE) AS value FROM events
""")
def h18(spark, d):
    ev = t(spark, d, "events")
    js = ev.select(F.to_json(F.struct("event_id", "event_type", "value")).alias("j"))
    back = js.select(F.from_json("j", "event_id BIGINT, event_type STRING, value DOUBLE").alias("r"))
    return back.select("r.event_id", "r.event_type", "r.value")


@register("H20_explode_array", oracle="""
SELECT l_orderkey, l_partkey AS partkey, l_quantity AS qty FROM lineitem
""")
def h20(spark, d):
    oi = N.order_items(t(spark, d, "lineitem"))
    ex = oi.select("l_orderkey", F.explode("items").alias("it"))
    return ex.select("l_orderkey", F.col("it.partkey").alias("partkey"), F.col("it.qty").alias("qty"))


@register("H21_explode_outer", oracle="""
SELECT o.o_orderkey, l.l_partkey AS partkey FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def h21(spark, d):
    oi = N.order_items(t(spark, d, "lineitem")).withColumnRenamed("l_orderkey", "o_orderkey")
    o = t(spark, d, "orders").select("o_orderkey").join(oi, "o_orderkey", "left")
    ex = o.select("o_orderkey", F.explode_outer("items").alias("it"))
    return ex.select("o_orderkey", F.col("it.partkey").alias("partkey"))


@register("H22_explode_map", oracle="""
WITH m AS (SELECT CAST(CAST(props AS JSON) AS MAP(VARCHAR, INTEGER)) AS mp FROM events),
kv AS (SELECT unnest(map_keys(mp)) AS key, unnest(map_values(mp)) AS value FROM m)
SELECT key, SUM(value)::BIGINT AS total, COUNT(*) AS n FROM kv GROUP BY key
""")
def h22(spark, d):
    ev = t(spark, d, "events").select(F.from_json("props", "map<string,int>").alias("mp"))
    kv = ev.select(F.explode("mp").alias("key", "value"))
    return kv.groupBy("key").agg(F.sum("value").cast("bigint").alias("total"), F.count(F.lit(1)).alias("n"))


@register("H23_inline_structs", oracle="""
SELECT l_orderkey, l_partkey AS partkey, l_quantity AS qty, l_extendedprice AS price FROM lineitem
""")
def h23(spark, d):
    oi = N.order_items(t(spark, d, "lineitem"))
    return oi.select("l_orderkey", F.inline("items"))


@register("H24_posexplode", oracle="""
WITH s AS (SELECT p_partkey, string_split(p_name, ' ') AS words FROM part)
SELECT p_partkey, CAST(generate_subscripts(words, 1) - 1 AS INTEGER) AS pos, unnest(words) AS word FROM s
""")
def h24(spark, d):
    p = t(spark, d, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    return p.select("p_partkey", F.posexplode("words").alias("pos", "word"))


@register("P1_sql_scalar_function", oracle="""
SELECT c_custkey, CONCAT(LEFT(LOWER(REPLACE(c_name, '#', '.')) || '@example.com', 2), '****@****.com') AS masked_email
FROM customer
""")
def p1(spark, d):
    register_views(spark, d, ["customer"])
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION tp_mask_email(e STRING) RETURNS STRING
                 RETURN CONCAT(LEFT(e, 2), '****@****.com')""")
    return spark.sql("""SELECT c_custkey,
                               tp_mask_email(LOWER(REPLACE(c_name, '#', '.')) || '@example.com') AS masked_email
                        FROM customer""")
